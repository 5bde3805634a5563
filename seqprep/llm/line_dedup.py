"""Line dedup over levelled sorted runs of line hashes, in DataFrame functions only.

A line's key is the line without white space at both ends and with A-Z in lower case.
The documents come in batches. A batch's keys are hashed and counted, once for each
document that holds them; the counts form a run, a table bucketed and sorted by hash.
Runs are levelled: whenever ``FAN_OUT`` runs of a level have come together they are
merged into one run of the next level, which reads every hash a logarithmic number of
times. A key that has reached the threshold in a merge moves to the settled runs; each
new batch is merge-anti-joined with those, so that a very common line is written once and
never again. All runs have the same buckets, so that neither an anti-join nor a merge of two
shuffles a run. After the last batch the levels are merged once more, and the lines of settled keys
are taken out of every document by their positions.

A key held by any number of documents is one row a task after partial aggregation. A
document's lines are cut and put together again inside its row.

Cases: a null text is empty; an empty text is one empty line and stays. Lines of white
space alone have an empty key and stay. Every row counts as a document of its own, also one
that repeats an id and a text, or has no id. A line that a document repeats counts once, and all its
places go. Very long texts are split whole: a row holds its lines and 40 bytes more for each. An
empty table gives an empty result. Columns of the input may have any name.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.shared import materialise, new_folder, quoted, table

#: Runs of a level that are merged into one of the next.
FAN_OUT = 2
#: Batches that the query makes of its table's files.
BATCHES = 4
#: Documents from which on a line goes.
MIN_DOCS = 10
#: Copies of a text that go to one task where it is put together again.
ROWS_PER_SLICE = 2_000
#: Texts whose copies are spread: a fixed number, as their list is broadcast.
HOT_TEXTS = 1_000
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def lowered(line: Column) -> Column:
    """A-Z in lower case; lines of ASCII alone have the quicker way."""
    ascii_only = F.octet_length(line) == F.char_length(line)
    return F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def hashes_of(text: Column) -> Column:
    """The key hash of each line of a text, null for an empty key."""
    keys = F.transform(F.transform(lines_of(text), lambda line: F.btrim(line, F.lit(WHITE))), lowered)
    return F.transform(keys, lambda key: F.when(key != "", F.substring(F.sha2(key, 256), 1, 32)))


def key_counts(docs: DataFrame, text: str) -> DataFrame:
    """(h, docs): each key's hash, and how many documents of the batch hold it."""
    once = F.explode(F.array_distinct(hashes_of(F.col(quoted(text)))))
    held = docs.select(once.alias("hex")).where("hex IS NOT NULL").select(F.unhex("hex").alias("h"))
    return held.groupBy("h").agg(F.count(F.lit(1)).alias("docs"))


class LineRuns:
    """Levelled runs of (hash, documents) and the settled hashes, in the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fan_out: int = FAN_OUT):
        self.spark, self.min_docs, self.fan_out = spark, min_docs, fan_out
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def _run(self, rows: DataFrame) -> DataFrame:
        """``rows`` as a run: a table of its own, bucketed and sorted by hash."""
        name = f"line_run_{uuid.uuid4().hex}"
        path = new_folder(self.spark, "line_run")
        rows.write.bucketBy(self.buckets, "h").sortBy("h").option("path", path).saveAsTable(name)
        run = self.spark.table(name)
        # the files stay; the name is needed only to learn the buckets
        self.spark.sql(f"DROP TABLE {name}")
        return run

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """The counts of all runs together, without settled hashes.

        Two runs of the same buckets meet in a sort-merge join without a shuffle. (A union under
        an aggregate is no way: on bucketed scans it gave a hash several rows, measured.)
        """
        rows = self._unsettled(runs[0])
        for run in runs[1:]:
            more = self._unsettled(run).withColumnRenamed("docs", "more")
            both = F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))
            rows = rows.join(more, "h", "full").select("h", both.alias("docs"))
        return rows

    def _unsettled(self, rows: DataFrame) -> DataFrame:
        for run in self.settled:
            rows = rows.join(run.select("h"), "h", "left_anti")
        return rows

    def add(self, docs: DataFrame, text: str = "text") -> None:
        """Count a batch's keys, without those that are settled, as a run of the first level."""
        self._push(0, self._run(self._unsettled(key_counts(docs, text))))

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_out:
            self._push(level + 1, self._compacted(self.levels[level]))
            self.levels[level] = []

    def _compacted(self, runs: list[DataFrame]) -> DataFrame:
        # a hash that got settled after a run was written may still be in that run
        merged = self._run(self._merged(runs))
        self.settled.append(self._run(merged.where(F.col("docs") >= self.min_docs)))
        return self._run(merged.where(F.col("docs") < self.min_docs))

    def common(self) -> DataFrame:
        """(h): the hashes of all keys that at least ``min_docs`` documents hold."""
        runs = [run for level in self.levels for run in level]
        found = [run.select("h") for run in self.settled]  # no two of them hold the same hash
        if runs:
            found.append(self._merged(runs).where(F.col("docs") >= self.min_docs).select("h"))
        return reduce(DataFrame.union, found) if found else self.spark.range(0).select(F.lit(b"").alias("h"))


def without_lines(docs: DataFrame, common: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """(``keep``, n_lines, n_dropped, kept) of every row, without the lines whose key is in ``common``."""
    rows = docs.select(
        *[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(keep)],
        F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"),
    )
    # rows of equal texts lose the same places
    row = [F.xxhash64("text").alias("r"), F.xxhash64(F.lit(1), "text").alias("s")]
    at = rows.select(*row, F.posexplode(hashes_of(F.col("text"))).alias("at", "hex")).where("hex IS NOT NULL")
    hits = at.select("r", "s", "at", F.unhex("hex").alias("h")).join(common, "h")
    gone = materialise(
        hits.groupBy("r", "s")
        .agg(F.collect_set("at").alias("gone"), F.count(F.lit(1)).alias("n"))
        .withColumn("slices", F.ceil(F.col("n") / F.size("gone") / ROWS_PER_SLICE))
    )
    # texts with very many copies are spread; beyond the most frequent ones none holds a share worth it
    hot = gone.where("slices > 1").orderBy(F.desc("slices"), "r", "s").limit(HOT_TEXTS).select("r", "s", "slices")
    hot = materialise(hot)
    cut = F.coalesce(F.col("slices"), F.lit(1).cast("long"))
    ids = [f"k{i}" for i in range(len(keep))]
    spread = rows.select("*", *row).join(F.broadcast(hot), ["r", "s"], "left")
    spread = spread.withColumn("slice", F.pmod(F.hash(*ids, F.spark_partition_id()), cut)).drop("slices")
    places = gone.drop("slices").join(F.broadcast(hot), ["r", "s"], "left")
    places = places.select("r", "s", "gone", F.explode(F.sequence(F.lit(0).cast("long"), cut - 1)).alias("slice"))
    joined = spread.join(places, ["r", "s", "slice"], "left")
    # a dropped place sorts right before its line
    line = F.transform(lines_of(F.col("text")), lambda x, i: F.struct(i.alias("at"), F.lit(1).alias("line"), x.alias("x")))
    mark = F.transform("gone", lambda i: F.struct(i.alias("at"), F.lit(0).alias("line"), F.lit("").alias("x")))
    marked = joined.withColumn("all", F.when(F.col("gone").isNotNull(), F.sort_array(F.concat(line, mark))))
    stays = F.filter(
        "all",
        lambda x, i: (x["line"] == 1) & ((i == 0) | (F.get("all", i - 1)["at"] != x["at"])),
    )
    kept = F.array_join(F.transform(stays, lambda x: x["x"]), "\n")
    found = marked.select(
        *ids,
        (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(kept, F.col("text")).alias("kept"),
    )
    return found.toDF(*keep, "n_lines", "n_dropped", "kept")


def line_dedup(
    batches: list[DataFrame], keep: list[str], text: str = "text", min_docs: int = MIN_DOCS, fan_out: int = FAN_OUT
) -> DataFrame:
    """(``keep``, n_lines, n_dropped, kept) of every row of every batch, without common lines."""
    runs = LineRuns(batches[0].sparkSession, min_docs, fan_out)
    for batch in batches:
        runs.add(batch, text)
    common = materialise(runs.common())
    return reduce(DataFrame.union, [without_lines(batch, common, keep, text) for batch in batches])


# --- query ---------------------------------------------------------------------------


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without the lines that at least ten of them hold."""
    docs = table(spark, sf_dir, "documents")
    batch = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(BATCHES))
    runs = LineRuns(spark)
    for b in range(BATCHES):
        runs.add(docs.where(batch == b))
    return without_lines(docs, materialise(runs.common()), ["doc_id"]).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


OP13_SQL = """
WITH numbered AS (
  SELECT rowid AS row, doc_id, unnest(generate_series(1, len(parts))) AS place, unnest(parts) AS line
  FROM (SELECT row_number() OVER () AS rowid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM numbered
), common AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(c.key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN common c USING (key) GROUP BY row, doc_id
"""
