"""Pipeline over ``documents``: each stage reads what the one before it kept.

A stage is a function (spark, docs, sf_dir) -> DataFrame. Its result is written as
Parquet and read again as the next one's ``docs``. All stages but the last return the
columns of ``docs``, whatever they are.

Cases: rows with null texts have no language and go with the first stage. Rows without
an id are documents like others, and so are rows with one id and different texts. An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm import bpe, decontaminate, jaccard_join, language, secrets
from seqprep.llm.shared import materialise, new_folder, small, table

#: No SQL: language ID, the similarity join and the tokenizer are not expressible.
ORACLE_SQL = None
#: A document is rejected if its language holds less than this share of its n-grams.
LEAST_FIT = 0.3
#: Near duplicates: words of a shingle, and per cent of two documents' shingles.
WIDTH, PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters or in no learnt language."""
    found = language.predict(docs, language.learn(docs), docs.columns)
    # by place, as a column of the documents may have any name
    n = len(docs.columns)
    placed = found.toDF(*[f"c{i}" for i in range(n + 3)])
    known = (F.col(f"c{n}") != language.UNKNOWN) & (F.col(f"c{n + 2}") >= LEAST_FIT)
    return placed.where(known).select(*[f"c{i}" for i in range(n)]).toDF(*docs.columns)


def row_key(docs: DataFrame) -> Column:
    """What a row is told apart by: its id and its text, in the order of the ids.

    Ids can be missing or repeated. Rows with the same id and text are copies of each
    other; rows without an id come after all others. The text stands in by 128 bits.
    """
    none, one, text = docs["doc_id"].isNull(), docs["doc_id"], docs["text"]
    return F.struct(
        none.alias("none"), one.alias("id"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g")
    )


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_key, text) of every row."""
    return docs.select(row_key(docs).alias("doc_key"), docs["text"].alias("text"))


def without(docs: DataFrame, gone: DataFrame, how: str = "left_anti") -> DataFrame:
    """The rows whose key is not in ``gone`` (doc_key) or, ``left_semi``, is in it."""
    gone = small(gone.select(F.col("doc_key").alias("gone")))
    return docs.join(gone, row_key(docs).eqNullSafe(gone["gone"]), how)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the least id.

    Of rows that repeat the kept id and text one stays. Rows that share no more than
    an id, or have none, are documents of their own.
    """
    classes = jaccard_join.jaccard_components(keyed(docs), key="doc_key", width=WIDTH, percent=PERCENT)
    groups = materialise(
        classes.groupBy("doc_key", "component_id").agg(
            F.count(F.lit(1)).alias("rows"), F.max("n_shingles").alias("n_shingles")
        )
    )
    first = F.col("doc_key").eqNullSafe(F.col("component_id"))
    # texts without words are copies of each other only under an id
    copies = (F.col("rows") > 1) & ((F.col("n_shingles") > 0) | ~F.col("doc_key.none"))
    again = groups.where(copies & first)
    kept = without(docs, groups.where(~first))
    return without(kept, again).unionByName(without(kept, again, "left_semi").dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of ``benchmark``."""
    found = decontaminate.contaminated(keyed(docs), table(spark, sf_dir, "benchmark"), doc_id="doc_key")
    return without(docs, materialise(found.select("doc_key").distinct()))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask live-looking credentials; every document stays."""
    return secrets.redact_live(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, and whether they decode to its text.

    The ids are written before they are decoded, so that no task holds an encoding and a
    decoding Python worker at once.
    """
    path = bpe.default_ranks()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    folder = new_folder(spark, "token-ids")
    bpe.encode(texts.withColumn("sha256", F.sha2("text", 256)), path, ["doc_id", "sha256"]).write.parquet(folder)
    return bpe.decode(spark.read.parquet(folder), path).select(
        "doc_id", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("sha256")).alias("round_trip")
    )


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("byte_level_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
