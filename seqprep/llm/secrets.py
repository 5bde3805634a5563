"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Three patterns find candidates. Every candidate value is hashed, and the hashes are
counted over the corpus by distinct repositories and owners. A value that several
owners hold is a copied example; one that a single owner holds and that looks random
is taken for a live credential. Nothing here runs Python on the executors.

Cases: a null text is empty and holds nothing. A null owner or repository counts as
one unnamed owner or repository. Repeated rows stay, each with its own result. Very
long texts are scanned whole. Columns of the input may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.shared import materialise, quoted, table

#: The three patterns and the shortest match that counts.
ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = [("assign", ASSIGN, 1, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24)]
#: Cheap tests that hold for every text with a match that counts.
GATES = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
#: The kind of the added spans: values of one owner that look live.
LIVE = "live"
#: Words that mark a value as a placeholder.
PLACEHOLDER = r"(?i)example|sample|dummy|change_?me|placeholder|your|xxxx|test"

FOUND = (
    "array<struct<at:int, kind_no:int, end:int, kind:string, value_at:int, value_hash:string, "
    "random:boolean>>"
)
BASE = (
    "array<struct<at:int, kind_no:int, end:int, kind:string, value_at:int, repos:bigint, "
    "owners:bigint, live:boolean>>"
)


def looks_random(value: Column) -> Column:
    """Letters and digits mixed, no placeholder word, and at least five different characters."""
    return (
        value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & ~value.rlike(PLACEHOLDER)
        & (F.size(F.array_distinct(F.split(value, ""))) >= 5)
    )


def matches(text: Column, kind: str, kind_no: int, pattern: str, group: int, least: int) -> Column:
    """The matches of one pattern, in code points.

    ``split`` gives the texts between the matches and ``regexp_extract_all`` the
    matches, both leftmost and non-overlapping; running lengths give the positions.
    """
    # a short run of hex digits can be passed over: maximal runs never share a digit
    exact = pattern if kind == "assign" else pattern[:-1] + "{%d,}" % (least - 4 * (kind == "access"))
    whole = F.regexp_extract_all(text, F.lit(exact), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(exact), F.lit(group)) if group else whole
    steps = F.arrays_zip(
        F.split(text, exact, -1).alias("before"), whole.alias("whole"), value.alias("value")
    )
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(FOUND).alias("found"))

    def step(acc: Column, x: Column) -> Column:
        at = acc["at"] + F.length(x["before"])
        end = at + F.length(x["whole"])
        one = F.struct(
            at.alias("at"),
            F.lit(kind_no).alias("kind_no"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            (end - F.length(x["value"])).alias("value_at"),
            F.sha2(x["value"], 256).alias("value_hash"),
            looks_random(x["value"]).alias("random"),
        )
        kept = F.when(
            F.length(x["value"]) >= least,
            F.concat(F.coalesce(acc["found"], F.array().cast(FOUND)), F.array(one).cast(FOUND)),
        ).otherwise(acc["found"])
        # the last piece has no match after it
        return F.struct(F.coalesce(end, at).alias("at"), kept.alias("found"))

    found = F.aggregate(steps, start, step, lambda acc: acc["found"])
    return F.when(text.rlike(GATES[kind]), F.coalesce(found, F.array().cast(FOUND))).otherwise(
        F.array().cast(FOUND)
    )


def find_candidates(text: Column) -> Column:
    """All candidates of a text as an array in order of start, then kind."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(
        F.concat(*[matches(text, k, i, p, g, least) for i, (k, p, g, least) in enumerate(KINDS)])
    )


def brief(spans: str) -> Column:
    """The spans without counts and verdicts."""
    return F.transform(spans, lambda x: F.struct(x["at"], x["kind_no"], x["end"], x["kind"]))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda x: F.concat_ws(":", x["kind"], x["at"].cast("string"), x["end"].cast("string"))
        ),
        ",",
    )


def ownership(hits: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every candidate hash of ``hits``.

    Both steps combine before they shuffle, so a value that a third of all rows hold
    moves as one row a task.
    """
    hashes = F.array_distinct(F.transform("found", lambda x: x["value_hash"]))
    each = hits.select(F.explode(hashes).alias("value_hash"), "repo", "owner")
    held = each.groupBy("value_hash", "repo", "owner").agg(F.count(F.lit(1)).alias("rows"))
    # inside a struct a null counts as a value of its own
    return held.groupBy("value_hash").agg(
        F.sum("rows").alias("rows"),
        F.count_distinct(F.struct("repo")).alias("repos"),
        F.count_distinct(F.struct("owner")).alias("owners"),
    )


def judge(hits: DataFrame, max_owners: int) -> DataFrame:
    """(row_no, base): every candidate of the rows in ``hits`` with its counts and verdict."""
    each = hits.select("row_no", F.explode("found").alias("x")).withColumn(
        "value_hash", F.col("x.value_hash")
    )
    live = F.coalesce(F.col("x.random") & (F.col("owners") <= max_owners), F.lit(False))
    fields = ["x.at", "x.kind_no", "x.end", "x.kind", "x.value_at", "repos", "owners"]
    return (
        each.join(ownership(hits), "value_hash")
        .select("row_no", F.struct(*fields, live.alias("live")).alias("x"))
        .groupBy("row_no")
        .agg(F.array_sort(F.collect_list("x")).alias("base"))
    )


def scan_secrets(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    repo: str = "source",
    owner: str = "source",
    max_owners: int = 1,
) -> DataFrame:
    """(key, base, live) for every row of ``df``.

    ``base`` holds every candidate (in order of start, then kind) with its numbers of
    repositories and owners, ``live`` the spans of the values that at most
    ``max_owners`` owners hold and that look random. The scan's small result is
    checkpointed: it is read for the corpus counts and again for the verdicts.
    """
    found = materialise(
        df.select(
            F.col(quoted(key)).alias("key"),
            F.col(quoted(repo)).cast("string").alias("repo"),
            F.col(quoted(owner)).cast("string").alias("owner"),
            find_candidates(F.col(quoted(text))).alias("found"),
            F.monotonically_increasing_id().alias("row_no"),
        )
    )
    hits = found.where(F.size("found") > 0)
    return found.select("key", "row_no").join(judge(hits, max_owners), "row_no", "left").select(
        F.col("key").alias(key),
        F.coalesce("base", F.array().cast(BASE)).alias("base"),
        F.array_distinct(
            F.transform(
                F.filter(F.coalesce("base", F.array().cast(BASE)), lambda x: x["live"]),
                lambda x: F.struct(
                    x["value_at"].alias("at"),
                    F.lit(len(KINDS)).alias("kind_no"),
                    x["end"].alias("end"),
                    F.lit(LIVE).alias("kind"),
                ),
            )
        ).alias("live"),
    )


def redact_live(
    df: DataFrame,
    text: str = "text",
    repo: str = "source",
    owner: str = "source",
    max_owners: int = 1,
    mask: str = "<SECRET>",
) -> DataFrame:
    """``df``, same columns and rows, with live values in its texts replaced by ``mask``.

    Only rows with candidates are checkpointed; the others are scanned again where the
    result is read.
    """
    packed = df.select(
        F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"),
        F.col(quoted(text)).alias("text"),
        F.col(quoted(repo)).cast("string").alias("repo"),
        F.col(quoted(owner)).cast("string").alias("owner"),
        find_candidates(F.col(quoted(text))).alias("found"),
    )
    hits = materialise(
        packed.where(F.size("found") > 0).withColumn("row_no", F.monotonically_increasing_id())
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(acc: Column, x: Column) -> Column:
        # overlapping live values (a hex run inside an assignment) are cut once
        before = F.substring(F.col("text"), acc["at"] + 1, x["value_at"] - acc["at"])
        out = F.when(x["value_at"] >= acc["at"], F.concat(acc["out"], before, F.lit(mask)))
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"), F.coalesce(out, acc["out"]).alias("out")
        )

    live = F.array_sort(
        F.transform(
            F.filter("base", lambda x: x["live"]),
            lambda x: F.struct(x["value_at"].alias("value_at"), x["end"].alias("end")),
        )
    )
    clean = F.aggregate(
        live, start, cut, lambda acc: F.concat(acc["out"], F.substr(F.col("text"), acc["at"] + 1))
    )
    masked = hits.join(judge(hits, max_owners), "row_no").select("row", clean.alias("text"))
    both = packed.where(F.size("found") == 0).select("row", "text").unionByName(masked)
    return both.select(
        *[
            F.col("text").alias(c) if c == text else F.col(f"row.{quoted(c)}").alias(c)
            for c in df.columns
        ]
    )


# --- query ---------------------------------------------------------------------------


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``; a source is repository and owner."""
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k, *_ in KINDS],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat(brief("base"), brief("live")))).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        F.coalesce(F.array_max(F.transform("base", lambda x: x["owners"])), F.lit(0)).alias("max_owners"),
    )


def _sql() -> str:
    """DuckDB's text for the query."""

    def quote(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    found = " UNION ALL ".join(
        f"""SELECT row_no, {no} AS kind_no, '{kind}' AS kind, string_split_regex(t, {quote(p)}) AS b,
        regexp_extract_all(t, {quote(p)}, 0) AS m, regexp_extract_all(t, {quote(p)}, {group}) AS v, {least} AS least FROM d"""
        for no, (kind, p, group, least) in enumerate(KINDS)
    )
    size = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(source, chr(1)) AS owner, coalesce(text, '') AS t FROM documents),
    f AS ({found}),
    i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM f),
    x AS (
      SELECT row_no, kind_no, kind, m[i] AS whole, v[i] AS value,
        ({size.format("b[1:i]")} + {size.format("m[1:i - 1]")})::BIGINT AS begin_at FROM i WHERE length(v[i]) >= least),
    h AS (SELECT value, count(DISTINCT owner) AS owners FROM x JOIN d USING (row_no) GROUP BY value),
    y AS (
      SELECT row_no, kind_no, kind, begin_at, begin_at + length(whole) AS stop, owners, begin_at + length(whole) - length(value) AS value_at,
        owners <= 1 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
        AND NOT regexp_matches(value, {quote(PLACEHOLDER)}) AND len(list_distinct(string_split(value, ''))) >= 5 AS live
      FROM x JOIN h USING (value)),
    spans AS (
      SELECT row_no, begin_at, kind_no, kind, stop FROM y
      UNION ALL SELECT DISTINCT row_no, value_at, {len(KINDS)}, '{LIVE}', stop FROM y WHERE live),
    s AS (
      SELECT row_no, string_agg(kind || ':' || begin_at || ':' || stop, ',' ORDER BY begin_at, kind_no) FILTER (kind <> '{LIVE}') AS base,
        string_agg(kind || ':' || begin_at || ':' || stop, ',' ORDER BY begin_at, kind_no) AS spans,
        count(*) FILTER (kind = '{LIVE}') AS n_live, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, *_ in KINDS)}
      FROM spans GROUP BY row_no),
    o AS (SELECT row_no, max(owners) AS most FROM y GROUP BY row_no)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k, *_ in KINDS)},
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
      coalesce(most, 0) AS max_owners
    FROM d LEFT JOIN s USING (row_no) LEFT JOIN o USING (row_no)
    """


OP6_SQL = _sql()
