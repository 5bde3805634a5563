"""Vocabulary lookup: a left join on the match key, never a row-wise probe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqprep.operators.clean import quoted
from seqprep.operators.limits import LookupLimits, fits_broadcast
from seqprep.operators.vocabulary import match_key
from seqprep.sources.tables import materialise

# Fields of the lineage result.
LINEAGE_TYPE = T.StructType(
    [
        T.StructField("concept", T.StringType()),
        T.StructField("lineage", T.ArrayType(T.StringType())),
    ]
)

_TMP = "__seqprep_"
# Slices over which rows without a term are spread in a shuffled lookup.
_NULL_SLICES = 1 << 20


def lookup(
    df: DataFrame,
    column: str,
    keys: DataFrame | None,
    *,
    concept_as: str | None = None,
    struct_as: str | None = None,
    exact: bool = False,
    on_missing: str = "error",
    limits: LookupLimits = LookupLimits(),
) -> DataFrame:
    """Add the concept name and/or a ``(concept, lineage)`` struct for a term.

    ``keys`` comes from ``vocabulary_keys``, prepared with the same ``exact``.
    Every row of ``df`` stays, once. A null or unmatched term gives null; a
    match without parents gives an empty lineage. With ``on_missing="null"`` a
    missing vocabulary (``keys`` is None) gives all nulls.
    """
    if concept_as is None and struct_as is None:
        raise ValueError("name at least one result column: concept_as or struct_as")
    if on_missing not in ("error", "null"):
        raise ValueError("on_missing must be 'error' or 'null'")
    own = [F.col(quoted(name)) for name in df.columns]
    if keys is None:
        if on_missing == "error":
            raise ValueError("no vocabulary")
        joined = df.select(
            "*",
            F.lit(None).cast("string").alias(_TMP + "concept"),
            F.lit(None).cast("array<string>").alias(_TMP + "lineage"),
        )
    else:
        wanted = ["concept"] + (["lineage"] if struct_as is not None else [])
        small = fits_broadcast(keys, wanted, limits)
        right = keys.select(
            F.col("key").alias(_TMP + "match"),
            *[F.col(name).alias(_TMP + name) for name in wanted],
        )
        left = df.withColumn(_TMP + "key", match_key(F.col(quoted(column)), exact))
        if small:
            joined = left.join(
                F.broadcast(right), F.col(_TMP + "key") == F.col(_TMP + "match"), "left"
            )
        else:
            joined = _shuffled(left, right, limits)

    results = []
    concept = F.col(_TMP + "concept")
    if concept_as is not None:
        results.append(concept.alias(concept_as))
    if struct_as is not None:
        lineage = F.col(_TMP + "lineage")
        found = F.struct(concept.alias("concept"), lineage.alias("lineage"))
        results.append(F.when(concept.isNotNull(), found).alias(struct_as))
    return joined.select(*own, *results)


def _shuffled(left: DataFrame, right: DataFrame, limits: LookupLimits) -> DataFrame:
    """Left join by shuffle on ``(key, slice)``.

    One term may hold a large share of the rows, and so may the missing term.
    Terms beyond ``rows_per_slice`` rows get enough slices to stay below it; a
    key row is repeated once per slice of its term only. Null terms match
    nothing, so their slice is free and just spreads them.

    The table of hot terms is broadcast: two numbers for each term with more than
    ``rows_per_slice`` rows. Where they are more than ``hot_terms``, slices are made
    larger until they fit. The counting pass reads the term column only. Terms meet
    by 64-bit hash; a collision merely cuts a cold term too.
    """
    key, match = F.col(_TMP + "key"), F.col(_TMP + "match")
    counts = materialise(
        left.where(key.isNotNull())
        .groupBy(F.xxhash64(key).alias(_TMP + "hash"))
        .count()
        .where(F.col("count") > limits.rows_per_slice)
    )
    rows_per_slice = limits.rows_per_slice
    while counts.where(F.col("count") > rows_per_slice).count() > limits.hot_terms:
        rows_per_slice *= 2
    hot = counts.where(F.col("count") > rows_per_slice).select(
        _TMP + "hash",
        F.ceil(F.col("count") / F.lit(rows_per_slice)).cast("int").alias(_TMP + "slices"),
    )

    def with_slices(frame: DataFrame, text: str) -> DataFrame:
        hashed = frame.withColumn(_TMP + "hash", F.xxhash64(_TMP + text))
        return hashed.join(F.broadcast(hot), _TMP + "hash", "left")

    slices = F.coalesce(F.col(_TMP + "slices"), F.lit(1))
    spread = F.when(key.isNull(), F.lit(_NULL_SLICES)).otherwise(slices)
    # Row content plus input partition: the same on a retried task, and copies
    # of one row still fall into different slices.
    own = [
        F.col(quoted(field.name))
        for field in left.schema.fields
        if not any(t in field.dataType.simpleString() for t in ("map<", "variant"))
    ]
    row_hash = F.xxhash64(F.spark_partition_id(), *own)
    sliced_left = with_slices(left, "key").withColumn(
        _TMP + "slice", F.pmod(row_hash, spread).cast("int")
    )
    sliced_right = with_slices(right, "match").withColumn(
        _TMP + "part", F.explode(F.sequence(F.lit(0), slices - 1))
    )
    return sliced_left.join(
        sliced_right.drop(_TMP + "hash", _TMP + "slices"),
        (key == match) & (F.col(_TMP + "slice") == F.col(_TMP + "part")),
        "left",
    )
