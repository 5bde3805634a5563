"""Reports over cleaned sequences and looked-up terms: partial aggregates only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.operators.clean import quoted
from seqprep.operators.limits import LookupLimits
from seqprep.operators.lookup import lookup
from seqprep.operators.vocabulary import match_key


def distinct_sequences(cleaned: DataFrame) -> DataFrame:
    """Each sequence once, with its numbers of occurrences and datasets.

    Rows without an ID (invalid or empty) are counted as zero in each task and go after
    the grouping: a filter on the ID would be moved below the cleaning, whose stages it
    would hold once more, each many times over, in code too long to compile.
    """
    found = cleaned.groupBy("nucleotideSequenceID").agg(
        F.min("cleaned_sequence").alias("cleaned_sequence"),
        F.count("nucleotideSequenceID").alias("occurrences"),
        F.count_distinct("datasetkey").alias("datasets"),
    )
    return found.where("occurrences > 0")


def dataset_quality(cleaned: DataFrame) -> DataFrame:
    """Counts of each dataset's rows by what the cleaning found."""
    return cleaned.groupBy("datasetkey").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("sequenceLength").alias("with_sequence"),
        F.count_if("invalid").alias("invalid"),
        F.count_if("endsTrimmed").alias("trimmed"),
        F.count_if("naturalLanguageDetected").alias("with_language"),
        F.sum(F.col("sequenceLength").cast("long")).alias("total_length"),
        F.max("gcContent").alias("max_gc_content"),
    )


def dataset_averages(cleaned: DataFrame) -> DataFrame:
    """Each dataset's mean length and the GC, N and ambiguity shares of all its bases together.

    Counts of bases are whole numbers again before they are summed, so that the result
    does not depend on the order of the rows.
    """
    length = F.col("sequenceLength").cast("long")
    n = F.round(F.col("nFraction") * length).cast("long")
    odd = F.round(F.col("nonACGTNFraction") * length).cast("long")
    gc = F.round(F.col("gcContent") * (length - n - odd)).cast("long")
    bases = cleaned.select("datasetkey", length.alias("bases"), n.alias("n"), odd.alias("odd"), gc.alias("gc"))
    total = bases.groupBy("datasetkey").agg(
        F.count("bases").alias("with_sequence"), *[F.sum(c).alias(c) for c in ("bases", "n", "odd", "gc")]
    )
    acgt = F.col("bases") - F.col("n") - F.col("odd")
    return total.select(
        "datasetkey",
        F.try_divide("bases", "with_sequence").alias("mean_length"),
        F.try_divide(F.col("gc"), acgt).alias("gc_content"),
        F.try_divide("n", "bases").alias("n_fraction"),
        F.try_divide("odd", "bases").alias("non_acgtn_fraction"),
    )


#: Size parameter of the quantile sketches: a rank error of about 0.7 per cent.
SKETCH_K = 400


def length_sketches(cleaned: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(datasetkey, lengths): a quantile sketch of each dataset's sequence lengths.

    Sketches are of bounded size and can be saved, and merged by ``merge_sketches``. They
    leave out nulls by themselves; datasets without a length go after the grouping, as in
    ``distinct_sequences``.
    """
    sketch = F.kll_sketch_agg_bigint(F.col("sequenceLength").cast("long"), F.lit(k))
    found = cleaned.groupBy("datasetkey").agg(sketch.alias("lengths"), F.count("sequenceLength").alias("n"))
    return found.where("n > 0").drop("n")


def merge_sketches(batches: list[DataFrame], k: int = SKETCH_K) -> DataFrame:
    """Sketches of several batches as one for each dataset."""
    # few and small: one for each dataset and batch
    both = reduce(DataFrame.unionByName, batches).groupBy("datasetkey").agg(F.collect_list("lengths").alias("parts"))
    merged = F.reduce(
        F.slice("parts", F.lit(2), F.size("parts")), F.get("parts", F.lit(0)), lambda a, b: F.kll_sketch_merge_bigint(a, b)
    )
    return both.select("datasetkey", merged.alias("lengths"))


def length_quantiles(sketches: DataFrame, ranks: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(datasetkey, n, quantiles): the lengths at some ranks, from the sketches."""
    return sketches.select(
        "datasetkey",
        F.kll_sketch_get_n_bigint("lengths").alias("n"),
        F.array(*[F.kll_sketch_get_quantile_bigint("lengths", F.lit(r)) for r in ranks]).alias("quantiles"),
    )


def catalogue_state(cleaned: DataFrame) -> DataFrame:
    """(nucleotideSequenceID, datasetkey, cleaned_sequence, occurrences) of a batch.

    States of batches are merged by ``merge_catalogues`` in any order; a sequence of very many
    datasets is many rows, never one long list. Rows without an ID go after the grouping,
    as in ``distinct_sequences``.
    """
    found = cleaned.groupBy("nucleotideSequenceID", "datasetkey").agg(
        F.min("cleaned_sequence").alias("cleaned_sequence"), F.count("nucleotideSequenceID").alias("occurrences")
    )
    return found.where("occurrences > 0")


def merge_catalogues(states: list[DataFrame]) -> DataFrame:
    """The state of all batches together."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy("nucleotideSequenceID", "datasetkey").agg(
        F.min("cleaned_sequence").alias("cleaned_sequence"), F.sum("occurrences").alias("occurrences")
    )


def catalogue(state: DataFrame) -> DataFrame:
    """``distinct_sequences`` of all rows that a state was made from."""
    return state.groupBy("nucleotideSequenceID").agg(
        F.min("cleaned_sequence").alias("cleaned_sequence"),
        F.sum("occurrences").alias("occurrences"),
        F.count("datasetkey").alias("datasets"),
    )


def unmatched_terms(
    df: DataFrame,
    column: str,
    keys: DataFrame,
    *,
    exact: bool = False,
    limits: LookupLimits = LookupLimits(),
) -> DataFrame:
    """Terms that no concept has, as matched, with their numbers of rows.

    Terms are counted first and looked up once each.
    """
    term = match_key(F.col(quoted(column)), exact)
    counted = df.where(term.isNotNull()).groupBy(term.alias("term")).agg(F.count(F.lit(1)).alias("rows"))
    found = lookup(counted, "term", keys, concept_as="concept", exact=True, limits=limits)
    return found.where("concept IS NULL").select("term", "rows")
