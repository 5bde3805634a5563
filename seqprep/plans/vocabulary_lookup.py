"""Job: look the terms of a table column up in a vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.operators.clean import quoted
from seqprep.operators.limits import LookupLimits
from seqprep.operators.lookup import lookup
from seqprep.operators.vocabulary import vocabulary_keys
from seqprep.plans.process_sequences import KEYS
from seqprep.sources.tables import read_table, write_table
from seqprep.sources.vocabulary import Vocabulary


def lookup_terms(
    df: DataFrame,
    keys_table: DataFrame | None,
    source_column: str,
    result_column: str | None = None,
    result_concept_column: str | None = None,
    keys: Sequence[str] = KEYS,
    *,
    exact: bool = False,
    on_missing: str = "error",
    limits: LookupLimits = LookupLimits(),
) -> DataFrame:
    """Key columns, ``raw_<column>`` and the result columns that are named."""
    raw = f"raw_{source_column}"
    return lookup(
        df.select(*[F.col(quoted(k)) for k in keys], F.col(quoted(source_column)).alias(raw)),
        raw,
        keys_table,
        concept_as=result_column,
        struct_as=result_concept_column,
        exact=exact,
        on_missing=on_missing,
        limits=limits,
    )


def lookup_job(
    spark: SparkSession,
    source: str,
    target: str,
    vocabulary: Vocabulary | None,
    source_column: str,
    result_column: str | None = None,
    result_concept_column: str | None = None,
    fmt: str = "parquet",
    keys: Sequence[str] = KEYS,
    *,
    exact: bool = False,
    on_missing: str = "error",
    limits: LookupLimits = LookupLimits(),
) -> int:
    """Replace table ``target``; returns the number of rows written.

    Both preconditions, a named result and an existing source, are checked
    before anything is read or written.
    """
    if result_column is None and result_concept_column is None:
        raise ValueError("name result_column, result_concept_column or both")
    rows = read_table(spark, source)
    keys_table = None if vocabulary is None else vocabulary_keys(vocabulary, exact, limits)
    found = lookup_terms(
        rows,
        keys_table,
        source_column,
        result_column,
        result_concept_column,
        keys,
        exact=exact,
        on_missing=on_missing,
        limits=limits,
    )
    return write_table(found, target, fmt)
