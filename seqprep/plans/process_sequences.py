"""Job: clean the sequences of a table into a new table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.operators.clean import RESULT_TYPE, Options, clean_columns, quoted
from seqprep.sources.tables import read_table, write_table

KEYS = ("datasetkey", "gbifid")
SEQUENCE_COLUMN = "v_dnasequence"


def process_sequences(
    df: DataFrame,
    seq_col: str = SEQUENCE_COLUMN,
    keys: Sequence[str] = KEYS,
    options: Options = None,
) -> DataFrame:
    """Key columns, the cleaned sequence and its metrics, one row per input row."""
    fields = [name for name in RESULT_TYPE.names if name not in ("seqId", "rawSequence")]
    kept = [F.col(quoted(name)) for name in keys]
    return clean_columns(
        df.select(*kept, F.col(quoted(seq_col))),
        seq_col,
        options,
        keep=kept,
        fields=fields,
        rename={"sequence": "cleaned_sequence"},
    )


def process_sequences_job(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = "parquet",
    seq_col: str = SEQUENCE_COLUMN,
    keys: Sequence[str] = KEYS,
    options: Options = None,
) -> int:
    """Replace table ``target``; returns the number of rows written."""
    cleaned = process_sequences(read_table(spark, source), seq_col, keys, options)
    return write_table(cleaned, target, fmt)
