"""Cleaning on a stream: the same stateless plan over whatever files have arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from seqprep.operators.clean import Options
from seqprep.plans.process_sequences import KEYS, SEQUENCE_COLUMN, process_sequences


def process_new_sequences(
    stream: DataFrame,
    target: str,
    progress: str,
    fmt: str = "parquet",
    seq_col: str = SEQUENCE_COLUMN,
    keys: Sequence[str] = KEYS,
    options: Options = None,
) -> None:
    """Clean all that has arrived since the last call, append it to ``target`` and return.

    ``progress`` is the stream's checkpoint folder; both are on shared storage.
    """
    cleaned = process_sequences(stream, seq_col, keys, options)
    query = (
        cleaned.writeStream.format(fmt)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
