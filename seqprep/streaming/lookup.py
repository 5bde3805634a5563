"""Lookup on a stream: each micro-batch joins the vocabulary as it stands when the batch starts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.operators.limits import LookupLimits
from seqprep.plans.process_sequences import KEYS
from seqprep.plans.vocabulary_lookup import lookup_terms
from seqprep.sources.tables import materialise

#: Column and folder name of a batch's rows in the target.
BATCH_COLUMN = "lookup_batch"


def lookup_new_terms(
    stream: DataFrame,
    target: str,
    progress: str,
    vocabulary: Callable[[SparkSession], DataFrame | None],
    source_column: str,
    result_column: str | None = None,
    result_concept_column: str | None = None,
    fmt: str = "parquet",
    keys: Sequence[str] = KEYS,
    *,
    exact: bool = False,
    on_missing: str = "error",
    limits: LookupLimits = LookupLimits(),
) -> None:
    """Look up all terms that have arrived since the last call, add them to ``target`` and return.

    ``vocabulary`` gives the key table (``vocabulary_keys``). It is called once for each
    batch, and the batch works on a checkpointed copy: a vocabulary that is replaced
    meanwhile counts from the next batch on, and within a batch every row sees the same one.

    A batch's rows are the folder ``lookup_batch=<number>`` of ``target``, replaced as a
    whole. A batch that is run again after a failure takes the place of its first try, so
    each row is there once. ``progress`` is the stream's checkpoint folder; all are on
    shared storage. ``read_found`` reads the rows.
    """
    if result_column is None and result_concept_column is None:
        raise ValueError("name result_column, result_concept_column or both")

    def run(batch: DataFrame, number: int) -> None:
        pinned = vocabulary(batch.sparkSession)
        found = lookup_terms(
            batch,
            None if pinned is None else materialise(pinned),
            source_column,
            result_column,
            result_concept_column,
            keys,
            exact=exact,
            on_missing=on_missing,
            limits=limits,
        )
        found.write.format(fmt).mode("overwrite").save(f"{target.rstrip('/')}/{BATCH_COLUMN}={number}")

    query = (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_found(spark: SparkSession, target: str, fmt: str = "parquet", batches: bool = False) -> DataFrame:
    """The rows of all batches in ``target``; with ``batches`` also the number of each row's batch."""
    rows = spark.read.format(fmt).load(target)
    return rows.withColumn(BATCH_COLUMN, F.col(BATCH_COLUMN).cast("long")) if batches else rows.drop(BATCH_COLUMN)
