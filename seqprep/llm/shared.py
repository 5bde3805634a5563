"""Helpers that the operators of this subpackage have in common."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (``spark.checkpoint.dir``).

    Where it is unset, a session in local mode, such as a test, gets a folder beside
    its warehouse. A cluster session without it raises.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


#: Most rows of an Arrow batch that goes to Python.
BATCH_ROWS = 1_000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; from now on its session sends texts to Python in batches of some megabytes.

    Executors hold a batch several times, in the JVM and in Python. Spark's limit counts
    rows and is made for narrow ones; it is only ever lowered here.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint.

    It is written in a few files for each core of the cluster, however many shuffle
    partitions there are: every file made costs a process on each executor's machine.
    """
    shared_folder(df.sparkSession)
    return few_files(df).checkpoint(eager=True)


def few_files(df: DataFrame) -> DataFrame:
    """``df`` in at most four partitions for each core of the cluster, without a shuffle."""
    return df.coalesce(4 * max(2, df.sparkSession.sparkContext.defaultParallelism))


def quoted(name: str) -> str:
    """A column name as Spark reads it, also with dots in it."""
    return "`" + name.replace("`", "``") + "`"


def bit_filter(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bit for each value modulo ``bits`` (a power of two): ``bits`` / 8 bytes at any size."""
    maps = (
        values.select(F.expr(f"({quoted(column)} & {bits - 1}) + 1").alias("at"))
        .groupBy(F.expr("bitmap_bucket_number(at)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("bits"))
    )
    table = np.zeros(max(bits // 8, 4096), np.uint8)
    for row in maps.toLocalIterator():
        at = (row.bucket - 1) * len(row.bits)
        table[at : at + len(row.bits)] = np.frombuffer(row.bits, np.uint8)
    return table


def passes(table: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Which values a ``bit_filter`` lets through: all that it was made from, and some more."""
    at = (values.view(np.uint64) & np.uint64(bits - 1)).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def beside_text(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """The columns ``keep`` as k0, k1, ... and the text as ``text``, so that no names clash.

    A text that is kept is sent to Python once, not twice.
    """
    kept = [F.col(quoted(c)).alias("text" if c == text else f"k{i}") for i, c in enumerate(keep)]
    return small_batches(df).select(*kept, *([] if text in keep else [F.col(quoted(text)).alias("text")]))


def fields(rows: DataFrame, hold_text: bool, *more: str) -> str:
    """The schema text of the kept columns of ``beside_text`` and of ``more``."""
    return ", ".join([*(f"{c} {t}" for c, t in rows.dtypes if c != "text" or hold_text), *more])


def kept(part: pa.RecordBatch, hold_text: bool) -> pa.RecordBatch:
    """The kept columns of a batch of ``beside_text``."""
    return part if hold_text else part.drop_columns(["text"])


def small(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """``df``, of a few short columns, to be broadcast if it has at most ``most_rows`` rows."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
