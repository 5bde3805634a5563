"""Table scans, the table sink and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by name; ``ValueError`` if there is none."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table or view not found: {name}")
    return spark.table(name)


def write_table(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    *,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> int:
    """Replace the table ``target`` with ``df`` and return the rows written.

    The old table stays readable until the new one is complete, and stays for good if the
    write fails. A catalog of its own (``spark.sql.catalog.<name>``) replaces it in one
    commit. In the session catalog the rows go to a table beside the target, or a folder
    beside ``path``, and names are changed last; so ``df`` may read the target as well.

    The count is observed while the rows are written, so the source is read and
    the plan is run once.
    """
    spark = df.sparkSession
    written = Observation("seqprep_rows_written")
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    parts = _name_parts(spark, target)
    if spark.conf.get(f"spark.sql.catalog.{parts[0] if len(parts) > 1 else 'spark_catalog'}", None):
        new = counted.writeTo(target).using(fmt)
        if partition_by:
            new = new.partitionedBy(*[F.col(c) for c in partition_by])
        if path is not None:
            new = new.option("path", path)
        new.createOrReplace()
        return written.get["rows"]
    staged = f"staged_{uuid.uuid4().hex}"
    writer = counted.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is None:
        _replace_table(spark, writer, parts, staged)
    else:
        _replace_folder(spark, writer, target, fmt, path.rstrip("/"), staged, bool(partition_by))
    return written.get["rows"]


def _name_parts(spark: SparkSession, name: str) -> list[str]:
    parsed = spark._jsparkSession.sessionState().sqlParser().parseMultipartIdentifier(name)
    return [parsed.apply(i) for i in range(parsed.size())]


def _quoted(parts: Sequence[str]) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _replace_table(spark: SparkSession, writer: DataFrameWriter, parts: list[str], staged: str) -> None:
    """Write beside the table ``parts`` and take its name; the old table comes back on failure."""
    target, new, old = (_quoted([*parts[:-1], x]) for x in (parts[-1], staged, f"{staged}_old"))
    try:
        writer.saveAsTable(new)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    replaces = spark.catalog.tableExists(target)
    if replaces:
        _rename(spark, target, old)
    try:
        _rename(spark, new, target)
    except BaseException:
        if replaces:
            _rename(spark, old, target)
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if replaces:
        spark.sql(f"DROP TABLE {old}")


def _rename(spark: SparkSession, table: str, name: str) -> None:
    """Rename with the data; the catalog without a metastore leaves a table's partitions behind."""
    spark.sql(f"ALTER TABLE {table} RENAME TO {name}")
    if spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        if any(column.isPartition for column in spark.catalog.listColumns(name)):
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def _replace_folder(
    spark: SparkSession, writer: DataFrameWriter, target: str, fmt: str, path: str, staged: str, partitioned: bool
) -> None:
    """Write beside the folder ``path`` and take its place; the old folder comes back on failure."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    place, new, old = (jvm.org.apache.hadoop.fs.Path(x) for x in (path, f"{path}.{staged}", f"{path}.{staged}_old"))
    files = place.getFileSystem(conf)
    try:
        writer.save(new.toString())
    except BaseException:
        files.delete(new, True)
        raise
    replaces = files.exists(place)
    if replaces and not files.rename(place, old):
        files.delete(new, True)
        raise OSError(f"cannot replace {path}")
    if not files.rename(new, place):
        if replaces:
            files.rename(old, place)
        raise OSError(f"cannot replace {path}")
    # the folder of an external table outlives its name
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.catalog.createTable(target, path=path, source=fmt)
    if partitioned:
        spark.catalog.recoverPartitions(target)
    if replaces:
        files.delete(old, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors share.

    ``ValueError`` if the session names none: a folder of one machine would not do.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
