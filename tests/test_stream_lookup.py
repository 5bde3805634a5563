from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from seqprep import LookupLimits, Vocabulary, vocabulary_keys
from seqprep.streaming.lookup import BATCH_COLUMN, lookup_new_terms, read_found

SCHEMA = "datasetkey STRING, gbifid LONG, term STRING"


def key_table(spark, name):
    return vocabulary_keys(
        Vocabulary(
            spark.createDataFrame([("1", name, None)], "id STRING, name STRING, parent_id STRING"),
            spark.createDataFrame([("1", "marker")], "concept_id STRING, label STRING"),
        )
    )


def add(spark, folder, ids):
    rows = [("d", i, [" Marker", "unknown", None][i % 3]) for i in ids]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def advance(spark, folder, vocabulary, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    lookup_new_terms(
        stream, f"{folder}/out", f"{folder}/progress", vocabulary, "term", "concept", "found", **options
    )


def concepts(spark, folder):
    return {r.gbifid: r.concept for r in read_found(spark, f"{folder}/out").collect()}


@pytest.mark.parametrize("limits", [LookupLimits(), LookupLimits(broadcast_rows=0, rows_per_slice=2)])
def test_a_swapped_vocabulary_counts_from_the_next_batch(spark, tmp_path, limits):
    folder = str(tmp_path)
    names = iter(["First", "Second", "Third"])
    calls = []

    def vocabulary(session):
        calls.append(1)
        return key_table(session, next(names))

    add(spark, folder, range(9))
    add(spark, folder, range(9, 18))
    advance(spark, folder, vocabulary, limits=limits)
    add(spark, folder, range(18, 27))
    advance(spark, folder, vocabulary, limits=limits)
    advance(spark, folder, vocabulary, limits=limits)
    rows = read_found(spark, f"{folder}/out", batches=True).collect()
    assert len(rows) == 27 and len(calls) == 3
    used = {}
    for row in rows:
        used.setdefault(row[BATCH_COLUMN], set()).add(row.concept)
    assert used == {0: {"First", None}, 1: {"Second", None}, 2: {"Third", None}}
    assert all((r.concept is not None) == (r.gbifid % 3 == 0) for r in rows)


def test_a_batch_that_fails_is_there_once(spark, tmp_path):
    folder = str(tmp_path)
    add(spark, folder, range(6))

    def broken(session):
        # rows are written before one of them fails
        return key_table(session, "Broken").withColumn(
            "concept", F.when(F.col("key") == "marker", F.raise_error(F.lit("lost"))).otherwise(F.col("concept"))
        )

    with pytest.raises(Exception, match="lost"):
        advance(spark, folder, broken)
    # a first try that came to its end, but whose end was not recorded
    key_table(spark, "Old").write.parquet(f"{folder}/out/{BATCH_COLUMN}=0")
    advance(spark, folder, lambda session: key_table(session, "Mended"))
    assert concepts(spark, folder) == {i: "Mended" if i % 3 == 0 else None for i in range(6)}


def test_without_a_vocabulary_or_a_result(spark, tmp_path):
    folder = str(tmp_path)
    add(spark, folder, range(3))
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    with pytest.raises(ValueError, match="result_column"):
        lookup_new_terms(stream, f"{folder}/out", f"{folder}/progress", lambda s: None, "term")
    advance(spark, folder, lambda session: None, on_missing="null")
    assert concepts(spark, folder) == {0: None, 1: None, 2: None}
