from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cases import DEFAULT_CASES
from seqprep import (
    LookupLimits,
    Vocabulary,
    lookup_job,
    lookup_terms,
    process_sequences,
    process_sequences_job,
    register_sql,
    vocabulary_keys,
)
from seqprep.sources.tables import read_table, shared_folder, write_table
from validation.registry import CTAS_SELECT

JOB_COLUMNS = [
    "datasetkey",
    "gbifid",
    "cleaned_sequence",
    "sequenceLength",
    "nonIupacFraction",
    "nonACGTNFraction",
    "nFraction",
    "nNrunsCapped",
    "gcContent",
    "naturalLanguageDetected",
    "endsTrimmed",
    "gapsOrWhitespaceRemoved",
    "nucleotideSequenceID",
    "invalid",
]


@pytest.fixture(scope="module")
def source(spark):
    rows = [("d", i, raw, term, "unused") for i, ((_, raw, _, _), term) in enumerate(
        zip(DEFAULT_CASES, ["Gene", "coi", None, "none"] * 10)
    )]
    spark.createDataFrame(
        rows,
        "datasetkey STRING, gbifid LONG, v_dnasequence STRING, v_targetgene STRING, other STRING",
    ).write.mode("overwrite").saveAsTable("occurrence")
    return "occurrence"


@pytest.fixture(scope="module")
def vocabulary(spark):
    return Vocabulary(
        spark.createDataFrame(
            [("1", "Gene", None), ("2", "COI", "1")], "id STRING, name STRING, parent_id STRING"
        )
    )


def test_process_sequences_job(spark, source):
    # Twice: the second run replaces the table.
    for _ in range(2):
        written = process_sequences_job(spark, source, "cleaned")
    table = spark.table("cleaned")
    assert written == len(DEFAULT_CASES) == table.count()
    assert table.columns == JOB_COLUMNS
    rows = {row["gbifid"]: row for row in table.collect()}
    for i, (_, raw, _, expected) in enumerate(DEFAULT_CASES):
        values = rows[i].asDict()
        if raw is None:
            assert all(values[name] is None for name in JOB_COLUMNS[2:])
        elif "sequence" in expected:
            assert values["cleaned_sequence"] == expected["sequence"]
    schema = {f.name: f.dataType.simpleString() for f in table.schema}
    assert schema["sequenceLength"] == schema["nNrunsCapped"] == "int"
    assert schema["gcContent"] == "double" and schema["invalid"] == "boolean"
    assert schema["gbifid"] == "bigint"


def test_job_with_other_columns_options_and_format(spark):
    spark.createDataFrame([(7, "ACGTNNNNACGT")], "k INT, s STRING").createOrReplaceTempView("other")
    written = process_sequences_job(
        spark, "other", "cleaned_other", "orc", "s", ["k"], {"anchorMinrun": "1", "nrunCapFrom": "3"}
    )
    row = spark.table("cleaned_other").first()
    assert written == 1
    assert row["k"] == 7 and row["cleaned_sequence"] == "ACGTNNNNNACGT"


def test_jobs_fail_on_an_absent_source(spark, vocabulary):
    with pytest.raises(ValueError, match="not found"):
        process_sequences_job(spark, "absent_table", "never_written")
    with pytest.raises(ValueError, match="not found"):
        lookup_job(spark, "absent_table", "never_written", vocabulary, "v_targetgene", "c")
    assert not spark.catalog.tableExists("never_written")


def test_lookup_job_needs_a_result_column(spark, vocabulary):
    # Checked first: not even the absent source is noticed.
    with pytest.raises(ValueError, match="result_column"):
        lookup_job(spark, "absent_table", "never_written", vocabulary, "v_targetgene")
    assert not spark.catalog.tableExists("never_written")


def test_lookup_job(spark, source, vocabulary):
    written = lookup_job(
        spark, source, "looked_up", vocabulary, "v_targetgene", "target_gene", "target_gene_struct"
    )
    table = spark.table("looked_up")
    assert table.columns == [
        "datasetkey",
        "gbifid",
        "raw_v_targetgene",
        "target_gene",
        "target_gene_struct",
    ]
    assert written == table.count() == len(DEFAULT_CASES)
    for row in table.collect():
        want = {"Gene": ("Gene", []), "coi": ("COI", ["Gene"])}.get(row["raw_v_targetgene"])
        found = row["target_gene_struct"]
        assert row["target_gene"] == (want and want[0])
        assert (found and tuple(found)) == want


def test_lookup_job_with_one_result(spark, source, vocabulary):
    lookup_job(spark, source, "looked_up_one", vocabulary, "v_targetgene", None, "s")
    assert spark.table("looked_up_one").columns == ["datasetkey", "gbifid", "raw_v_targetgene", "s"]
    lookup_job(
        spark, source, "looked_up_null", None, "v_targetgene", "c", on_missing="null"
    )
    assert spark.table("looked_up_null").where("c IS NOT NULL").count() == 0


def test_create_table_as_select(spark, source):
    register_sql(spark)
    select = CTAS_SELECT.replace("{occurrences}", source)
    spark.sql(f"CREATE TABLE ctas_sequences USING parquet AS {select}")
    job = process_sequences_job(spark, source, "cleaned_for_ctas")
    columns = ["gbifid", "sequenceLength", "nFraction", "endsTrimmed"]
    ctas = spark.table("ctas_sequences")
    assert ctas.count() == job - 1
    same = spark.table("cleaned_for_ctas").where("sequenceLength IS NOT NULL")
    same = same.select(*columns, same["cleaned_sequence"].alias("sequence"))
    ctas = ctas.select(same.columns)
    assert ctas.exceptAll(same).isEmpty() and same.exceptAll(ctas).isEmpty()


def test_job_passes_its_limits_on(spark, source, vocabulary, monkeypatch):
    from seqprep.plans import vocabulary_lookup as plan

    seen = []
    real = plan.vocabulary_keys
    monkeypatch.setattr(plan, "vocabulary_keys", lambda *a: seen.append(a[2]) or real(*a))
    limits = LookupLimits(broadcast_rows=0)
    lookup_job(spark, source, "looked_up_limited", vocabulary, "v_targetgene", "c", limits=limits)
    assert seen == [limits]


def test_columns_with_dots(spark, vocabulary):
    rows = spark.createDataFrame([("k", "ACGTACGT", "Gene")], ["my.key", "my.dna", "my.term"])
    cleaned = process_sequences(rows, "my.dna", ["my.key"]).first()
    assert cleaned["my.key"] == "k" and cleaned["cleaned_sequence"] == "ACGTACGT"
    found = lookup_terms(rows, vocabulary_keys(vocabulary), "my.term", "c", keys=["my.key"])
    assert found.columns == ["my.key", "raw_my.term", "c"] and found.count() == 1


def test_shared_folder_must_be_named(spark):
    class Session:
        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_partitioned_sink(spark, source):
    assert write_table(spark.table(source), "by_dataset", partition_by=["datasetkey"]) == len(DEFAULT_CASES)
    assert spark.table("by_dataset").where("datasetkey = 'd'").count() == len(DEFAULT_CASES)


def test_read_table_accepts_views(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert read_table(spark, "three").count() == 3


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured in shared_folder(spark)


def test_command_line(spark, source, vocabulary, capsys):
    import run_job

    vocabulary.concepts.createOrReplaceTempView("cli_concept")
    assert run_job.main(["process-sequences", "-s", source, "-t", "cli_cleaned"]) == len(DEFAULT_CASES)
    assert spark.table("cli_cleaned").columns == JOB_COLUMNS
    options = ["lookup", "-s", source, "-t", "cli_found", "--concept-table", "cli_concept"]
    options += ["-c", "v_targetgene"]
    with pytest.raises(SystemExit, match="result-column"):
        run_job.main(options)
    run_job.main(options + ["-r", "gene", "--result-concept-column", "s"])
    assert spark.table("cli_found").columns[2:] == ["raw_v_targetgene", "gene", "s"]
    missing = ["lookup", "-s", source, "-t", "cli_missing", "-c", "v_targetgene", "-r", "gene", "-k", "gbifid"]
    with pytest.raises(ValueError, match="no vocabulary"):
        run_job.main(missing)
    for table in ([], ["--concept-table", "no_such_table"]):
        run_job.main([*missing, *table, "--on-missing", "null"])
        assert spark.table("cli_missing").columns == ["gbifid", "raw_v_targetgene", "gene"]
    run_job.main([*missing, "--concept-table", "cli_concept", "--exact"])
    assert spark.table("cli_missing").where("raw_v_targetgene = 'coi' AND gene IS NOT NULL").isEmpty()
    run_job.main(["process-sequences", "-s", source, "-t", "cli_options", "-o", "anchorMinrun=2"])
    assert spark.table("cli_options").count() == len(DEFAULT_CASES)
    assert f"{len(DEFAULT_CASES)} rows" in capsys.readouterr().out


def failing(spark):
    """Rows of which one cannot be computed."""
    return spark.range(1000).repartition(4).select(
        F.when(F.col("id") == 777, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id")
    )


def tables(spark):
    return {t.name for t in spark.catalog.listTables()}


def test_failed_replace_leaves_the_old_table(spark):
    write_table(spark.range(5), "kept")
    before = tables(spark)
    with pytest.raises(Exception, match="lost"):
        write_table(failing(spark), "kept")
    assert sorted(r.id for r in spark.table("kept").collect()) == [0, 1, 2, 3, 4]
    assert tables(spark) == before
    with pytest.raises(Exception, match="lost"):
        write_table(failing(spark), "never_made")
    assert tables(spark) == before


def test_replace_with_another_schema_and_from_itself(spark):
    write_table(spark.range(5), "changed_table")
    assert write_table(spark.table("changed_table").select((F.col("id") * 2).alias("twice")), "changed_table") == 5
    spark.catalog.refreshTable("changed_table")
    assert sorted(r.twice for r in spark.table("changed_table").collect()) == [0, 2, 4, 6, 8]
    assert write_table(spark.range(3).withColumn("part", F.col("id") % 2), "changed_table", partition_by=["part"]) == 3
    assert spark.table("changed_table").where("part = 1").count() == 1
    # one partitioned table after another: the old partitions go, the new ones stay
    assert write_table(spark.range(9).withColumn("part", F.col("id") % 2), "changed_table", partition_by=["part"]) == 9
    assert spark.table("changed_table").where("part = 1").count() == 4 and spark.table("changed_table").count() == 9
    with pytest.raises(Exception, match="lost"):
        write_table(failing(spark), "changed_table")
    assert spark.table("changed_table").count() == 9


def test_replaced_folder(spark, tmp_path):
    path = str(tmp_path / "rows")
    assert write_table(spark.range(4).withColumn("part", F.col("id") % 2), "in_folder", partition_by=["part"], path=path) == 4
    with pytest.raises(Exception, match="lost"):
        write_table(failing(spark), "in_folder", path=path)
    assert spark.table("in_folder").where("part = 0").count() == 2
    assert write_table(spark.range(7), "in_folder", path=path) == 7
    assert spark.table("in_folder").count() == 7 == spark.read.parquet(path).count()
    assert [p.name for p in tmp_path.iterdir()] == ["rows"]


def test_own_catalog_replaces_in_one_commit(spark, monkeypatch):
    from unittest import mock

    from seqprep.sources import tables as module

    calls = mock.MagicMock()
    frame = spark.range(2)
    monkeypatch.setattr(type(frame), "writeTo", lambda self, name: calls(name))
    monkeypatch.setattr(module, "Observation", mock.MagicMock())
    monkeypatch.setattr(type(frame), "observe", lambda self, *a: self)
    spark.conf.set("spark.sql.catalog.lake", "none.such.Catalog")
    try:
        write_table(frame, "lake.db.rows", "iceberg")
    finally:
        spark.conf.unset("spark.sql.catalog.lake")
    calls.assert_called_once_with("lake.db.rows")
    calls.return_value.using.assert_called_once_with("iceberg")
    calls.return_value.using.return_value.createOrReplace.assert_called_once_with()
