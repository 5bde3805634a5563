from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plans import assert_native, executed_plan
from seqprep import (
    LookupLimits,
    clean_sequences,
    lookup,
    process_sequences,
    register_lookup,
    register_lookup_lineage,
    register_sql,
)


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "occurrence")
    spark.createDataFrame(
        [("d", 1, "ACGTACGT", "asia", "x")],
        "datasetkey STRING, gbifid LONG, v_dnasequence STRING, v_targetgene STRING, other STRING",
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def keys(spark):
    return spark.createDataFrame(
        [("asia", "Asia", [])], "key STRING, concept STRING, lineage ARRAY<STRING>"
    )


def test_cleaning_is_one_narrow_stage(source):
    plan = executed_plan(process_sequences(source))
    assert_native(plan)
    assert "Exchange" not in plan
    # All stages in the one code generation stage of the scan, each text once.
    assert "*(1) Project" in plan and "*(2)" not in plan
    assert plan.count("upper(") == 1
    assert plan.count("regexp_extract(") == 1
    assert plan.count("encode(") == 1


def test_cleaning_reads_three_columns(source):
    plan = executed_plan(process_sequences(source))
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert schema == "struct<datasetkey:string,gbifid:bigint,v_dnasequence:string>"


def test_count_reads_no_sequence(source):
    plan = executed_plan(process_sequences(source).agg(F.count(F.lit(1))))
    assert "ReadSchema: struct<>" in plan
    assert "regexp" not in plan


def test_unused_stages_are_pruned(source):
    df = clean_sequences(source, "v_dnasequence").select("result.naturalLanguageDetected")
    flat = process_sequences(source).select("naturalLanguageDetected")
    assert "regexp_extract(" not in executed_plan(flat)
    assert_native(executed_plan(df))


def test_raw_filter_reaches_the_scan(source):
    wanted = source.where(F.col("v_dnasequence").isNotNull() & (F.col("datasetkey") == "d"))
    plan = executed_plan(process_sequences(wanted))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "IsNotNull(v_dnasequence)" in pushed and "EqualTo(datasetkey,d)" in pushed


def test_filter_on_a_passed_key_moves_below_the_cleaning(source):
    plan = executed_plan(process_sequences(source).where("datasetkey = 'd'"))
    assert "EqualTo(datasetkey,d)" in plan


def test_sql_function_is_inlined(spark, source):
    register_sql(spark)
    source.createOrReplaceTempView("plan_source")
    plan = executed_plan(
        spark.sql("SELECT gbifid, processSequence(v_dnasequence, null) AS r FROM plan_source")
    )
    assert_native(plan)
    assert "Join" not in plan and "Exchange" not in plan and "Subquery" not in plan
    # The result is built outside any branch, so shared stages run once per row.
    assert "array(named_struct(" in plan


def test_lookup_broadcasts_a_small_vocabulary(source, keys):
    df = lookup(source.select("gbifid", "v_targetgene"), "v_targetgene", keys, concept_as="c", struct_as="s")
    plan = executed_plan(df)
    assert_native(plan)
    assert plan.count("BroadcastHashJoin") == 1
    assert "LeftOuter" in plan
    assert "hashpartitioning" not in plan


def test_concept_lookup_does_not_carry_lineage(source, keys):
    plan = executed_plan(lookup(source, "v_targetgene", keys, concept_as="c"))
    assert "lineage" not in plan.split("BroadcastExchange")[1].split("Scan")[0]


def test_lookup_shuffles_a_large_vocabulary(source, keys):
    df = lookup(
        source,
        "v_targetgene",
        keys,
        concept_as="c",
        limits=LookupLimits(broadcast_rows=0, rows_per_slice=10),
    )
    plan = executed_plan(df)
    assert_native(plan)
    # Only the hot-term numbers are broadcast, to both sides.
    assert plan.count("BroadcastHashJoin") == 2
    assert "hashpartitioning(__seqprep_key" in plan and "__seqprep_slice" in plan


@pytest.mark.parametrize("register", [register_lookup, register_lookup_lineage])
def test_sql_lookup_is_a_join(spark, source, keys, register):
    source.createOrReplaceTempView("plan_source")
    keys.createOrReplaceTempView("plan_keys")
    register(spark, "planLookup", "plan_keys")
    plan = executed_plan(spark.sql("SELECT gbifid, planLookup(v_targetgene) AS c FROM plan_source"))
    assert_native(plan)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
