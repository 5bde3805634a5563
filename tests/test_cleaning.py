from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from cases import DEFAULT_CASES, OPTION_CASES
from seqprep import RESULT_TYPE, CleanOptions, clean_columns, clean_sequences, register_sql

ALL_CASES = DEFAULT_CASES + OPTION_CASES
INPUT = "name STRING, raw STRING, opts MAP<STRING, STRING>"


def frame(spark, cases):
    return spark.createDataFrame([(name, raw, opts) for name, raw, opts, _ in cases], INPUT)


def collected(df):
    return {row["name"]: row["result"] for row in df.select("name", "result").collect()}


@pytest.fixture(scope="module")
def by_path(spark):
    """Results of every case through each way to call the pipeline."""
    register_sql(spark)
    rows = frame(spark, ALL_CASES)
    rows.createOrReplaceTempView("cleaning_cases")
    sql = spark.sql("SELECT name, processSequence(raw, opts) AS result FROM cleaning_cases")
    fixed = {}
    for name, raw, opts, _ in ALL_CASES:
        one = spark.createDataFrame([(name, raw)], "name STRING, raw STRING")
        options = CleanOptions.from_map(opts)
        fixed.setdefault(options, []).append(one)
    static = {}
    for options, frames in fixed.items():
        union = frames[0]
        for other in frames[1:]:
            union = union.union(other)
        static.update(collected(clean_sequences(union, "raw", options)))
    return {
        "static": static,
        "per_row": collected(clean_sequences(rows, "raw", F.col("opts"))),
        "sql": collected(sql),
    }


def check(result, expected):
    if expected is None:
        assert result is None
        return
    assert result is not None
    assert len(result) == 14
    for field, want in expected.items():
        if want is ...:
            assert result[field] is not None, field
        else:
            assert result[field] == want, field
    if result["sequence"]:
        digest = hashlib.md5(result["sequence"].encode()).hexdigest()
        assert result["nucleotideSequenceID"] == digest
    else:
        assert result["nucleotideSequenceID"] is None


@pytest.mark.parametrize("path", ["static", "per_row", "sql"])
@pytest.mark.parametrize("case", ALL_CASES, ids=lambda case: case[0])
def test_case(by_path, path, case):
    check(by_path[path][case[0]], case[3])


@pytest.mark.parametrize("path", ["per_row", "sql"])
def test_paths_agree_on_every_field(by_path, path):
    assert by_path[path] == by_path["static"]


def test_result_schema(spark):
    df = clean_sequences(frame(spark, DEFAULT_CASES[:2]), "raw")
    assert df.columns == ["name", "raw", "opts", "result"]
    got = df.schema["result"].dataType
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in RESULT_TYPE]


def test_flat_columns_match_struct(spark):
    rows = frame(spark, DEFAULT_CASES)
    flat = {r["name"]: r for r in clean_columns(rows, "raw", keep=["name"]).collect()}
    for name, struct in collected(clean_sequences(rows, "raw")).items():
        row = flat[name].asDict()
        row.pop("name")
        if struct is None:
            assert set(row.values()) == {None}
        else:
            assert row == struct.asDict()


def test_sequence_id_is_carried(spark):
    rows = spark.createDataFrame([("id1", "ACGTACGT")], "name STRING, raw STRING")
    out = clean_sequences(rows, "raw", seq_id=F.col("name"), result="r").first()["r"]
    assert out["seqId"] == "id1"


def test_sql_call_forms(spark):
    register_sql(spark)
    row = spark.sql(
        """
        SELECT processSequence('ACGTACGTNNNNNNNACGTACGT', null) AS a,
               processSequence('ACGTACGTNNNNNNNACGTACGT') AS b,
               processSequence('ACGTACGTNNNNNNNNNNNACGTACGT',
                               map('nrunCapFrom', '10', 'nrunCapTo', '5')) AS c,
               processSequence('ACGTACGTNNNNNNNACGTACGT',
                               map('nrunCapFrom', '10')).sequence AS d,
               processSequence(null, null) AS e
        """
    ).first()
    assert row["a"] == row["b"]
    assert row["a"]["sequence"] == "ACGTACGTNNNNNACGTACGT"
    assert row["c"]["sequence"] == "ACGTACGTNNNNNACGTACGT"
    assert row["d"] == "ACGTACGTNNNNNNNACGTACGT"
    assert row["e"] is None


def test_other_function_name(spark):
    register_sql(spark, "clean_seq")
    assert spark.sql("SELECT clean_seq('acgtacgt').sequence").first()[0] == "ACGTACGT"


@pytest.mark.parametrize("field", ["anchor_minrun", "nrun_cap_from", "nrun_cap_to"])
def test_negative_options_are_rejected(field):
    with pytest.raises(ValueError):
        CleanOptions(**{field: -1})


def test_negative_cap_fails_per_row_too(spark):
    rows = frame(spark, [("n", "ACGTACGTNNNNNNNACGTACGT", {"nrunCapTo": "-1"}, None)])
    with pytest.raises(Exception, match="nrunCapTo"):
        clean_sequences(rows, "raw", F.col("opts")).collect()


def test_options_from_map():
    assert CleanOptions.from_map(None) == CleanOptions() == CleanOptions.from_map({})
    custom = CleanOptions.from_map({"anchorMinrun": "4", "iupacDna": "ACGT", "other": "x"})
    assert custom == CleanOptions(anchor_minrun=4, iupac_dna="ACGT")


def test_column_names_with_special_characters(spark):
    rows = spark.createDataFrame([("ACGTACGT", 1)], "`raw seq` STRING, `a.b` INT")
    out = clean_sequences(rows, "raw seq")
    assert out.columns == ["raw seq", "a.b", "result"]
    assert out.first()["result"]["sequence"] == "ACGTACGT"


def test_runs_on_a_stream(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    frame(spark, DEFAULT_CASES).write.parquet(source)
    stream = spark.readStream.schema(INPUT).parquet(source)
    query = (
        clean_sequences(stream, "raw")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination(120)
    batch = clean_sequences(spark.read.parquet(source), "raw")
    assert collected(spark.read.parquet(sink)) == collected(batch)


@pytest.mark.parametrize("option", ["nrunCapTo", "nrunCapFrom", "anchorMinrun"])
def test_negative_numbers_fail_on_every_row(spark, option):
    row = spark.createDataFrame([("ACGTACGT", {option: "-1"})], "dna STRING, opts MAP<STRING, STRING>")
    with pytest.raises(ValueError, match="negative"):
        CleanOptions.from_map({option: "-1"})
    with pytest.raises(Exception, match="must not be negative"):
        clean_sequences(row, "dna", F.col("opts")).collect()


def test_generated_code_stays_small_enough_to_compile(spark):
    """The JVM leaves methods beyond 8,000 bytes uncompiled."""
    rows = spark.createDataFrame([("ACGT", {"nrunCapTo": "3"}, 1)], "dna STRING, opts MAP<STRING, STRING>, id INT")
    cleaned = clean_sequences(rows, "dna", F.col("opts"))
    text = cleaned._jdf.queryExecution().debug().codegenToSeq().toString()
    sizes = [int(x) for x in re.findall(r"ByteCodeStats\((\d+)", text)]
    assert sizes and max(sizes) < 8000
