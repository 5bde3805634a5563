"""Every registered query against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from validation import oracle, registry

SF_DIR = "/root/testdata/sf0.001"
SPARK_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}
#: The optional subpackage tests its own queries.
QUERIES = registry.queries()
ORACLES = oracle.ORACLE_SQL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        if file.endswith(".parquet"):
            name = file.removesuffix(".parquet")
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    yield connection
    connection.close()


def test_contract_has_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_every_query_has_an_oracle():
    # a quantile sketch is within an error of the exact ranks: test_reports.py measures it
    assert set(QUERIES) - {"length_quantiles"} == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(ORACLES[name])
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {n: SPARK_TYPES[t] for n, t in df.dtypes} == types
    columns = sorted(df.columns)
    got = sorted(repr([row[c] for c in columns]) for row in df.collect())
    order = [relation.columns.index(c) for c in columns]
    want = sorted(repr([row[i] for i in order]) for row in relation.fetchall())
    assert got == want
    assert got or name == "vocab_ambiguous_keys"


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["datasetkey", "gbifid", "cleaned_sequence"]
