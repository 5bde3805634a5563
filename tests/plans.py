"""Helpers to look at physical plans."""

from __future__ import annotations

from pyspark.sql import DataFrame


def executed_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def assert_native(plan: str) -> None:
    for node in ("PythonUDF", "ArrowEval", "BatchEval", "MapInPandas", "ScalaUDF", "CartesianProduct"):
        assert node not in plan, node
    assert "BroadcastNestedLoopJoin" not in plan
