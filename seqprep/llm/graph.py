"""Connected components as joins: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqprep.llm.shared import materialise


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets the node's least neighbour."""
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, get its least neighbour."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """(node, component) for every node of ``edges``; a component's name is its least node.

    The number of rounds is logarithmic in practice. Each round's edges, never more
    than the input's, are checkpointed; only two numbers reach the driver.
    """
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    before = None
    while True:
        now = materialise(_small(_large(now)))
        mark = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if mark == before:
            break
        before = mark
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
