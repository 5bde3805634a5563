"""Approximate nearest neighbours by a forest of hash prefixes.

Every row lies in one shard, and every query goes to all shards. A shard keeps, for
each tree, a sorted array of its vectors' hash strings (bits of random hyperplanes). A
query descends every tree to its longest prefix match; then all trees ascend together,
one bit at a time, until the vectors that share the prefix are enough. These
candidates are compared exactly, in double precision, and only a query's best few
leave the shard.

Rows and queries meet in blocks of bounded size: ``SHARD_ROWS`` rows with
``QUERY_ROWS`` queries. How far the trees ascend is a share of the shard
(``SHARE``), and in small shards at least a number, so recall holds at every size; the README has the measured recall.

Cases: vectors that are null, zero, or hold a null or non-finite component take no
part, nor do rows without an id. Rows with the same id count as one, with the vector
that comes first in order. Only vectors of one length are compared with each other.
Identical vectors are hashed once and all compared. Ties go to the smaller id. With
fewer candidates than asked for, all that are found are returned. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqprep.llm.shared import materialise, quoted, table

TREES = 96
#: Bits of a hash string.
DEPTH = 24
SHARD_ROWS = 16_384
QUERY_ROWS = 4_096
#: Vectors met by the ascending trees, in shares of the shard (a vector counts in each tree).
SHARE = 0.35
#: But at least so many: the nearest of few rows are not near, and share short prefixes only.
LEAST_MET = 6_000
OUT = "query_id long, vec_id long, score double"


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Every vector times a power of two, so that no square over- or underflows."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    return np.ldexp(vectors, -exponent[:, None])


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row by row in the same order of additions, so equal vectors score the same."""
    dots = (rows * query).sum(axis=1)
    return dots / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def codes(vectors: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """The hash string of every vector in every tree, as a number of ``DEPTH`` bits."""
    planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], trees * DEPTH))
    bits = (vectors @ planes > 0).reshape(len(vectors), trees, DEPTH)
    return bits @ (1 << np.arange(DEPTH - 1, -1, -1, dtype=np.int64))


def forest_candidates(base: np.ndarray, queries: np.ndarray, share: float, trees: int, seed: int = 17):
    """For each query the rows of ``base`` that the ascending trees have met."""
    n = len(base)
    own, asked = codes(base, trees, seed), codes(queries, trees, seed)
    order = np.argsort(own, axis=0, kind="stable")
    ranked = np.take_along_axis(own, order, axis=0)
    lows = np.empty((DEPTH + 1, trees, len(queries)), np.int64)
    highs = np.empty_like(lows)
    for d in range(DEPTH + 1):
        rest = DEPTH - d
        low = (asked >> rest) << rest
        for t in range(trees):
            lows[d, t] = np.searchsorted(ranked[:, t], low[:, t])
            highs[d, t] = np.searchsorted(ranked[:, t], low[:, t] + (1 << rest))
    met = (highs - lows).sum(axis=1)  # by depth and query; falls with depth
    enough = met >= np.minimum(met[0], max(share * n, LEAST_MET))
    depth = DEPTH - np.argmax(enough[::-1], axis=0)
    for q in range(len(queries)):
        d = depth[q]
        seen = np.zeros(n, bool)
        for t in range(trees):
            seen[order[lows[d, t, q] : highs[d, t, q], t]] = True
        yield np.flatnonzero(seen)


def _searching(k: int, share: float, trees: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        asked = frame[frame["is_query"]]
        rows = frame[~frame["is_query"]].sort_values("vec_id")
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if asked.empty or rows.empty:
            return empty
        vectors = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
        queries = scaled(np.stack(asked["embedding"].to_numpy()).astype(np.float64))
        base, place = np.unique(vectors, axis=0, return_inverse=True)
        base = scaled(base)
        ids = rows["vec_id"].to_numpy()
        # of identical vectors only the k + 1 smallest ids can be among the nearest
        by_vector = np.argsort(place.ravel(), kind="stable")
        first = np.searchsorted(place.ravel()[by_vector], np.arange(len(base) + 1))
        unit = base / np.sqrt((base * base).sum(axis=1))[:, None]
        out = []
        found = forest_candidates(base, queries, share, trees)
        for query_id, query, near in zip(asked["vec_id"].to_numpy(), queries, found):
            rough = unit[near] @ (query / np.sqrt((query * query).sum()))
            if len(near) > k + 1:
                edge = np.partition(rough, len(near) - k - 1)[len(near) - k - 1]
                near = near[rough >= edge - 1e-9]
            score = cosines(base[near], query)
            sizes = np.minimum(np.diff(first)[near], k + 1)
            at = np.repeat(first[near] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            vec, value = ids[by_vector[at]], np.repeat(score, sizes)
            other = vec != query_id
            vec, value = vec[other], value[other]
            best = np.lexsort((vec, -value))[:k]
            out.append(pd.DataFrame({"query_id": query_id, "vec_id": vec[best], "score": value[best]}))
        return pd.concat(out) if out else empty

    return run


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    share: float = SHARE,
    trees: int = TREES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``df`` found for each query.

    Nearness is the largest cosine. A query is not its own neighbour.
    """

    def usable(rows: DataFrame) -> DataFrame:
        one = rows.select(
            F.col(quoted(vec_id)).cast("long").alias("vec_id"), F.col(quoted(embedding)).cast("array<double>").alias("embedding")
        ).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        other = F.exists("embedding", lambda x: x != 0)
        return one.where(finite & other).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dims", F.size("embedding"))

    base, asked = materialise(usable(df)), usable(queries)
    shards = max(1, -(-base.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    rows = base.select(
        "dims",
        F.expr(f"pmod(xxhash64(vec_id), {shards})").alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        "vec_id",
        "embedding",
        F.lit(False).alias("is_query"),
    )
    sent = asked.select(
        "dims",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.expr(f"pmod(xxhash64(vec_id, 1), {blocks})").alias("block"),
        "vec_id",
        "embedding",
        F.lit(True).alias("is_query"),
    )
    found = rows.unionByName(sent).groupBy("dims", "shard", "block").applyInPandas(_searching(k, share, trees), OUT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# --- query ---------------------------------------------------------------------------


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every embedding whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 50 = 0"))
