from __future__ import annotations

import sys

import numpy as np
import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import with_clashes

from seqprep.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    base = np.array([v for _, v in rows], float)
    out = {}
    for i, q in rows:
        if i % 50 == 0:
            score = base @ np.array(q, float) / np.linalg.norm(base, axis=1) / np.linalg.norm(q)
            out[i] = [(ids[j], score[j]) for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != i][:k]
    return out


@pytest.mark.parametrize("shard_rows, query_rows", [(16_384, 4_096), (700, 10)])
def test_recall(spark, monkeypatch, shard_rows, query_rows):
    monkeypatch.setattr(ann, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(ann, "QUERY_ROWS", query_rows)
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(32).astype(np.float32).tolist()) for i in range(2000)]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA)).repartition(4)
    got = ann.nearest(df, df.where("vec_id % 50 = 0")).collect()
    want = brute(rows, 5)
    assert len(got) == 5 * len(want)
    hits = sum(any(r.vec_id == v for v, _ in want[r.query_id]) for r in got)
    assert hits >= 0.9 * len(got)
    for q in want:
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(a.score >= b.score for a, b in zip(mine, mine[1:]))


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 300, 3)]  # many identical vectors
    rows += [(50, [1.0, 0.0, 0.0]), (1, [2.0, 0.1, 0.0]), (2, [1e-30, 1e-32, 0.0])]
    rows += [(4, None), (5, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]), (8, [nan, 1.0, 0.0]), (10, [inf, 1.0, 0.0])]
    rows += [(None, [1.0, 0.0, 0.0]), (100, [1.0, 0.0]), (50, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = ann.nearest(df, df.where("vec_id % 50 = 0")).collect()
    of = lambda q: [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
    assert of(50)[:2] == [2, 1] and of(50)[2:] == [0, 3, 6]
    assert of(0) == [3, 6, 9, 12, 15] and of(150) == [0, 3, 6, 9, 12]
    assert of(100) == []  # the only vector of its length
    assert {r.vec_id for r in got}.isdisjoint({4, 5, 7, 8, 10, None})


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ann.nearest(df, df).collect() == []
