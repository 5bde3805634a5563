from __future__ import annotations

import random
import re
import sys
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import changed, prose, with_clashes

from seqprep.llm import graph, jaccard_join


def brute(rows, width, percent):
    """{row number: (set size, component)} by comparing all pairs."""
    sets = []
    for _, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        if 0 < len(words) < width:
            sets.append({tuple(words)})
        else:
            sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)})
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    least = {r: min((k for k in ks if k is not None), default=None) for r, ks in members.items()}
    return [(rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows))]


def some_rows():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(6, 150)) for _ in range(60)]
    texts = base + [changed(rng, rng.choice(base), rng.randint(0, 4)) for _ in range(80)]
    hot = prose(rng, 120)
    texts += [changed(rng, hot, rng.randint(0, 5)) for _ in range(60)] + [hot] * 20
    shared = prose(rng, 40)
    texts += [f"{prose(rng, 60)} {shared} {prose(rng, 50)}" for _ in range(40)]
    texts += [None, "", " \t\n", "One", "one", "one two", "ONE  two", "one two three four", "é è", "É è"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + rows[:3] + [(None, hot), (None, "nothing like it at all here")]


@pytest.mark.parametrize("width, percent, block", [(4, 85, 2_000_000), (5, 80, 700), (3, 50, 2_000_000)])
def test_against_all_pairs(spark, monkeypatch, width, percent, block):
    monkeypatch.setattr(jaccard_join, "VERIFY_TOKENS", block)
    rows = some_rows()
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = jaccard_join.jaccard_components(df, width=width, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    found = sorted(map(str, (tuple(r)[:3] for r in got.collect())))
    assert found == sorted(map(str, brute(rows, width, percent)))


def test_links_are_counted_once_where_blocks_are_empty(spark, monkeypatch):
    tokens = np.arange(20, dtype=np.uint64) << np.uint64(16)
    packed = tokens.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
    frame = pd.DataFrame({"node": [1, 2], "component": 1, "block": 0, "i": 0, "n": 20, "tokens": [packed, packed]})
    link = jaccard_join._linking(85)
    assert link(frame.assign(j=0))["links"].tolist() == [1, 1]
    assert link(frame.assign(j=1)).empty
    monkeypatch.setattr(jaccard_join, "VERIFY_TOKENS", 40)
    rng = random.Random(4)
    base = prose(rng, 90).split()
    # four different near copies, two of them also as exact copies: each set links with three
    texts = [" ".join([*base, *more]) for more in ([], ["one"], ["two"], ["three"])]
    rows = list(enumerate([*texts, texts[1], texts[2], prose(rng, 90)]))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.component_id, r.n_links) for r in got} == {**{i: (0, 3) for i in range(6)}, 6: (6, 0)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.jaccard_components(df).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 300).selectExpr("id AS u", "id - 1 AS v").repartition(7)
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {i: 0 for i in range(300)}
