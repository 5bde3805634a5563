from __future__ import annotations

import random
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import prose, with_clashes

from seqprep.llm import toxicity
from seqprep.llm.arrays import flat

BAD = ["scoundrel", "blockhead", "numbskull"]


def letters(text):
    return text.translate(str.maketrans("0123456789", "abcdefghij"))


def labelled(n=400):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        toxic = i % 8 == 0
        words = letters(prose(rng, rng.randint(5, 60))).split()
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_scores_and_edge_cases(spark):
    rows = labelled()
    df = spark.createDataFrame([*rows, (None, None, 1), (1000, "x", None), (8, rows[8][1], 1)], "doc_id long, text string, toxic int")
    model = toxicity.learn(df)
    rng = random.Random(9)
    asked = [
        (1, "you Blockheads and scoundrel"),
        (2, letters(prose(rng, 50))),
        (3, None),
        (4, ""),
        (1, "you Blockheads and scoundrel"),
        (None, "word " * 20_000 + " numbskull scoundrel scoundrels"),
    ]
    docs = with_clashes(spark.createDataFrame(asked, "doc_id long, text string"))
    got = toxicity.score_toxicity(docs, model, ["doc_id", "Node"]).collect()
    score = {r.doc_id: r.score for r in got}
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert score[1] >= 0.3 and score[None] >= 0.3
    assert max(score[2], score[3], score[4]) < 0.3 and score[3] == score[4]
    assert all(e.label == 1 for r in got if r.doc_id == 1 for e in r.evidence)


def plain_terms(text):
    words = re.findall(r"[a-z]+", text.lower())
    return Counter([("word", w) for w in words] + [(n, w[:n]) for w in words for n in (4, 5) if len(w) > n])


def test_terms_and_neighbours_against_brute_force(spark):
    rows = labelled()
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    counts = [plain_terms(t) for _, t, _ in rows]
    label = np.array([y for _, _, y in rows])
    n, toxic = len(rows), label.sum()
    idf = {}
    for term in set().union(*counts):
        held = np.array([term in c for c in counts])
        a, b = (held & (label == 1)).sum(), (held & (label == 0)).sum()
        table = np.array([[a, b], [toxic - a, n - toxic - b]])
        expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / n
        g = 2 * (table * np.log(np.where(table > 0, table / np.maximum(expected, 1e-300), 1))).sum()
        if a >= 3 and ((a + 0.5) / (toxic + 1)) / ((b + 0.5) / (n - toxic + 1)) >= 4 and g >= toxicity.LEAST_G:
            idf[term] = np.log((1 + n) / (1 + a + b)) + 1
    assert 0 < len(idf) == len(model.vectors.terms)

    def vector(count):
        found = {t: (1 + np.log(k)) * idf[t] for t, k in count.items() if t in idf}
        norm = np.sqrt(sum(x * x for x in found.values()))
        return {t: x / norm for t, x in found.items()}

    vectors = [vector(c) for c in counts]
    asked = [t for _, t, _ in rows] + ["scoundrel blockhead", "Numbskulls numbskull word", "none of these"]
    first, term, weight = model.vectors(*flat(pa.array(asked)))
    for a, b, text in zip(first[:-1], first[1:], asked):
        mine = vector(plain_terms(text))
        every = sorted((sum(x * v.get(t, 0.0) for t, x in mine.items()) for v in vectors), reverse=True)
        want = [x for x in every[: toxicity.NEIGHBOURS] if x > 0]
        found, cosines = model.index.nearest(term[a:b], weight[a:b], toxicity.NEIGHBOURS)
        assert np.allclose(cosines, want) and len(set(found.tolist())) == len(found)


def test_blocks_that_are_passed_over_lose_no_neighbour():
    rng = np.random.default_rng(5)
    terms, n = 40, 1_000
    dense = rng.random((n, terms)) * (rng.random((n, terms)) < 0.1)
    dense[::7] = dense[0]  # ties
    norm = np.sqrt((dense * dense).sum(1, keepdims=True))
    dense = np.divide(dense, norm, out=dense, where=norm > 0)
    row, term = np.nonzero(dense)
    first = np.searchsorted(row, np.arange(n + 1))
    index = toxicity.Index(first, term, dense[row, term], np.zeros(n), np.arange(n), terms)
    for i in range(0, n, 13):
        t = np.flatnonzero(dense[i])
        _, cosines = index.nearest(t, dense[i, t], 9)
        every = np.sort(dense @ dense[i])[::-1][:9]
        assert np.allclose(cosines, every[every > 0])
        own = np.flatnonzero(index.ids == i)
        if len(own):
            found, cosines = index.nearest(t, dense[i, t], 9, int(own[0]))
            rest = np.sort(np.delete(dense @ dense[i], i))[::-1][:9]
            assert own[0] not in found and np.allclose(cosines, rest[rest > 0])


def test_the_sample_is_bounded_by_texts(spark):
    rows = [(i, "the one text" if i % 3 == 0 else f"text {i}", int(i % 10 == 1)) for i in range(3_000)]
    df = spark.createDataFrame([*rows, (None, None, 0)], "doc_id long, text string, toxic int")
    sample, sizes = toxicity.examples_of(df, "text", "toxic", "doc_id", None, 200)
    got = sample.collect()
    assert len(got) == 200 == len({r.text for r in got}) and sum(r.label for r in got) == 100
    want = {}
    for _, text, toxic in [*rows, (None, "", 0)]:
        want[text] = max(toxic, want.get(text, 0))
    assert sizes == Counter(want.values())
    assert all(want[r.text] == r.label for r in got)


def test_labels_of_a_table_of_their_own(spark):
    rows = labelled()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    marks = [(i, y) for i, _, y in rows] + [(0, 0), (0, None), (9_999, 1), (None, 1)]
    model = toxicity.learn(docs, labels=spark.createDataFrame(marks, "doc_id long, toxic int"))
    same = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert set(model.vectors.terms.tolist()) == set(same.vectors.terms.tolist())
    assert np.array_equal(model.value, same.value)


def test_without_labels_and_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, toxic int")
    model = toxicity.learn(none)
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    assert [r.score for r in toxicity.score_toxicity(docs, model, ["doc_id"]).collect()] == [0.0, 0.0]
    assert toxicity.score_toxicity(docs.limit(0), model, ["doc_id"]).collect() == []
