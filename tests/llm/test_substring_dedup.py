from __future__ import annotations

import random
import sys

import numpy as np
import pyarrow as pa

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import changed, prose, with_clashes

from seqprep.llm import substring_dedup as sd


def test_repeated_passages(spark):
    rng = random.Random(8)
    common, rare, near = prose(rng, 55, 10**6), prose(rng, 80, 10**6), prose(rng, 120, 10**6)
    texts = {}
    for i in range(60):
        texts[i] = prose(rng, 100, 10**6)
        if i % 3 == 0:
            texts[i] = f"{prose(rng, 30, 10**6)} {common} {texts[i]}"
    texts[100] = f"{prose(rng, 10, 10**6)} {rare}"
    texts[101] = f"{rare.upper()} {prose(rng, 500, 10**6)}"
    texts[102], texts[103] = near, changed(rng, near, 1)
    texts[104] = texts[105] = prose(rng, 70, 10**6)
    texts[106] = texts[107] = "too short to be a passage"
    texts[108], texts[109] = None, ""
    rows = [*texts.items(), (5, texts[5]), (None, texts[100])]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string")).repartition(4)
    got = sd.repeated_passages(df).collect()
    found = {r.doc_id for r in got}
    assert found == {*range(0, 60, 3), 5, 100, 101, 102, 103, 104, 105, None}
    for i in range(0, 60, 3):
        (one,) = [r for r in got if r.doc_id == i]
        assert (one.start_word, one.end_word) == (30, 85) and one.other % 3 == 0
    assert {(r.start_word, r.end_word, r.other) for r in got if r.doc_id in (104, 105)} == {(0, 70, 104), (0, 70, 105)}


def test_repeats_in_a_large_group_of_unlike_texts(spark):
    rng = random.Random(21)
    phrase = prose(rng, 30, 10**6)
    # a phrase that is too short to be a passage, in many texts; two each repeat some more of it
    rows = []
    for i in range(40):
        tail = prose(rng, 21, 10**6)
        rows += [(2 * i + k, f"{prose(rng, 60, 10**6)} {phrase} {tail} {prose(rng, 20, 10**6)}") for k in range(2)]
    rows += [(1000 + i, f"{prose(rng, 40, 10**6)} {phrase} {prose(rng, 40, 10**6)}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.start_word, r.end_word, r.other) for r in sd.repeated_passages(df).collect()}
    assert got == {(i, 60, 111, i ^ 1) for i in range(80)}


def test_texts_that_share_a_phrase_only_are_never_compared(spark, monkeypatch):
    rng = random.Random(23)
    phrase = prose(rng, 30, 10**6)
    compared = []
    pairs_of = sd._pairs
    monkeypatch.setattr(sd, "_pairs", lambda *a: compared.append(pairs_of(*a).count()) or pairs_of(*a))
    rows = [(i, f"{prose(rng, 60, 10**6)} {phrase} {prose(rng, 60, 10**6)}") for i in range(500)]
    rows += [(i, prose(rng, 40, 10**6) + " " + prose(random.Random(24), 50, 10**6)) for i in (1000, 1001)]
    got = {r.doc_id for r in sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {1000, 1001} and sum(compared) < 10


def test_near_copies_without_a_partner_are_not_compared_with_the_whole_group(spark, monkeypatch):
    rng = random.Random(27)
    base, rows = prose(rng, 200, 10**6).split(), []
    # copies of one text, changed too often for a passage but in their last 70 words; what was changed is also found elsewhere
    for i in range(120):
        words = list(base)
        for at in range(rng.randrange(5, 20), 130, 18):
            words[at] = f"own{i}x{at}"
        own = [" ".join(words[at - 4 : at + 9]) for at in range(5, 130) if words[at] != base[at]]
        rows.append((i, " ".join(words)))
        rows.append((1000 + i, " ".join(f"{prose(rng, 30, 10**6)} {x}" for x in own)))
    compared = []
    hulls = sd._hulls
    monkeypatch.setattr(sd, "_hulls", lambda *a: compared.append(hulls(*a).count()) or hulls(*a))
    got = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id for r in got} == set(range(120))
    assert all(r.start_word >= 95 and r.end_word == 200 for r in got)
    # all pairs of the copies are 7140; heads compared with the whole group made 18296
    assert sum(compared) < 7140 // 2


def test_texts_that_repeat_words_are_not_compared_with_the_whole_group(spark, monkeypatch):
    rng = random.Random(29)
    # runs of a word that all have and of one of their own, which is also found elsewhere but in no passage
    rows = [(i, f"{'the ' * 26}{f'own{i} ' * 26}") for i in range(150)]
    rows += [(1000 + i, f"{prose(rng, 30, 10**6)} {f'own{i} ' * 8}{prose(rng, 30, 10**6)}") for i in range(150)]
    rows += [(2000 + i, f"{prose(rng, 30, 10**6)} {'the ' * 26}{'own ' * 26}{prose(rng, 30, 10**6)}") for i in range(2)]
    # the two runs far apart, as whole texts are compared
    rows += [(3000 + i, f"{'the ' * 60}{prose(rng, 300, 10**6)} {f'own{i} ' * 60}") for i in range(8)]
    sigs = {i: set(sd.signatures(sd.sequence(hashes(text)), 46)[0].tolist()) for i, text in rows}
    all_have = set().union(*(sigs[k] for k in range(8, 150)))
    met = {i for i in range(8) if sigs[i] & sigs[3000 + i] & all_have and (sigs[i] & sigs[3000 + i]) - all_have}
    compared = []
    hulls = sd._hulls
    monkeypatch.setattr(sd, "_hulls", lambda *a: compared.append(hulls(*a).count()) or hulls(*a))
    got = sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    found = {r.doc_id for r in got}
    assert len(met) > 1 and met <= found and not found & set(range(8, 2000))
    assert {(r.start_word, r.end_word, r.other) for r in got if r.doc_id in (2000, 2001)} == {(30, 82, 2001), (30, 82, 2000)}
    # all pairs of the group are 11628
    assert sum(compared) < 3000


def test_passages_of_many_pairs_are_those_of_each():
    rng = np.random.default_rng(31)
    for _ in range(40):
        own, other = ([rng.integers(0, rng.choice([3, 9, 40]), rng.integers(0, 60)).astype(np.uint32) for _ in range(7)] for _ in range(2))
        first, other_first = (np.append(0, np.cumsum([len(x) for x in y])) for y in (own, other))
        got = sd.passages(np.concatenate(own), first, np.concatenate(other), other_first, 6, 4)
        want = []
        for i, (x, y) in enumerate(zip(own, other)):
            common = [bool(v) and v in set(y.tolist()) for v in x.tolist()]
            dense = [k for k in range(len(x) - 5) if sum(common[k : k + 6]) >= 4]
            runs = []
            for k in dense:
                if not runs or k - runs[-1][-1] > 6:
                    runs.append([])
                runs[-1].append(k)
            for run in runs:
                hits = [k for k in range(run[0], run[-1] + 6) if common[k]]
                want.append((i, hits[0], hits[-1] + 1))
        assert list(zip(*(x.tolist() for x in got))) == want


def test_shingles_of_several_texts():
    texts = [np.array(x, np.uint32) for x in ([1, 2, 2**31, 2], [5, 2**31, 2**32 - 1], [2**32 - 1, 7], [7])]
    rows = []
    for i, x in enumerate(texts):
        windows = (np.array([i]), np.array([0]), np.array([len(x)]), np.array([0]))
        rows.append((i, x, np.array([0], np.int32), np.array([0], np.int32), *(c.astype(t) for c, t in zip(windows, (np.int64, *[np.int32] * 3)))))
    parts = list(sd._shingles(iter([sd._packed(rows[:2]), sd._packed(rows[2:])])))
    got = [v for b in sd._repeated(iter(parts)) for v in b.column("shingle").to_pylist()]
    assert got == [7, 2**31, 2**32 - 1] and list(sd._repeated(iter([]))) == []


def test_any_text_with_enough_in_common_has_one_of_the_rarest():
    rng = np.random.default_rng(3)
    for width, needed in ((6, 4), (46, 41)):
        for _ in range(300):
            n = 2 * width - 1
            texts = rng.random((12, n)) < rng.choice([0.5, 0.8, 0.95])
            taken = sd.rarest(texts.sum(axis=0), width, needed)
            sums = np.lib.stride_tricks.sliding_window_view(texts, width, axis=1).sum(axis=2)
            partners = (sums >= needed).any(axis=1)
            assert texts[partners][:, taken].any(axis=1).all()


def test_which_stretches_repeat_themselves():
    assert not sd.repetitive(np.arange(1, 12), 6, 4) and not sd.repetitive(np.zeros(11, np.int64), 6, 4)
    assert sd.repetitive(np.array([1, 2, 3, 4, 5, 6, 6, 6, 6, 7, 8]), 6, 4)
    assert not sd.repetitive(np.array([1, 2, 3, 4, 5, 6, 1, 2, 3, 4, 5]), 6, 4)


def test_texts_of_a_chunk_have_the_signatures_they_have_alone():
    rng = random.Random(28)
    texts = ["", prose(rng, 50, 10**6), "a b", "la " * 90, prose(rng, 400, 50), prose(rng, 49, 10**6), prose(rng, 60, 10**6)]
    words, ends = sd.word_hashes(*sd.flat(pa.array(texts)))
    first, sizes = ends[:-1], np.diff(ends)
    long = np.flatnonzero(sizes >= 50)
    sig, lo, hi, at = sd.signatures(sd.sequence(words), 46, first[long], sizes[long] - 4)
    nodes = sd.text_nodes(words, first[long], sizes[long])
    want = set()
    for i, node in zip(long.tolist(), nodes.tolist()):
        own = hashes(texts[i])
        assert sd.text_nodes(own, np.array([0]), np.array([len(own)])).tolist() == [node]
        want |= {(int(s), *(int(x) + int(first[i]) for x in r)) for s, *r in zip(*sd.signatures(sd.sequence(own), 46))}
    assert set(zip(*(x.tolist() for x in (sig, lo, hi, at)))) == want


def test_near_passages_against_brute_force(spark):
    rng = random.Random(25)
    rows, want = [], set()
    for i in range(150):
        own = prose(rng, rng.randint(50, 60), 10**6)
        words = own.split()
        words[rng.randrange(20, 30)] = "changed"  # five shingles of 46 to 56: 0.8 and more
        rows += [(2 * i, f"{prose(rng, 30, 10**6)} {own} {prose(rng, 30, 10**6)}")]
        rows += [(2 * i + 1, f"{prose(rng, 20, 10**6)} {' '.join(words)} {prose(rng, 20, 10**6)}")]
        want |= {2 * i, 2 * i + 1}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.other) for r in sd.repeated_passages(df).collect()}
    assert all(a ^ b == 1 for a, b in got)
    assert len({a for a, _ in got}) >= 0.98 * len(want)


def test_very_long_text(spark):
    rng = random.Random(26)
    shared = prose(rng, 60, 10**6)
    rows = [(1, f"{prose(rng, 300_000, 10**6)} {shared} {prose(rng, 1000, 10**6)}"), (2, f"{prose(rng, 500, 10**6)} {shared}")]
    got = {(r.doc_id, r.start_word, r.end_word, r.other) for r in sd.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 300_000, 300_060, 2), (2, 500, 560, 1)}


def test_signatures_meet_near_copies_of_fifty_words():
    rng = random.Random(22)
    met, n = 0, 500
    for _ in range(n):
        own = prose(rng, 50, 10**6).split()
        other = own[:24] + ["changed"] + own[25:]
        x, y = ({int(v) for v in sd.signatures(sd.sequence(hashes(" ".join(w))), 46)[0]} for w in (own, other))
        met += bool(x & y)
    # 46 shingles, 41 of them in common
    assert met >= 0.99 * n


def hashes(text):
    return sd.word_hashes(*sd.flat(pa.array([text])))[0]


def test_sliding_minima_are_those_of_the_windows():
    rng = np.random.default_rng(1)
    for n in (46, 47, 91, 92, 300):
        values = rng.integers(0, 2**63, n).astype(np.uint64)
        got = sd.sliding_minima(values, 46)
        assert got.tolist() == [values[i : i + 46].min() for i in range(n - 45)]


def test_empty_table(spark):
    assert sd.repeated_passages(spark.createDataFrame([], "doc_id long, text string")).collect() == []
