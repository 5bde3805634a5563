from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import with_clashes

from seqprep.llm import periodic_runs

SF_DIR = "/root/testdata/sf0.001"


def brute(words):
    """All (start, length, period): every lag is walked, and of a stretch the smallest period counts."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - start >= max(12, 2 * q):
                found.setdefault((start, i - start), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def damaged(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text):
    words = damaged(doc_id, words_of(text))
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def periodic(rng, n, alphabet):
    """A text of periodic stretches, some of them made of periodic stretches."""
    out = []
    while len(out) < n:
        unit = [rng.choice(alphabet) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.4:
            unit = unit[: rng.randint(1, 4)] * rng.randint(1, 12) + unit[:5]
        out += unit * rng.randint(1, 6) + unit[: rng.randint(0, len(unit))]
    return out[:n]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def some_texts():
    rng = random.Random(8)
    texts = [" ".join(periodic(rng, rng.randint(1, 500), "abcdefgh"[: rng.randint(1, 8)])) for _ in range(250)]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 300))) for _ in range(40)]
    texts += [" ".join(fibonacci(n)) for n in (50, 400)]
    texts += ["x " * n for n in (11, 12, 13, 600)]
    unit = [f"w{i}" for i in range(199)]
    texts += [" ".join(unit * 2 + unit[:k]) for k in (0, 1, 198)] + [" ".join(unit * 2)[:-1]]
    texts += [None, "", " \t\n", "A a " * 20, "é\x0bé " * 9, "\xa0 \xa0 " * 9]
    return texts


def test_against_brute_force(spark, tmp_path):
    rows = list(enumerate(some_texts())) + [(3, "y " * 30), (None, "z " * 30)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic_runs.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(expected(i, t)) for i, t in rows)


def test_real_outputs(spark):
    df = spark.createDataFrame([("k", "a b " + "c d e " * 5 + "f")], "`my key` string, runs string")
    (row,) = periodic_runs.periodic_runs(df, ["my key", "runs"], "runs").collect()
    assert row[0] == "k" and [tuple(r) for r in row[3]] == [(2, 15, 3)]
    assert (row["n_words"], row["collapsed"]) == (18, "a b c d e f")


def test_long_text_in_time(spark):
    rng = random.Random(9)
    unit = [f"w{rng.randrange(50)}" for _ in range(30_000)]
    texts = ["x " * 400_000, " ".join(unit * 5), " ".join(fibonacci(200_000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(df, ["doc_id"]).collect()}
    assert [tuple(r) for r in got[0].runs] == [(0, 400_000, 1)] and got[0].collapsed == "x"
    assert (0, 150_000, 30_000) in [tuple(r) for r in got[1].runs]
    assert all(n >= max(12, 2 * q) for r in got.values() for _, n, q in r.runs)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.periodic_runs(df, ["doc_id"]).collect() == []


@pytest.mark.parametrize("table", [SF_DIR])
def test_whole_table(spark, table):
    rows = [r for r in spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "text").collect() if len(r.text or "") < 20_000]
    got = {r[0]: tuple(r) for r in periodic_runs.op11_periodic_runs(spark, table).collect()}
    assert all(got[r.doc_id] == expected(r.doc_id, r.text) for r in rows)
