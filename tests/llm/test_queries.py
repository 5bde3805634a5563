"""Every registered query over the smallest given tables, against SQL or brute force."""

from __future__ import annotations

import hashlib
import html
import os
import re
import struct
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from seqprep.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        if file.endswith(".parquet"):
            connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    yield connection
    connection.close()


def run(spark, number, sf_dir=SF_DIR):
    (name,) = [n for n in QUERIES if n.startswith(f"op{number}_")]
    return QUERIES[name](spark, sf_dir).collect()


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    want = duck.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got and got == sorted(map(repr, want.select(*columns).fetchall()))


def tokens(text):
    return re.findall(r"\w+", (text or "").lower())


def test_op3_finds_the_items(spark, duck):
    index, size = defaultdict(set), {}
    for item, text in duck.sql("SELECT item_id, text FROM benchmark").fetchall():
        words = tokens(text)
        size[item] = len(words) - 4
        for k in range(size[item]):
            index[tuple(words[k : k + 5])].add((item, k))
    want = set()
    for doc, text in duck.sql("SELECT doc_id, text FROM documents").fetchall():
        words, hits = tokens(text), defaultdict(set)
        for k in range(len(words) - 4):
            for item, place in index.get(tuple(words[k : k + 5]), ()):
                hits[item].add(place)
        want |= {(doc, item) for item, places in hits.items() if len(places) >= 0.5 * size[item]}
    assert {(r.doc_id, r.item_id) for r in run(spark, 3)} == want


def test_op4_held_out(spark, duck):
    sf_dir = SF_DIR.replace("0.001", "0.01")  # the smallest tables have three held-out toxic texts
    toxic = dict(duck.sql(f"SELECT doc_id, max(toxic) FROM '{sf_dir}/labels.parquet' GROUP BY 1").fetchall())
    rows = run(spark, 4, sf_dir)
    assert len(rows) == duck.sql(f"SELECT count(*) FROM '{sf_dir}/documents.parquet'").fetchall()[0][0]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    known = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    good, bad = [s for s, y in known if not y], [s for s, y in known if y]
    if good and bad:
        assert np.mean([[b > g for g in good] for b in bad]) > 0.8


def test_op5_held_out(spark, duck):
    lang = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in run(spark, 5) if r.held_out]
    assert rows and np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.95


def test_op7_as_the_library(spark, duck):
    tiktoken = pytest.importorskip("tiktoken")
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from seqprep.llm import bpe

    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_ranks()), special_tokens={})
    want = set()
    for doc, text in duck.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall():
        ids = library.encode_ordinary(text)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.add((doc, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert {tuple(r) for r in run(spark, 7)} == want


def test_op8_misses_no_exact_passage(spark, duck):
    docs = {d: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for d, t in duck.sql("SELECT doc_id, text FROM documents").fetchall()}
    held = defaultdict(set)
    for doc, words in docs.items():
        for k in range(len(words) - 49):
            held[tuple(words[k : k + 50])].add(doc)
    rows = defaultdict(list)
    for r in run(spark, 8):
        assert r.other_doc_id != r.doc_id
        rows[r.doc_id].append((r.start_word, r.end_word))
    for doc, words in docs.items():
        for k in range(len(words) - 49):
            if len(held[tuple(words[k : k + 50])]) > 1:
                assert any(a <= k and k + 50 <= b for a, b in rows[doc]), (doc, k)


def test_op9_recall(spark, duck):
    data = duck.sql("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids, base = np.array([i for i, _ in data]), np.array([v for _, v in data], float)
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows, hits = run(spark, 9), 0
    for q in ids[ids % 50 == 0]:
        score = base @ base[ids == q][0]
        score[ids == q] = -2
        best = set(ids[np.argsort(-score)[:5]])
        hits += sum(r.query_id == q and r.vec_id in best for r in rows)
    assert hits >= 0.9 * 5 * (ids % 50 == 0).sum()


def test_op10_has_the_articles(spark, duck):
    pages = dict(duck.sql("SELECT page_id, html FROM pages").fetchall())
    rows = run(spark, 10)
    assert len(rows) == len(pages)
    for r in rows:
        article = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        lines = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)>", "\n", article.replace("<br>", " "))).split("\n")
        assert r.text == "\n".join(x for x in (" ".join(html.unescape(line).split()) for line in lines) if x)
        assert r.n_chars == len(r.text)
