from __future__ import annotations

import random
import struct
import sys

import pytest

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import with_clashes

from seqprep.llm import bpe

PARTS = [*"ab'stredvml  \t\n\r.,!?019éßÀ日本​　\U0001f600", "'re", "'ll", "don't", " '", "''s", "́", "٣", "\x00", "\x85", "<|endoftext|>"]


def test_same_ids_as_the_library_and_round_trip(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [None, "", " ", "'", "x" * 4000, "ab" * 3000, "é" * 700, "word " * 30_000, "  \n", "it's", " 's"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "x")]
    path = bpe.default_ranks()
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string")).repartition(4)
    got = bpe.decode(bpe.encode(df, path, ["doc_id", "Node"]), path).collect()
    assert len(got) == len(rows)
    texts_of = dict(rows)
    for r in got:
        text = texts_of[r.doc_id] or ""
        assert list(struct.unpack(f"<{r.n_tokens}I", r.ids)) == library.encode_ordinary(text)
        assert bytes(r.decoded).decode() == text


def test_merging_alone_and_together_agree():
    ranks = bpe.read_ranks(bpe.default_ranks())
    encoder = bpe.Encoder(bpe.default_ranks())
    rng = random.Random(6)
    pieces = ["".join(rng.choice("abcdetonisé") for _ in range(rng.randint(1, 60))).encode() for _ in range(2000)]
    together = bpe.merge_all(pieces, encoder.letters, encoder.pairs)
    assert [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in together] == [bpe.merge_long(x, ranks) for x in pieces]
    assert bpe.merge_all([], encoder.letters, encoder.pairs) == []


def test_cache_of_two_generations(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    encoder = bpe.Encoder(bpe.default_ranks())
    rng = random.Random(7)
    for _ in range(50):
        pieces = list({"".join(rng.choice("abcxyz") for _ in range(rng.randint(1, 9))).encode() for _ in range(4)})
        want = [[encoder.ranks[x]] if x in encoder.ranks else bpe.merge_long(x, encoder.ranks) for x in pieces]
        assert [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in encoder.ids(pieces)] == want
        assert len(encoder.young) + len(encoder.old) <= 18


def thue_morse(n):
    """Two words that a sum of powers modulo 2**64 cannot tell apart."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [256, 1024, 2048])
def test_words_that_sums_of_powers_mix_up(spark, n):
    path = bpe.default_ranks()
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    df = spark.createDataFrame(list(enumerate(thue_morse(n))), "doc_id long, text string").coalesce(1)
    for r in bpe.decode(bpe.encode(df, path, ["doc_id"]), path).collect():
        text = thue_morse(n)[r.doc_id]
        assert list(struct.unpack(f"<{r.n_tokens}I", r.ids)) == library.encode_ordinary(text)
        assert bytes(r.decoded).decode() == text


def test_classes_are_by_bytes_where_hashes_collide(monkeypatch):
    import numpy as np

    from seqprep.llm import arrays

    monkeypatch.setattr(arrays.SliceHash, "__call__", lambda self, start, end: np.zeros(len(start), np.uint64))
    data = np.frombuffer(b"abcabcabdab", np.uint8)
    one, place = arrays.slice_classes(data, np.array([0, 3, 6, 9]), np.array([3, 6, 9, 11]))
    assert place.tolist() == [0, 0, 1, 2] and one.tolist() == [0, 2, 3]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    path = bpe.default_ranks()
    assert bpe.decode(bpe.encode(df, path, ["doc_id"]), path).collect() == []
