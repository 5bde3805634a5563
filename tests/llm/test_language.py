from __future__ import annotations

import random
import sys

import numpy as np

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import with_clashes

from seqprep.llm import language

SYLLABLES = {"aa": ["ka", "lo", "mi", "ru"], "bb": ["été", "où", "que", "ç"], "cc": ["sch", "über", "ung", "pf"]}


def text(rng, lang, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_learn_and_predict(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang), lang) for i in range(30) for lang in SYLLABLES]
    rows += [(900, None, "aa"), (901, text(rng, "bb"), None), (902, "123", "cc")]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb", "cc"]
    asked = [(i, text(rng, lang, 5).upper(), lang) for i in range(20) for lang in SYLLABLES]
    asked += [(100, None, "und"), (101, "", "und"), (102, "12 !?", "und"), (103, text(rng, "cc", 30_000), "cc")]
    asked += [asked[0]]
    docs = with_clashes(spark.createDataFrame(asked, "doc_id long, text string, want string"))
    got = language.predict(docs, model, ["doc_id", "want", "k0"]).collect()
    assert len(got) == len(asked) and all(r.lang_pred == r.want for r in got)
    assert all((r.score == 0) == (r.want == "und") and 0 <= r.score <= 1 for r in got)


def test_nothing_learnt(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language.learn(none)
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in language.predict(docs, model, ["doc_id"]).collect()] == [("und", 0.0)]
    assert language.predict(docs.limit(0), model, ["doc_id"]).collect() == []


def test_more_languages_than_bits():
    names = [f"l{i:03d}" for i in range(70)]
    bits = np.zeros((language.SLOTS, 2), np.uint64)
    gram = np.array([12345], np.uint64)
    for k in range(language.HASHES):
        at = int((gram if k == 0 else language.mix(gram, 60 + k))[0]) & (language.SLOTS - 1)
        bits[at, 1] |= np.uint64(1 << 5)
    total, share = language.Filter(names, bits).shares(gram, np.array([0]), 1)
    assert total[0] == 1 and share[0].argmax() == 69 and (share[0] > 0.5).sum() == 1
