from __future__ import annotations

import os
import random
import struct
import sys

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import changed, with_clashes

import corpus_pipeline as pipeline

ITEM = "Which of the seven rivers that cross the northern plain carries the most water in a dry summer after a winter with little snow?"
WORDS = "river plain water summer winter snow house garden bread street light stone field morning paper window letter music".split()


def text(rng, n=80):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly"]) for _ in range(n))


def some_documents():
    rng = random.Random(11)
    rows = [(i, text(rng), "en", f"src{i % 4}", 0) for i in range(60)]
    rows += [(100 + i, changed(rng, rows[7][1], 1), "en", "src9", 0) for i in range(20)]
    rows += [(200, f"{text(rng)} {ITEM} {text(rng)}", "en", "src1", 0)]
    rows += [(201, f"{text(rng)} token = 'q7Zp2Lm9Xw4' {text(rng)}", "en", "src1", 0)]
    rows += [(202, None, None, None, None), (203, "12 345 !!", "en", "src1", 0), (204, "", "en", "src1", 0)]
    rows += [rows[3], (None, text(rng), "en", "src2", 0), (205, "river " * 20_000, "en", "src2", 0)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    with_clashes(spark.createDataFrame(some_documents(), schema)).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_on_what_the_one_before_kept(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for i, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, folder)
        if i + 1 < len(pipeline.STAGES):
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
    ids = {name: sorted((r.doc_id is None, r.doc_id or 0) for r in rows) for name, rows in kept.items()}
    clean = [(False, i) for i in range(60)]
    near = [(False, 100 + i) for i in range(20)]
    rest = [(False, i) for i in (200, 201, 205)]
    assert ids["language_id"] == sorted([*clean, (False, 3), *near, *rest, (True, 0)])
    assert ids["ngram_jaccard_join"] == [*clean, *rest, (True, 0)]
    assert ids["benchmark_decontamination"] == [*clean, (False, 201), (False, 205), (True, 0)]
    texts = {r.doc_id: r.text for r in kept["secret_scans"]}
    assert "<SECRET>" in texts[201] and "q7Zp2Lm9Xw4" not in texts[201]
    before = {r.doc_id: r.text for r in kept["benchmark_decontamination"]}
    assert {i: t for i, t in texts.items() if i != 201} == {i: t for i, t in before.items() if i != 201}
    for r in kept["byte_level_bpe"]:
        assert r.round_trip and len(struct.unpack(f"<{r.n_tokens}I", r.ids)) == r.n_tokens


def test_missing_and_repeated_ids_cost_no_document(spark, tmp_path):
    rng = random.Random(3)
    texts = [text(rng) for _ in range(7)]
    rows = [(None, t) for t in texts[:3]] + [(7, texts[3]), (7, texts[4]), (8, texts[5]), (9, texts[6])]
    rows += [(None, ""), (None, ""), (None, None)]
    # a null id and a repeated one on copies of other documents, and a null id twice on one text
    rows += [(None, texts[5]), (9, changed(rng, texts[3], 1)), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    kept = pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    want = [(None, t) for t in [*texts[:3], "", "", None]] + [(7, texts[3]), (7, texts[4]), (8, texts[5]), (9, texts[6])]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    more = [(None, f"{texts[0]} {ITEM}"), (7, f"{texts[1]} {ITEM}")]
    docs = spark.createDataFrame([*want, *more], "doc_id long, text string").repartition(3)
    kept = pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert pipeline.run(spark, folder).count() == 63
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert pipeline.run(spark, str(tmp_path)).collect() == []
    assert os.path.isdir(tmp_path / "documents.parquet")
