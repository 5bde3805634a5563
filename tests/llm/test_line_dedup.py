from __future__ import annotations

import random
import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import with_clashes

from seqprep.llm import line_dedup

ENDS = re.compile(r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\Z")


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), ENDS.sub("", line))


def expected(rows, least):
    held = Counter(k for _, text in rows for k in {key(x) for x in (text or "").split("\n")} if k)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if held[key(x)] < least or not key(x)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def some_rows(seed, n=400):
    rng = random.Random(seed)
    common = ["Read more", " read MORE\t", "Été", "ÉTÉ", "\x0bshare", "", "  ", "\x85", "All rights reserved.", "\r"]
    rows = []
    for i in range(n):
        lines = [rng.choice(common) if rng.random() < 0.5 else f"Line {rng.randrange(300)}" for _ in range(rng.randint(1, 8))]
        rows.append((i if rng.random() < 0.9 else None, "\n".join(lines)))
    rows += [(7, None), (None, ""), (8, "\n"), (9, "\n".join(["once", *["Read more"] * 3000, *[f"long {k}" for k in range(3000)]]))]
    return rows + [(5, "same\ntext")] * 150 + [(None, "no id\nLine 1")] * 9  # one text of a third of the rows


def frame(spark, rows):
    return with_clashes(spark.createDataFrame(rows, "doc_id long, text string")).repartition(4)


def test_batches_levels_and_thresholds(spark):
    rows = some_rows(1)
    for batches, fan_out, least in [(1, 3, 10), (7, 2, 10), (10, 3, 2), (4, 2, 150)]:
        parts = [frame(spark, rows[b::batches]) for b in range(batches)]
        got = line_dedup.line_dedup(parts, ["doc_id"], min_docs=least, fan_out=fan_out).collect()
        assert sorted(map(tuple, got), key=repr) == expected(rows, least), (batches, fan_out, least)


def test_settled_keys_are_not_written_again(spark):
    runs = line_dedup.LineRuns(spark, min_docs=3, fan_out=2)
    for _ in range(5):
        runs.add(frame(spark, [(1, "often\nrare 1"), (2, "often"), (3, f"only {len(runs.settled)}")]))
    # settled in the first merge, and in no run since
    left = [run for level in runs.levels for run in level]
    found = [r.h for run in runs.settled for r in run.collect()]
    assert len(runs.settled) > 1 and len(found) == len(set(found)) == runs.common().count()
    assert not set(found) & {r.h for r in left[0].collect()}
    for rows in (runs._merged([left[0], left[-1]]), runs.settled[0].join(left[-1], "h", "left_anti")):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan or "Exchange hashpartitioning" not in plan


def test_hot_text_is_spread(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "ROWS_PER_SLICE", 10)
    rows = some_rows(2, 60)
    got = line_dedup.line_dedup([frame(spark, rows)], ["doc_id"]).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows, 10)


def test_other_names(spark):
    df = spark.createDataFrame([(k, f"x\n{k}") for k in "abcdefghijk"], "`h` string, `my text` string")
    got = line_dedup.line_dedup([df], ["h", "my text"], text="my text").collect()
    assert {(r.h, r["my text"], r.n_lines, r.n_dropped, r.kept) for r in got} == {(k, f"x\n{k}", 2, 1, k) for k in "abcdefghijk"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.line_dedup([df, df], ["doc_id"]).collect() == []
