from __future__ import annotations

import hashlib
import random
import re
import sys

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import with_clashes

from seqprep.llm import secrets

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
KINDS = [("assign", ASSIGN, 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]
PARTS = ["token", "=", ":", " ", '"', "'", "secret", "API_KEY", "apikey", "PassWord", "AKIA", "ABCDEFGH12", "é", "\U0001f600"]
PARTS += ["deadbeef", "0123456789abcdef", "abc", "token=", "\n", "x", "passwd: ", "==", "ſecret=abcdefgh"]


def want(text):
    spans = []
    for no, (kind, pattern, group, least) in enumerate(KINDS):
        for m in pattern.finditer(text or ""):
            if len(m[group]) >= least:
                spans.append((m.start(), no, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(spans)]


def test_base_spans_against_python(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    texts += [None, "", "token=secret=abcdefgh", "token=token:abcdef", "token=abc12345 " * 3000]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "s"), (None, "secret: abc123", None)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = secrets.scan_secrets(df).select("doc_id", secrets.span_text(secrets.F.col("base")).alias("s")).collect()
    assert sorted((str(r.doc_id), r.s) for r in got) == sorted((str(i), ",".join(want(t))) for i, t, _ in rows)


def test_ownership_and_redaction(spark):
    live, copied = "q7Zp2Lm9Xw4", "c0p1edV4lue99"
    rows = [
        (1, f"a token = '{live}' b", "s1"),
        (2, f"password={copied}.", "s1"),
        (3, f"password={copied}.", "s2"),
        (4, "api_key: your_example_1", "s3"),
        (5, "nothing", "s3"),
        (6, None, "s3"),
        (7, f"token={hashlib.md5(b'1').hexdigest()}", None),
    ]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    live_in = {r.doc_id for r in secrets.scan_secrets(df).collect() if r.live}
    assert live_in == {1, 7}
    masked = secrets.redact_live(df)
    assert masked.columns == df.columns
    text = {r.doc_id: r.text for r in masked.collect()}
    assert text == {**{i: t for i, t, _ in rows}, 1: "a token = '<SECRET>' b", 7: "token=<SECRET>"}


def test_no_python_in_the_plan(spark, tmp_path):
    df = spark.createDataFrame([(1, "token=abc12345", "s")], "doc_id long, text string, source string")
    plan = secrets.scan_secrets(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert secrets.scan_secrets(df).collect() == [] and secrets.redact_live(df).collect() == []
