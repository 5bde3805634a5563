"""Random texts and options against a character-by-character model."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from seqprep import CleanOptions, clean_sequences, register_sql

PIECES = [
    "A", "C", "G", "T", "U", "a", "c", "g", "t", "u", "N", "n", "?", "R", "y", "X", "z", "-", ".",
    " ", "\t", "\n", "\x0b", "_", "ß", "é", " ", "\u0085", "\U0001f600",
    "ACGTACGT", "acguacgu", "GGGGGGGG", "NNNNNN", "NNNNNNNNN", "UNMERGED", "un merged",
]
OPTION_SETS = [
    {},
    {"anchorMinrun": "1"},
    {"anchorMinrun": "0"},
    {"anchorMinrun": "3", "anchorChars": "ACGT"},
    {"nrunCapFrom": "3", "nrunCapTo": "2"},
    {"nrunCapFrom": "1", "nrunCapTo": "3", "anchorMinrun": "2"},
    {"iupacDna": "ACGT", "anchorMinrun": "2"},
    {"iupacDna": "ACGTNXZ", "naturalLanguageRegex": "X", "anchorMinrun": "2"},
]


def whole_runs(text, letters, least):
    """(start, end) of maximal runs of ``letters`` with at least ``least``."""
    runs, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in letters:
            end += 1
        if end - at >= least and end > at:
            runs.append((at, end))
        at = max(end, at + 1)
    return runs


def model(raw, opts):
    anchors = opts.get("anchorChars", "ACGTU")
    least = int(opts.get("anchorMinrun", "8"))
    cap_from, cap_to = int(opts.get("nrunCapFrom", "6")), int(opts.get("nrunCapTo", "5"))
    alphabet = opts.get("iupacDna", "ACGTRYSWKMBDHVN")
    word = opts.get("naturalLanguageRegex", "UNMERGED")

    upper = "".join(ch for ch in raw if ch not in " \t\n\x0b\f\r").upper()
    language = word in upper
    plain = "".join({"U": "T", "?": "N"}.get(ch, ch) for ch in upper if ch not in "-.")
    removed = any(ch in " \t\n\x0b\f\r-." for ch in raw)
    kept = plain
    if least > 0:
        runs = whole_runs(plain, anchors, least)
        kept = plain[runs[0][0] : runs[-1][1]] if runs else ""
    n_runs = whole_runs(kept, "N", cap_from)
    final, at = "", 0
    for start, end in n_runs:
        final += kept[at:start] + "N" * cap_to
        at = end
    final += kept[at:]

    units = sum(2 if ord(ch) > 0xFFFF else 1 for ch in final)
    acgt = sum(ch in "ACGT" for ch in final)
    share = lambda letters: sum(ch not in letters for ch in final) / units if units else None
    foreign = share(alphabet)
    invalid = language or bool(foreign)
    return {
        "seqId": None,
        "rawSequence": raw,
        "sequence": None if invalid else final,
        "sequenceLength": units,
        "nonIupacFraction": foreign,
        "nonACGTNFraction": share("ACGTN"),
        "nFraction": final.count("N") / units if units else None,
        "nNrunsCapped": len(n_runs),
        "gcContent": sum(ch in "GC" for ch in final) / acgt if acgt else None,
        "naturalLanguageDetected": language,
        "endsTrimmed": kept != plain,
        "gapsOrWhitespaceRemoved": removed,
        "nucleotideSequenceID": None
        if invalid or not final
        else hashlib.md5(final.encode()).hexdigest(),
        "invalid": invalid,
    }


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(20240)
    return [
        (i, "".join(rng.choices(PIECES, k=rng.randint(0, 25))), OPTION_SETS[i % len(OPTION_SETS)])
        for i in range(2400)
    ]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "i INT, raw STRING, opts MAP<STRING, STRING>").repartition(8)


def compare(df, rows):
    got = {row["i"]: row["result"].asDict() for row in df.select("i", "result").collect()}
    assert len(got) == len(rows)
    for i, raw, opts in rows:
        assert got[i] == model(raw, opts), (raw, opts)


def test_per_row_options(frame, rows):
    compare(clean_sequences(frame, "raw", F.col("opts")), rows)


def test_sql_function(spark, frame, rows):
    register_sql(spark)
    compare(spark.sql("SELECT i, processSequence(raw, opts) AS result FROM {f}", f=frame), rows)


@pytest.mark.parametrize("which", range(len(OPTION_SETS)))
def test_fixed_options(frame, rows, which):
    part = frame.where(F.col("i") % len(OPTION_SETS) == which)
    expected = [row for row in rows if row[0] % len(OPTION_SETS) == which]
    compare(clean_sequences(part, "raw", CleanOptions.from_map(OPTION_SETS[which])), expected)
