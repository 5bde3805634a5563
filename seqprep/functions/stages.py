"""One Column function per cleaning stage and metric.

Every function is built from built-in expressions, so a chain of them stays in
whole-stage code generation. An option may be a Python value (the same for all
rows) or a Column (per row). Null text gives null.

Two rules keep the cost per byte low. For a one-byte alphabet, what a removal
takes away is the count: ``octet_length`` is a field read and ``replace`` a byte
scan, a fraction of ``translate`` or ``regexp_count`` on text where every other
character matches. And a rewrite that most rows do not need stands behind
``contains``, the cheapest search there is.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqprep.functions.options import DEFAULTS

Text = str | Column
Number = int | Column

# Fixed value: the characters that the default gap regex matches.
GAP_CHARACTERS = "-."

# A pattern without regex syntax is a plain substring search.
PLAIN_TEXT = r"\A[A-Za-z0-9 ]+\z"
# A simple bracket class consumes a character whenever it matches.
SIMPLE_CLASS = r"\A\[[^\[\]]+\]\z"
# An alphabet of plain letters with A, C, G, T and N among them.
PLAIN_ALPHABET = r"\A(?=.*A)(?=.*C)(?=.*G)(?=.*T)(?=.*N)[A-Za-z]+\z"


def _when_option(option: Text, form: str, then: Column, otherwise: Column) -> Column:
    """Pick the plan by the option's form: now if it is fixed, else per row.

    A regex that differs from row to row is compiled for each row, so the
    shortcuts matter even more there.
    """
    if isinstance(option, str):
        return then if re.search(form.replace(r"\z", r"\Z"), option) else otherwise
    return F.when(F.rlike(option, F.lit(form)), then).otherwise(otherwise)


def _col(value: str | int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _join(*parts: str | int | Column) -> Column:
    """Concatenate text parts; one literal when no part is a Column."""
    if any(isinstance(part, Column) for part in parts):
        return F.concat(*[_col(part).cast("string") for part in parts])
    return F.lit("".join(str(part) for part in parts))


def _contains_any(text: Column, characters: str) -> Column:
    found = [F.contains(text, F.lit(character)) for character in characters]
    return reduce(Column.__or__, found)


def _replace(text: Column, old: str, new: str) -> Column:
    """``replace`` behind ``contains``, which is several times cheaper."""
    replaced = F.replace(text, F.lit(old), F.lit(new))
    return F.when(F.contains(text, F.lit(old)), replaced).otherwise(text)


def shortened(after: Column, before: Column) -> Column:
    """Whether a removal took anything away."""
    return F.octet_length(after) < F.octet_length(before)


# --- text stages ------------------------------------------------------------


def strip_whitespace(raw: Column) -> Column:
    """Remove ASCII whitespace; other Unicode blanks stay."""
    return F.regexp_replace(raw, r"\s", "")


def uppercase(text: Column) -> Column:
    return F.upper(text)


def natural_language(upper: Column, pattern: Text) -> Column:
    """Whether the pattern occurs. Looked for before gaps are removed."""
    return _when_option(
        pattern,
        PLAIN_TEXT,
        F.contains(upper, _col(pattern)),
        F.rlike(upper, _col(pattern)),
    )


def remove_gaps(upper: Column, pattern: Text) -> Column:
    removed = F.regexp_replace(upper, pattern, "")
    if isinstance(pattern, str) and pattern == DEFAULTS["gapRegex"]:
        return F.when(_contains_any(upper, GAP_CHARACTERS), removed).otherwise(upper)
    return removed


def gap_found(upper: Column, without_gaps: Column, pattern: Text) -> Column:
    """Whether the gap pattern matches, even where the match is empty."""
    return _when_option(
        pattern,
        SIMPLE_CLASS,
        shortened(without_gaps, upper),
        F.rlike(upper, _col(pattern)),
    )


def rna_to_dna(text: Column) -> Column:
    return _replace(text, "U", "T")


def unknown_to_n(text: Column) -> Column:
    return _replace(text, "?", "N")


def anchor_run(chars: Text, minrun: Number) -> tuple[str | Column, ...]:
    """Regex parts for a run of at least ``minrun`` anchor characters."""
    return ("[", chars, "]{", minrun, ",}")


def trim_front(text: Column, chars: Text, minrun: Number) -> Column:
    """Drop what stands before the first anchor run; no run leaves ''."""
    return F.call_function(
        "regexp_extract",
        text,
        _join("(?s)", *anchor_run(chars, minrun), ".*"),
        F.lit(0),
    )


def trim_to_anchors(text: Column, chars: Text, minrun: Number) -> Column:
    """Keep the span from the first anchor run to the last; no run leaves ''.

    One pass: the leftmost run, then optionally everything up to the end of the
    last run. DOTALL, since U+0085 and U+2028 survive the whitespace stage.
    """
    run = anchor_run(chars, minrun)
    return F.call_function(
        "regexp_extract",
        text,
        _join("(?s)", *run, "(?:.*", *run, ")?"),
        F.lit(0),
    )


def holds_run(text: Column, cap_from: Number) -> Column:
    """Cheap byte search that spares most rows the N-run regex."""
    if isinstance(cap_from, int):
        return F.contains(text, F.lit("N" * cap_from))
    return F.contains(text, F.repeat(F.lit("N"), cap_from))


def capped_runs(text: Column, found: Column, cap_from: Number) -> Column:
    """Number of N runs of at least ``cap_from``; none in an empty text."""
    if not isinstance(cap_from, int) or cap_from == 0:
        found = found & (F.octet_length(text) > 0)
    count = F.regexp_count(text, _join("N{", cap_from, ",}"))
    return F.when(found, count).when(~found, F.lit(0))


def cap_runs(text: Column, found: Column, cap_from: Number, cap_to: Number) -> Column:
    """Set every N run of at least ``cap_from`` to exactly ``cap_to``."""
    if isinstance(cap_to, int):
        fill = F.lit("N" * cap_to)
    else:
        fill = F.repeat(F.lit("N"), cap_to)
    capped = F.regexp_replace(text, _join("N{", cap_from, ",}"), fill)
    return F.when(found, capped).otherwise(text)


# --- metrics on the final text ----------------------------------------------


def without_gc(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("G"), F.lit("")), F.lit("C"), F.lit(""))


def count_gc(text: Column, no_gc: Column) -> Column:
    return F.octet_length(text) - F.octet_length(no_gc)


def leftover(no_gc: Column) -> Column:
    """What is left without A, C, G, T and N: empty for most sequences.

    Starts from the text without G and C, which is half as long.
    """
    return F.regexp_replace(no_gc, "[ATN]+", "")


def count_n(no_gc: Column) -> Column:
    return F.octet_length(no_gc) - F.octet_length(_replace(no_gc, "N", ""))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units: a character beyond U+FFFF counts twice."""
    return F.shiftright(F.octet_length(F.encode(text, "UTF-16BE")), 1)


def sequence_length(text: Column, left: Column) -> Column:
    """UTF-16 length. All that ``leftover`` removed is one byte, one unit."""
    return F.octet_length(text) - F.octet_length(left) + utf16_length(left)


def count_acgt(text: Column, left: Column, n: Column) -> Column:
    return F.octet_length(text) - F.octet_length(left) - n


def count_non_acgtn(left: Column) -> Column:
    return F.length(left)


def count_non_iupac(text: Column, left: Column, iupac: Text) -> Column:
    """Characters outside the alphabet, which is spliced into a class.

    A plain alphabet that covers ACGTN needs only the leftover, mostly empty.
    """
    foreign = _join("[^", iupac, "]")
    in_leftover = F.regexp_count(left, foreign)
    return _when_option(iupac, PLAIN_ALPHABET, in_leftover, F.regexp_count(text, foreign))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; null for an empty whole."""
    return F.try_divide(part, whole)


def sequence_id(text: Column) -> Column:
    """Lower-case hex MD5; null for an empty text."""
    return F.when(F.octet_length(text) > 0, F.md5(text))


def invalid_flag(non_iupac_fraction: Column, language: Column) -> Column:
    """Foreign characters or natural language; an empty text is valid."""
    return F.coalesce(non_iupac_fraction > 0, F.lit(False)) | language
