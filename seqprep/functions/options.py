"""Cleaning options: fixed defaults and overrides from a map."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

# The option names and the default of each.
DEFAULTS: dict[str, str | int] = {
    "anchorChars": "ACGTU",
    "anchorMinrun": 8,
    "anchorStrict": "ACGTU",
    "gapRegex": r"[-\.]",
    "naturalLanguageRegex": "UNMERGED",
    "iupacRna": "ACGTURYSWKMBDHVN",
    "iupacDna": "ACGTRYSWKMBDHVN",
    "nrunCapFrom": 6,
    "nrunCapTo": 5,
}

# A whole number as option text; anything else falls back to the default.
INT_TEXT = r"\A[+-]?[0-9]+\z"
INT_MIN, INT_MAX = -(2**31), 2**31 - 1


@dataclass(frozen=True)
class CleanOptions:
    """Options that hold for every row.

    ``anchor_chars`` and ``iupac_dna`` are the inside of a regex character
    class; the two ``*_regex`` fields are whole regexes, matched against
    upper-case text. ``anchor_strict`` and ``iupac_rna`` are accepted for
    compatibility and have no effect.
    """

    anchor_chars: str = DEFAULTS["anchorChars"]
    anchor_minrun: int = DEFAULTS["anchorMinrun"]
    anchor_strict: str = DEFAULTS["anchorStrict"]
    gap_regex: str = DEFAULTS["gapRegex"]
    natural_language_regex: str = DEFAULTS["naturalLanguageRegex"]
    iupac_rna: str = DEFAULTS["iupacRna"]
    iupac_dna: str = DEFAULTS["iupacDna"]
    nrun_cap_from: int = DEFAULTS["nrunCapFrom"]
    nrun_cap_to: int = DEFAULTS["nrunCapTo"]

    def __post_init__(self) -> None:
        for name in ("anchor_minrun", "nrun_cap_from", "nrun_cap_to"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")

    @classmethod
    def from_map(cls, overrides: Mapping[str, str | None] | None) -> CleanOptions:
        """Read camel-case text overrides.

        Unknown keys are ignored; a key whose value is None counts as missing;
        a number that does not parse as a 32-bit integer keeps the default.
        """
        overrides = overrides or {}
        values = {}
        for key, default in DEFAULTS.items():
            value = overrides.get(key)
            if isinstance(default, int):
                value = _int_or(value, default)
            values[_snake(key)] = default if value is None else value
        return cls(**values)


def _int_or(text: str | None, default: int) -> int:
    if text is None or not re.fullmatch(r"[+-]?[0-9]+", text):
        return default
    number = int(text)
    return number if INT_MIN <= number <= INT_MAX else default


def _snake(key: str) -> str:
    return re.sub(r"[A-Z]", lambda m: "_" + m.group().lower(), key)
