"""Text normalisation for matching."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, functions as F

# Dutch legal-form abbreviations, with or without dots.
LEGAL_SUFFIXES = ("bv", "nv", "vof")

# Letters that are no base letter with marks, and what they fold to.
STROKED = {"ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ŧ": "t", "ı": "i", "ς": "σ"}
LIGATURES = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}

# Lower-case letters of the Latin, Greek and Cyrillic blocks and of their extensions.
BLOCKS = (range(0x00DF, 0x0530), range(0x1E00, 0x2000))


def folds() -> dict[str, str]:
    """Letter with marks -> its base letter, by canonical decomposition."""
    found = dict(STROKED)
    for code in (c for block in BLOCKS for c in block):
        first, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and chr(code).islower() and all(map(unicodedata.combining, marks)):
            found[chr(code)] = STROKED.get(first, first)
    return found


FOLDS = folds()


def suffix_pattern(suffixes=LEGAL_SUFFIXES) -> str:
    """Whole-word pattern for the suffixes: "bv", "b.v.", "b.v", runs of several."""
    one = "|".join(r"\.?".join(re.escape(ch) for ch in s) + r"\.?" for s in suffixes)
    return rf"(^|[^\p{{L}}\p{{N}}_])(?:{one})(?:\s+(?:{one}))*(\s|$)"


def match_text(column: Column, suffixes=LEGAL_SUFFIXES) -> Column:
    """Lower case, no accents, no legal suffixes, letters and digits of any script only; NULL -> ''.

    Marks go, whether they are part of a letter or follow it; scripts are kept apart, so a name that is
    written in Greek or Cyrillic keeps a key of its own.
    """
    text = F.translate(F.lower(column), "".join(FOLDS), "".join(FOLDS.values()))
    for letter, plain in LIGATURES.items():
        text = F.replace(text, F.lit(letter), F.lit(plain))
    text = F.regexp_replace(text, r"\p{M}", "")
    if suffixes:
        text = F.regexp_replace(text, suffix_pattern(suffixes), " ")
    return F.coalesce(F.regexp_replace(text, r"[^\p{L}\p{N}_]", ""), F.lit(""))
