"""Text clean-up: accents, contact handles, padding, lengths."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The Vietnamese vowels and the combining marks of the five written tones.
VOWELS = "aăâeêioôơuưy"
TONE_MARKS = ("̀", "́", "̃", "̉", "̣")
STROKED = {"đ": "d", "Đ": "D"}


def _accent_table() -> dict[str, str]:
    table = dict(STROKED)
    for vowel in VOWELS + VOWELS.upper():
        plain = unicodedata.normalize("NFD", vowel)[0]
        for mark in ("", *TONE_MARKS):
            letter = unicodedata.normalize("NFC", vowel + mark)
            if letter != plain:
                table[letter] = plain
    return table


ACCENTS = _accent_table()
ACCENTED = "".join(ACCENTS)
FOLDED = "".join(ACCENTS.values())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_accents(text: Column | str) -> Column:
    """Vietnamese letters to their ASCII base, letter by letter; all else unchanged."""
    return F.translate(_col(text), ACCENTED, FOLDED)


def contact_handle(text: Column | str) -> Column:
    """Lower case, accents folded, only ``a-z0-9`` kept."""
    return F.regexp_replace(fold_accents(F.lower(_col(text))), "[^a-z0-9]", "")


def clip(text: Column | str, length: int = 255) -> Column:
    return F.substring(_col(text), 1, length)


def trim_padding(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop trailing blanks that the named fixed-width source columns carry when read.

    Without this, ``'e_wallet     '`` never equals ``'e_wallet'`` in a join.
    """
    return df.withColumns({c: F.rtrim(F.col(c)) for c in columns}) if columns else df
