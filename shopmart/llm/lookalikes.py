"""Characters that imitate ASCII ones."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

# Letters of other scripts that look like Latin ones, pairwise below each other.
_CYRILLIC = "аеорсухіјѕԁһӏԛԝАВЕКМНОРСТУХІЈЅ"
_AS_LATIN = "aeopcyxijsdhlqwABEKMHOPCTYXIJS"
_GREEK = "οαινκρτυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
_AS_LATIN_TOO = "oaivkptuABEZHIKMNOPTYX"
LETTERS = dict(zip(_CYRILLIC + _GREEK, _AS_LATIN + _AS_LATIN_TOO, strict=True))
# Soft hyphen, zero-width space, non-joiner, joiner, word joiner, byte order mark.
INVISIBLE = "­​‌‍⁠﻿"

# Ways of writing a character that Unicode maps to the plain one; full-width, mathematical, circled ...
STYLES = frozenset("<font> <circle> <square> <wide> <small> <narrow>".split())


@lru_cache(maxsize=4096)
def fold_char(c: str) -> str:
    """The ASCII character that ``c`` imitates, nothing for invisible ones, else ``c`` itself."""
    if c.isascii():
        return c
    if c in LETTERS:
        return LETTERS[c]
    if c in INVISIBLE:
        return ""
    if "🅐" <= c <= "🅩" or "🅰" <= c <= "🆉":  # white letters on black have no decomposition
        return chr(ord("A") + ord(c) - ord("🅐" if c <= "🅩" else "🅰"))
    if unicodedata.decomposition(c).partition(" ")[0] in STYLES:
        plain = unicodedata.normalize("NFKC", c)
        return plain if len(plain) == 1 and plain.isascii() else c
    if c in "。｡․":
        return "."
    if "‐" <= c <= "–" or c == "−":
        return "-"
    value = unicodedata.decimal(c, None)
    return c if value is None else str(value)
