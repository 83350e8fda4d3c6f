"""Numbers in words: digits, teens, tens, hundreds and repeated digits, as digits with source spans."""

from __future__ import annotations

import re

# Digits as words in the corpus languages.
DIGIT_WORDS = {w: str(i) for words in (
    "zero one two three four five six seven eight nine",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun")
    for i, w in enumerate(words.split())} | {"oh": "0"}
# Ten to nineteen, and the tens, as words.
TEENS = {w: 10 + i for i, w in enumerate(
    "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
TENS = {w: 10 * i for words in ("twenty thirty forty fifty sixty seventy eighty ninety",
                                "veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa",
                                "vingt trente quarante cinquante soixante",
                                "zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig")
        for i, w in enumerate(words.split(), 2)}
REPEATS = {"double": 2, "triple": 3}

NUMBER_WORDS = frozenset({*DIGIT_WORDS, *TEENS, *TENS, *REPEATS})
WORD = "|".join(sorted(NUMBER_WORDS, key=len, reverse=True)) + r"|hundred(?:\s+and)?"
GAP = r"[\s,-]+"
UNIT = re.compile(rf"(?:{WORD}|plus|[0-9]+)(?![^\W_])", re.I)

Piece = tuple[int, int, str]


def numbers(text: str, start: int, stop: int) -> list[Piece]:
    """The numbers said in [start, stop) as digits; words that say none are left out."""
    units = [(m.start(), m.end(), m[0].lower()) for m in UNIT.finditer(text, start, stop)]
    out, i = [], 0
    while i < len(units):
        value, n = _number([u[2] for u in units[i:i + 4]])
        if n:
            out.append((units[i][0], units[i + n - 1][1], value))
        i += max(n, 1)
    return out


def _number(words: list[str]) -> tuple[str, int]:
    """The number that the first words say, and how many of them say it."""
    first, *rest = words
    if first == "plus":
        return "+", 1
    if first.isdigit():
        return first, 1
    if first in REPEATS:
        digit = DIGIT_WORDS.get(rest[0], rest[0]) if rest else ""
        return (digit * REPEATS[first], 2) if len(digit) == 1 and digit.isdigit() else ("", 0)
    if first in DIGIT_WORDS:
        digit = DIGIT_WORDS[first]
        if digit != "0" and rest and rest[0].startswith("hundred"):
            value, n = _below_hundred(rest[1:])
            return str(100 * int(digit) + value), 2 + n
        return digit, 1
    value, n = _below_hundred(words)
    return (str(value), n) if n else ("", 0)


def _below_hundred(words: list[str]) -> tuple[int, int]:
    if not words:
        return 0, 0
    first = words[0]
    if first in TEENS:
        return TEENS[first], 1
    if first in TENS:
        digit = int(DIGIT_WORDS.get(words[1], "0")) if len(words) > 1 else 0
        return TENS[first] + digit, 2 if digit else 1
    digit = int(DIGIT_WORDS.get(first, "0"))
    return digit, int(digit > 0)
