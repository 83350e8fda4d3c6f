"""Transducers of disguised addresses: each finds the pieces of a text to replace, in order.

They tell disguises by their form, not by lists of names or hosts: character
references, marks around "at" and "dot", joined or capitalised words, spaced letters.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

Piece = tuple[int, int, str]

AT_WORDS, DOT_WORDS = "at|arroba|arobase|bei|chez", "dot|punto|point|punkt"

# Character references of @ . - _ + and digits, and the percent form of @.
_REFERENCE = re.compile(r"&(?:#0{0,4}(?:64|4[35689]|5[0-7]|95)|#x0{0,4}(?:40|2[bde]|3[0-9]|5f)|"
                        r"commat|period|hyphen|lowbar|plus);|(?<=[a-z0-9])%40(?=[a-z0-9])", re.I)
_AT_MARK = re.compile(rf"\s*(?:[\[({{<]\s*(?:{AT_WORDS}|@)\s*[\])}}>]|([*~|=]{{1,3}})\s*(?:{AT_WORDS}|@)\s*\1)\s*",
                      re.I)
_DOT_MARK = re.compile(rf"\s*(?:[\[({{<]\s*(?:{DOT_WORDS}|\.)\s*[\])}}>]|"
                       rf"([*~|=]{{1,3}})\s*(?:{DOT_WORDS}|\.)\s*\1)\s*", re.I)
# name(a)host.top, without spaces.
_A_MARK = re.compile(r"(?<=[A-Za-z0-9])[\[({<]a[\])}>](?=[A-Za-z0-9-]{1,63}\.[A-Za-z]{2})", re.I)
# name_at_host_dot_top and name-at-host-dot-top.
_JOINED = re.compile(r"(?<=[a-z0-9])([_-])at\1(?=[a-z0-9])(?P<host>(?:[a-z0-9]{1,63}\1){1,8}?dot\1[a-z0-9]{2,63}"
                     r"(?:\1dot\1[a-z0-9]{2,63}){0,8})(?![a-z0-9])", re.I)
# nameATexampleDOTcom; also with plain dots.
_CAPITAL = re.compile(r"(?<=[a-z0-9])AT(?P<host>[a-z0-9-]{1,63}(?:(?:DOT|\.)[a-z0-9-]{1,63}){0,8}?"
                      r"(?:DOT|\.)[a-z]{2,63})(?![A-Za-z0-9])")
# Single characters with blanks between them: an at and a dot among them, or the words.
_SPACED = re.compile(r"(?<!\S)(?:[A-Za-z0-9@._+-]\s{1,3}+){6,200}[A-Za-z0-9](?![^\s.,;:!?)])")
_SPACED_SIGN = re.compile(r"@|\sa\st\s", re.I)
_BLANKS = re.compile(r"\s+")


def references(text: str) -> Iterator[Piece]:
    for m in _REFERENCE.finditer(text):
        yield *m.span(), "@" if m[0][0] == "%" else html.unescape(m[0].lower()).replace("‐", "-")


def spaced(text: str) -> Iterator[Piece]:
    """One blank between single characters goes, wider ones become one blank."""
    for m in _SPACED.finditer(text):
        if _SPACED_SIGN.search(m[0]):
            for gap in _BLANKS.finditer(text, *m.span()):
                yield *gap.span(), "" if gap.end() - gap.start() == 1 else " "


def marked_dots(text: str) -> Iterator[Piece]:
    for m in _DOT_MARK.finditer(text):
        yield *m.span(), "."


def marked_ats(text: str) -> Iterator[Piece]:
    for m in _AT_MARK.finditer(text):
        yield *m.span(), "@"


def marked_a(text: str) -> Iterator[Piece]:
    for m in _A_MARK.finditer(text):
        yield *m.span(), "@"


def joined(text: str) -> Iterator[Piece]:
    for m in _JOINED.finditer(text):
        yield m.start(), m.start("host"), "@"
        for dot in re.finditer(rf"{m[1]}dot{m[1]}", m["host"], re.I):
            yield m.start("host") + dot.start(), m.start("host") + dot.end(), "."


def capitals(text: str) -> Iterator[Piece]:
    for m in _CAPITAL.finditer(text):
        yield m.start(), m.start("host"), "@"
        for dot in re.finditer("DOT", m["host"]):
            yield m.start("host") + dot.start(), m.start("host") + dot.end(), "."


# In this order; each with what a text (as it is, in lower case) must hold to be worth it.
TRANSDUCERS: list[tuple[Callable[[str, str], bool], Callable[[str], Iterator[Piece]]]] = [
    (lambda text, low: "&" in text or "%40" in text, references),
    (lambda text, low: "@ " in text or " a t " in low or "\ta\tt\t" in low, spaced),
    (lambda text, low: True, marked_dots),
    (lambda text, low: True, marked_ats),
    (lambda text, low: any(f"{a}a{b}" in low for a, b in ("()", "[]", "{}", "<>")), marked_a),
    (lambda text, low: "_at_" in low and "_dot_" in low or "-at-" in low and "-dot-" in low, joined),
    (lambda text, low: "AT" in text, capitals),
]
# Signs of the transducers that a text seldom has by chance.
_SIGN = re.compile(rf"[\[({{<*~|=]\s*(?:{AT_WORDS}|{DOT_WORDS}|[@.])\s*[\])}}>*~|=]", re.I)


def signs(text: str, low: str) -> bool:
    """Whether any transducer may change the text."""
    if _SIGN.search(text):
        return True
    return any(worth(text, low) and next(pieces(text), None) is not None
               for worth, pieces in TRANSDUCERS if pieces not in (marked_dots, marked_ats))
