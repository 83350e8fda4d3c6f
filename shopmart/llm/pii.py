"""Personal data: base patterns, and disguised identifiers found by offset-preserving rewriting.

A text with signs of disguise goes through transducers: look-alike characters
and invisible ones, character references, spaced letters, at/dot disguises, numbers in words.  Each rewrites pieces
of the text and carries, for every character it puts out, the source span the character
stands for; identifiers are detected in the result and their spans mapped back.
A span found this way is added when it touches no base span, or holds a base span of its
kind and more (a look-alike cuts an address short); base spans stay.

Base patterns are matched leftmost and non-overlapping per kind; a match that
fails its check (range, Luhn, digit count) is dropped without another try.

Defined results: null text is empty; no spans give an empty list; repeated
rows, null ids and extra columns pass; an empty table gives an empty result.
Long texts are scanned in one pass in linear time.
"""

from __future__ import annotations

import re
from itertools import islice

from pyspark.sql import Column

from shopmart.llm import disguises, spoken
from shopmart.llm.disguises import AT_WORDS, DOT_WORDS
from shopmart.llm.lookalikes import fold_char
from shopmart.llm.spans import Span, finder_udf, ordered
from shopmart.llm.spoken import DIGIT_WORDS

KINDS = ("email", "ip", "card", "phone")

# Runs are possessive where giving characters back cannot lead to a match, and start
# only where a run starts: the same matches, in linear time.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str):
    done = 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at:
            done = m.end()
            yield start, done


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    double = str.maketrans("0123456789", "0246813579")
    total = sum(map(int, digits[-1::-2])) + sum(map(int, digits[-2::-2].translate(double)))
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                if 9 <= len(_digits(m[0])) <= 15]
    return ordered(out, KINDS)


class Rewritten:
    """A text with the source span of every character."""

    def __init__(self, text: str):
        self.text = text
        self.start = list(range(len(text)))
        self.stop = list(range(1, len(text) + 1))

    def replace(self, pieces: list[tuple[int, int, str]]) -> None:
        """Replace [a, b) by a string, for pieces in order; it stands for the whole piece."""
        text, start, stop, done = [], [], [], 0
        for a, b, new in pieces:
            text += [self.text[done:a], new]
            start += self.start[done:a] + [self.start[a]] * len(new)
            stop += self.stop[done:a] + [self.stop[b - 1]] * len(new)
            done = b
        self.text = "".join(text) + self.text[done:]
        self.start = start + self.start[done:]
        self.stop = stop + self.stop[done:]


_ODD = re.compile("[^\x00-\u00ac\u00ae-\u024f]")
# Bare words count only as a whole address: name at host dot top-level domain, of any letters.
# The usual top-level domains that are no common words hold without other evidence.
_TOP = frozenset("com net org edu gov mil info biz dev io ai eu uk de fr es ch nl se pl cz pt dk fi ie "
                 "ru jp cn kr au nz br mx ca za".split())
_BARE = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?P<local>[A-Za-z0-9._%+-]++)(?P<at>\s+(?:{AT_WORDS}|@)\s+|@)"
    rf"(?:[A-Za-z0-9-]+(?:\s+(?:{DOT_WORDS}|\.)\s+|\.))+[A-Za-z]{{2,63}}(?![A-Za-z0-9-])", re.I)
_LABEL = re.compile(rf"([A-Za-z0-9-]+)(\s+(?:{DOT_WORDS}|\.)\s+|\.)?", re.I)
# Words of ordinary text around "at ... dot ...", where more evidence is needed
# (as a top-level domain) or the words are no address (as a name or host).
_COMMON = frozenset(
    "a about after all also am an and are as at be because been before but by can de do el en for from "
    "go had has have he her here his how i if in into is it its la le me more my no not now of on one "
    "or our out she so than that the their them then there these they this those to un up us was we "
    "were what when where which who will with would y you your".split()) | frozenset(
    "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty "
    "forty fifty sixty seventy eighty ninety hundred".split()) | frozenset(DIGIT_WORDS)
_NO_HOST = _COMMON | frozenset(
    "another any big black blue bright brown center centre dark each every first green grey last little "
    "micro orange pink polka purple quantum red same second single small some third tiny white "
    "yellow".split())
_NO_NAME = _COMMON | frozenset(
    "account accounts address aim aimed arrive arrived arrives available book call come contact docs "
    "download email emails find form found glance glanced inbox information join laugh laughed learn "
    "list live login look looked looking looks mail meet met online order orders page point pointed "
    "pointing points read register see shop shout site smile smiled stare stared stares staring start "
    "started starts stop stopped stops store visit website went work working works".split())
_PLACES = ("bei", "chez")  # also say where somebody is: more evidence is needed
_MARKED = re.compile(r"[A-Za-z0-9][._%+-][A-Za-z0-9]|[A-Za-z][0-9]|[0-9][A-Za-z]")
_MARKED_HOST = re.compile(r"[A-Za-z0-9]-[A-Za-z0-9]|[A-Za-z][0-9]|[0-9][A-Za-z]")
# A name of words and marks, but no version, file or domain.
_PLAIN_NAME = re.compile(r"(?=.*[._]|.*[0-9])[a-z]{2,}[a-z0-9]*(?:[._][a-z0-9]+)*|[a-z](?:[._][a-z]{2,}[0-9]*)+",
                         re.I)
_NO_PLAIN_NAME = re.compile(r".*\.(?:[0-9].*|c|cpp|css|csv|doc|docx|exe|gz|h|htm|html|java|jar|jpg|js|json|md|pdf|"
                            r"php|png|py|sh|sql|tar|ts|txt|xls|xml|yml|yaml|zip|" + "|".join(_TOP) + ")", re.I)
MAX_LABELS = 127  # of a domain name, as DNS has it
_NEAR = 40  # characters beside an address where a cue counts
_ADDRESS_CUE = re.compile(
    r"@|(?<![^\W_])(?:e-?mail\w*|mail(?:s|ed|ing|to)?|writ(?:e|es|ing)|contact\w*|reach|address(?:es)?|"
    r"inbox|correos?|escrib\w+|courriels?|adresse|écri\w+|schreib\w*|kontakt\w*)(?![^\W_])", re.I)
_ARTICLE = re.compile(r"(?<![^\W_])(?:an?|the|our|my|your|his|her|their|this|that|any|each|every)\s+$", re.I)
_ALONE_BEFORE = re.compile(r"(?:^|[\n:;,(\[<\"'–—-])[^\S\n]*$")
_ALONE_AFTER = re.compile(r"[^\S\n]*(?:$|[\n.,;:!?)\]>\"'])")
_NUMBER_DOT = re.compile(rf"(?<=[0-9])\s+(?:{DOT_WORDS})\s+(?=[0-9])", re.I)
_WORD = spoken.WORD
_SPELLED = re.compile(rf"(?<![^\W_])(?:(?:plus\s+)?(?:{_WORD})(?:{spoken.GAP}(?:{_WORD}|[0-9]+))"
                      rf"{{3,}}|plus\s+[0-9]+(?:{spoken.GAP}(?:{_WORD}|[0-9]+)){{2,}})(?![^\W_])", re.I)
_OCTET = rf"(?:{_WORD}|[0-9]+)(?:[\s-]+(?:{_WORD}|[0-9]+)){{0,4}}"
_SPELLED_IP = re.compile(rf"(?<![^\W_]){_OCTET}(?:\s+(?:{DOT_WORDS})\s+{_OCTET}){{3}}(?![^\W_])", re.I)
_SAID_DOT = re.compile(rf"\s+(?:{DOT_WORDS})\s+", re.I)
# Letters that stand for digits, in numbers whose every group has a digit.
DIGIT_LETTERS = str.maketrans("OoIlSB", "001158")
_CONFUSED = re.compile(r"(?<![A-Za-z0-9])[0-9OoIlSB](?:[ .()-]{0,2}[0-9OoIlSB]){6,}(?![A-Za-z0-9])")
# What any disguise needs; texts without it are not rewritten.
_CUE = re.compile(rf"\s(?:{AT_WORDS})\s+[A-Za-z0-9-]++\.[A-Za-z0-9]|\s(?:{DOT_WORDS}|@)\s", re.I)
_CUE_NUMBER = re.compile(rf"(?<![^\W_])(?:plus|{_WORD}){spoken.GAP}(?:{_WORD}|[0-9]+)(?![^\W_])", re.I)
_CUE_DIGIT = re.compile("[0-9][OoIlSB]|[OoIlSB][0-9]")


def _spelled(text: str, start: int, stop: int) -> list[tuple[int, int, str]]:
    """Numbers in words as digits; what stands between them goes."""
    out, done = [], start
    for a, b, new in spoken.numbers(text, start, stop):
        if done > start and done < a and not text[done:a].strip(" \t\r\n\f\v,-"):
            out.append((done, a, ""))
        if text[a:b] != new:
            out.append((a, b, new))
        done = b
    return out


def _spelled_ip(m: re.Match) -> list[tuple[int, int, str]]:
    """Four numbers in words with dots said between them."""
    out, at = [], m.start()
    for dot in _SAID_DOT.finditer(m.string, *m.span()):
        out += _spelled(m.string, at, dot.start()) + [(*dot.span(), ".")]
        at = dot.end()
    return out + _spelled(m.string, at, m.end())


_LETTERS = re.compile(r"[^\W\d_]+")


def _confused(m: re.Match) -> list[tuple[int, int, str]]:
    """Letters of a number as the digits they stand for."""
    groups = re.findall(r"[0-9A-Za-z]+", m[0])
    digits = sum(c.isdigit() for c in m[0])
    if digits < 0.5 * sum(map(len, groups)) or not all(any(c.isdigit() for c in g) for g in groups):
        return []
    return [(m.start() + i, m.start() + i + 1, c.translate(DIGIT_LETTERS))
            for i, c in enumerate(m[0]) if c.isalpha()]


def _is_address(text: str, m: re.Match, labels: list[re.Match], usual: bool) -> bool:
    """Whether a name, an at and these labels of a host are an address; ``usual``: fewer labels are one."""
    top, seps = labels[-1][1].lower(), [x[2] for x in labels[:-1]]
    spelled = any(x.strip(" \t\r\n.") for x in seps)
    spaced = any(x != "." and x.strip() == "." for x in seps)
    if not (spelled or spaced) and m["at"] == "@":
        return False  # a plain address
    sure = m["at"].strip().lower() not in _PLACES
    if top in _TOP and (spelled or spaced) and sure:
        return True
    if len(top) < 2 or not (top.isascii() and top.isalpha()) or usual and (spaced or top in _COMMON):
        return False
    at, local, host = m["at"].strip().lower(), m["local"], labels[0][1].lower()
    start, stop = m.start(), labels[-1].end(1)
    before, after = text[max(start - _NEAR, 0):start], text[stop:stop + _NEAR]
    named = local.lower() not in _NO_NAME and any(c.isalpha() for c in local) and not _ARTICLE.search(before)
    cue = bool(_ADDRESS_CUE.search(before) or _ADDRESS_CUE.search(after))
    marked = any(c.isalpha() for c in local) and bool(_MARKED.search(local))
    if not (sure or marked or cue and named and spelled):
        return False
    if spaced:
        return at == "@" and named and (marked or cue)
    if not spelled:
        if _PLAIN_NAME.fullmatch(local) and not _NO_PLAIN_NAME.fullmatch(local):
            return True
        return named and local.isalpha() and (cue or at == "@" and top in _TOP
                                              or any("mail" in x[1].lower() for x in labels[:-1]))
    if at not in ("at", *_PLACES) or marked or not sure:
        return True
    if not named or host in _NO_HOST:
        return False
    only_dots = all(x == "." or x.strip().lower() == "dot" for x in seps)
    return (only_dots and top not in _COMMON or len(labels) > 2 or cue
            or any(_MARKED_HOST.search(x[1]) for x in labels)
            or bool(_ALONE_BEFORE.search(before) and _ALONE_AFTER.match(after)))


def _bare(text: str) -> list[tuple[int, int, str]]:
    """The at and dots of bare addresses; of the labels as many as hold as an address."""
    out, pos = [], 0
    while m := _BARE.search(text, pos):
        pos = m.end("at")
        labels = list(islice(_LABEL.finditer(text, pos, m.end()), MAX_LABELS))
        tops = [i for i, x in enumerate(labels) if x[1].lower() in _TOP]
        for k in range(len(labels), 1, -1):
            if _is_address(text, m, labels[:k], bool(tops) and 1 <= tops[-1] < k - 1):
                out += [(*m.span("at"), "@")] if m["at"] != "@" else []
                out += [(*x.span(2), ".") for x in labels[:k - 1] if x[2] != "."]
                pos = labels[k - 1].end(1)
                break
    return out


def rewrite(text: str) -> Rewritten:
    out = Rewritten(text)
    if not text.isascii():
        out.replace([(m.start(), m.end(), new) for m in _ODD.finditer(out.text)
                     if (new := fold_char(m[0])) != m[0]])
    for worth, pieces in disguises.TRANSDUCERS:
        if worth(out.text, out.text.lower()):
            out.replace(list(pieces(out.text)))
    out.replace(_bare(out.text))
    out.replace([p for m in _SPELLED_IP.finditer(out.text) for p in _spelled_ip(m)])
    out.replace([p for m in _SPELLED.finditer(out.text) for p in _spelled(out.text, *m.span())])
    out.replace([(*m.span(), ".") for m in _NUMBER_DOT.finditer(out.text)])
    out.replace([p for m in _CONFUSED.finditer(out.text) for p in _confused(m)])
    return out


def _has_cue(text: str) -> bool:
    low = text.lower()
    return bool(_CUE.search(text) or _CUE_DIGIT.search(text) or disguises.signs(text, low)
                or not spoken.NUMBER_WORDS.isdisjoint(_LETTERS.findall(low)) and _CUE_NUMBER.search(text)
                or "plus" in low and _CUE_NUMBER.search(text))


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with those of disguised identifiers."""
    base = base_spans(text)
    odd = not text.isascii() and any(fold_char(m[0]) != m[0] for m in _ODD.finditer(text))
    if not odd and not _has_cue(text):
        return base, base
    new = rewrite(text)
    if new.text == text:
        return base, base
    added = []
    for kind, a, b in base_spans(new.text):
        start, stop = new.start[a], new.stop[b - 1]
        if all(stop <= s or e <= start or (k == kind and start <= s and e <= stop
                                           and (start, stop) != (s, e)) for k, s, e in base):
            added.append((kind, start, stop))
    return base, ordered(base + added, KINDS)


def pii_column(text: Column) -> Column:
    """struct of base and all spans of a text column."""
    return finder_udf(find)(text)
