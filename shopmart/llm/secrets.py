"""Secret scans: base patterns, and random-looking strings by Markov log-likelihood ratio.

Two character models of order two are fitted on trigram counts of the whole
corpus: of strings known to be random (values that the base patterns found, and
as a prior strings drawn uniformly from the usual alphabets) and of all ordinary
identifiers and words.  Every occurrence counts.  A candidate token is a secret
when its log-likelihood ratio says so both in total and per character, and it
mixes letters and digits, or is a longer string of many different letters only.  The ratio
per character that is asked for follows from random strings that the models have not
seen: half of what all but a fiftieth of them reach.  Digits alone are never added,
as ordinary numbers are as likely.

Base patterns are matched leftmost and non-overlapping per kind; matches that
are too short are dropped.  Added spans touch no base span.

Defined results: null text is empty; without ordinary strings nothing is
added; repeated rows, null ids and extra columns pass; empty tables
give empty results.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shopmart.llm.spans import Span, finder_udf, ordered

KINDS = ("assign", "access", "hex", "random")

# ASCII case folding only; the value itself may be of either case.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?"""
                     r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_KEYWORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")

ALPHABET = string.ascii_letters + string.digits + "+/_.=-"
SIDE = len(ALPHABET) + 1  # character codes; 0: outside of a string
CELLS = SIDE ** 3         # trigrams: (before two, before one, character)
BLOCK_BYTES = 1 << 20     # text counted at once
DRAWN = 5000              # drawn strings that the random side has at least ...
DRAWN_SHARE = 0.25        # ... and their share of what the base patterns found
MIN_TOTAL = 20.0        # nats that a secret's ratio reaches in total ...
MIN_MEAN = 0.8          # ... and per character at least
MISSED = 0.02           # share of held-back random strings below twice the ratio asked for
MIN_LETTERS, MIN_DISTINCT = 20, 8  # length and different letters of a secret without digits


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return ordered(out, KINDS)


DRAWN_ALPHABETS = [
    string.digits + "abcdef", string.ascii_letters + string.digits,
    string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits,
    string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-"]
DRAWN_LENGTHS = (16, 64)


def drawn_strings(n: int, seed: int = 7) -> list[str]:
    """Uniform strings over the alphabets that secrets use."""
    rng = random.Random(seed)
    return ["".join(rng.choices(DRAWN_ALPHABETS[i % len(DRAWN_ALPHABETS)], k=rng.randint(*DRAWN_LENGTHS)))
            for i in range(n)]


def drawn_counts() -> np.ndarray:
    """Trigrams that one drawn string has on average."""
    out = np.zeros((SIDE, SIDE, SIDE))
    inner = sum(DRAWN_LENGTHS) / 2 - 2
    for alphabet in DRAWN_ALPHABETS:
        k = len(alphabet)
        codes = np.array([MarkovRatio.CODE[c] for c in alphabet])
        out[0, 0, codes] += 1 / k
        out[0][np.ix_(codes, codes)] += 1 / k ** 2
        out[np.ix_(codes, codes, codes)] += inner / k ** 3
    return out / len(DRAWN_ALPHABETS)


@dataclass
class MarkovRatio:
    """Log-likelihood ratio of a string's characters, each given the two before."""

    ratio: np.ndarray  # (before two, before one, character), as int16 codes

    CODE = {c: i + 1 for i, c in enumerate(ALPHABET)}  # 0: start of the string

    @classmethod
    def fit(cls, secret: list[str], plain: list[str], prior: float = 0.5) -> MarkovRatio:
        def counts(strings: list[str]) -> np.ndarray:
            three = np.zeros((SIDE, SIDE, SIDE))
            for s in strings:
                codes = [0, 0, *(cls.CODE[c] for c in s if c in cls.CODE)]
                if len(codes) > 2:
                    np.add.at(three, (codes[:-2], codes[1:-1], codes[2:]), 1)
            return three

        return cls.of_counts(counts(secret), counts(plain), prior)

    @classmethod
    def of_counts(cls, secret: np.ndarray, plain: np.ndarray, prior: float = 0.5) -> MarkovRatio:
        """Models of trigram counts of either class."""
        def log_probabilities(three: np.ndarray) -> np.ndarray:
            two, one = three.sum(axis=0), three.sum(axis=(0, 1))
            p1 = (one + prior) / (one + prior).sum()
            p2 = (two + 10 * p1) / (two + 10 * p1).sum(axis=1, keepdims=True)
            p3 = (three + 10 * p2) / (three + 10 * p2).sum(axis=2, keepdims=True)
            return np.log(p3)

        if not plain.any():  # nothing to tell secrets from
            return cls(np.full((SIDE, SIDE, SIDE), -1.0))
        return cls(log_probabilities(secret) - log_probabilities(plain))

    def of(self, token: str) -> float:
        codes = [0, 0, *(self.CODE[c] for c in token)]
        return float(self.ratio[codes[:-2], codes[1:-1], codes[2:]].sum())


def held_back(letters_only: bool, n: int = 600, seed: int = 11) -> list[str]:
    """Random strings of either kind, as short as found ones may be."""
    rng = random.Random(seed)
    if letters_only:
        alphabets = [string.ascii_letters, string.ascii_lowercase, string.ascii_uppercase]
        return ["".join(rng.choices(alphabets[i % 3], k=MIN_LETTERS + i % 9)) for i in range(n)]
    strings = ("".join(rng.choices(DRAWN_ALPHABETS[i % len(DRAWN_ALPHABETS)], k=16 + i % 9)) for i in range(2 * n))
    return [s for s in strings if s.strip(ALPHABET[-6:]) == s and mixed(s)][:n]


def mixed(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.isalpha() for c in token)


def least_mean(model: MarkovRatio, letters_only: bool) -> float:
    """Ratio per character that a secret needs, from strings that the models have not seen."""
    means = [model.of(s) / len(s) for s in held_back(letters_only)]
    return max(MIN_MEAN, float(np.quantile(means, MISSED)) / 2)


def finder(model: MarkovRatio):
    """text → (base spans, base spans with those the model adds)."""
    mean_mixed, mean_letters = least_mean(model, False), least_mean(model, True)

    def find(text: str) -> tuple[list[Span], list[Span]]:
        base = base_spans(text)
        added = []
        for m in _TOKEN.finditer(text):
            token = m[0].rstrip(".=-")
            if mixed(token):
                mean = mean_mixed
            elif len(token) >= MIN_LETTERS and token.isalpha() and len(set(token)) >= MIN_DISTINCT:
                mean = mean_letters
            else:
                continue
            start, stop = m.start(), m.start() + len(token)
            if any(s < stop and start < e for _, s, e in base):
                continue
            score = model.of(token)
            if len(token) >= 16 and score >= MIN_TOTAL and score >= mean * len(token):
                added.append(("random", start, stop))
        return base, ordered(base + added, KINDS)

    return find


_CODES = np.zeros(256, np.uint8)  # of UTF-8 bytes
for _c, _code in MarkovRatio.CODE.items():
    _CODES[ord(_c)] = _code


def _byte_spans(text: str, spans: list[Span]) -> list[Span]:
    """Spans in bytes of the UTF-8 text."""
    if not spans or text.isascii():
        return spans
    at, done, size = {}, 0, 0
    for place in sorted({p for _, a, b in spans for p in (a, b)}):
        size += len(text[done:place].encode())
        at[place], done = size, place
    return [(k, at[a], at[b]) for k, a, b in spans]


def _blocks(texts: Iterable[str | None]) -> Iterator[tuple[bytes, list[Span]]]:
    """Texts joined to blocks, a separator behind each, with their base spans."""
    parts, spans, size = [], [], 0
    for text in texts:
        if not text:
            continue
        spans += [(k, size + a, size + b) for k, a, b in _byte_spans(text, base_spans(text))]
        parts += [text.encode(), b"\n"]
        size += len(parts[-2]) + 1
        if size >= BLOCK_BYTES:
            yield b"".join(parts), spans
            parts, spans, size = [], [], 0
    if parts:
        yield b"".join(parts), spans


def trigram_counts(texts: Iterable[str | None]) -> np.ndarray:
    """(2, CELLS): trigrams of the plain strings of four characters or more, and of the secret ones.

    A string that an access or hex span touches is secret; one that only an
    assign span touches is neither.
    """
    out = np.zeros((2, CELLS), np.int64)
    for data, spans in _blocks(texts):
        codes = _CODES[np.frombuffer(data, np.uint8)]
        mark = np.zeros(len(codes), np.uint8)
        for kind, a, b in spans:
            np.maximum(mark[a:b], 1 if kind == "assign" else 2, out=mark[a:b])
        inside = codes > 0
        edges = np.flatnonzero(np.diff(inside, prepend=False))  # starts and stops in turn
        if not len(edges):
            continue
        sizes = edges[1::2] - edges[::2]
        side = np.array([1, 0, 2], np.uint8)[np.maximum.reduceat(mark, edges)[::2]]
        side[sizes < 4] = 0
        mark[inside] = np.repeat(side, sizes)
        mark[~inside] = 0
        codes = np.concatenate([np.zeros(2, np.uint8), codes])
        for lo in range(0, len(mark), BLOCK_BYTES):
            hi = min(lo + BLOCK_BYTES, len(mark))
            one = codes[lo + 1:hi + 1].astype(np.int32)
            two = codes[lo:hi].astype(np.int32) * (one > 0)
            cell = (two * SIDE + one) * SIDE + codes[lo + 2:hi + 2]
            for i in (0, 1):
                if len(of_side := cell[mark[lo:hi] == i + 1]):
                    out[i] += np.bincount(of_side, minlength=CELLS)
    return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of a partition's texts that are not empty."""
    n = trigram_counts(t.as_py() for batch in batches for t in batch.column(0)).ravel()
    cell = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(n[cell], pa.int64())],
                                     ["cell", "n"])


def train(docs: DataFrame, text_col: str = "text") -> MarkovRatio:
    """Models fitted on the trigram counts of all strings of all documents.

    Each task sends at most 2 * CELLS sums, and as many reach the driver; only
    the counts grow with the input.
    """
    sums = (docs.select(F.col(text_col).alias("text")).mapInArrow(_count_batches, "cell int, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    n = np.zeros(2 * CELLS)
    n[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    plain, secret = n.reshape(2, SIDE, SIDE, SIDE)
    # The prior keeps its share, so that other alphabets than those found stay likely.
    one = drawn_counts()
    drawn = one * max(DRAWN, DRAWN_SHARE * secret.sum() / one.sum())
    return MarkovRatio.of_counts(secret + drawn, plain)


def secrets_column(text: Column, model: MarkovRatio) -> Column:
    """struct of base and all spans of a text column."""
    return finder_udf(finder(model))(text)


def masked_udf(model: MarkovRatio, mask: str = "[SECRET]"):
    """Column function text → text with every found span replaced; null stays null."""
    find = finder(model)

    @arrow_udf("string")
    def masked(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            source = text.as_py()
            parts, done = [], 0
            for _, a, b in find(source)[1] if source else []:
                if b <= done:
                    continue
                parts += [source[done:a], mask] if a >= done else []
                done = b
            out.append("".join(parts) + source[done:] if parts else source)
        return pa.array(out, pa.string())

    return masked
