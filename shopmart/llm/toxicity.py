"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters and digit
substitutions to the letters they stand for, everything else to single blanks
between words.  Entries are whole words (" word ") and word beginnings
(" stem"), so inflected forms match; where entries start at one place the
heaviest counts.  A text's weight is the sum of its matches, normalised by
the square root of its length in hundreds of words; matches inside an
exception phrase do not count.  A sigmoid maps the weight to a score.

The lexicon is learned from labelled rows: entries whose share among toxic
sample documents exceeds that among the others significantly (G² test),
weighted by the log of the ratio; exception phrases are word pairs around a match
that the clean documents of the sample use.  At most ``per_class`` labelled documents of
each class are used, chosen by a hash of the id, and written once; counts are aggregated
on the executors, and what is significant there comes to the driver, without another cap.

Defined results: null and empty texts have no matches and score like any
text without matches; without labels of both classes the lexicon is empty and
the score a constant; repeated rows, null ids and extra columns pass; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shopmart.llm.common import cut, labelled_sample
from shopmart.llm.linear import fit_sigmoid, sigmoid
from shopmart.llm.lookalikes import fold_char

PER_CLASS = 3000
STEMS = range(4, 9)      # lengths of word beginnings that may be entries
MIN_G2 = 30.0            # significance of an entry
MIN_RATIO = 5.0          # times more usual among toxic documents
# Digits and signs that stand for letters inside words.
SUBSTITUTES = str.maketrans("013457@$", "oieastas")
_ASCII = {i: (chr(i).lower() if chr(i).isalnum() else " ") for i in range(128)}
_ASCII |= {ord(c): chr(n) for c, n in zip("@$", map(ord, "as"))}
_ASCII |= {c: chr(n) for c, n in SUBSTITUTES.items()}
_ODD = re.compile("[^\x00-ɏ]|­")


def fold(text: str) -> str:
    """The text as words between single blanks, one at either end; '' if there is none."""
    if not text.isascii():
        text = _ODD.sub(lambda m: fold_char(m[0]), text)
    folded = text.translate(_ASCII).lower()
    words = folded.split()
    return f" {' '.join(words)} " if words else ""


def _features(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in STEMS if n <= len(w))
    return out


def _sample_features_udf():
    @arrow_udf("array<string>")
    def _sample_features(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(_features(fold(t.as_py() or ""))) for t in texts], pa.list_(pa.string()))

    return _sample_features


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    slope: float = 0.0
    intercept: float = 0.0

    @cached_property
    def _automaton(self):
        machine = ahocorasick.Automaton()
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), None))
        for entry, weight in self.weights.items():
            machine.add_word(entry, (len(entry), weight))
        if len(machine):
            machine.make_automaton()
        return machine

    def __getstate__(self):
        return (self.weights, self.exceptions, self.slope, self.intercept)

    def __setstate__(self, state):
        self.weights, self.exceptions, self.slope, self.intercept = state

    def matches(self, folded: str) -> dict[int, float]:
        """Start of a matching word → heaviest weight there, without exceptions."""
        found: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        if folded and len(self._automaton):
            for end, (size, weight) in self._automaton.iter(folded):
                start = end - size + 1
                if weight is None:
                    excepted.append((start, end))
                else:
                    found[start] = max(found.get(start, 0.0), weight)
        return {p: w for p, w in found.items() if not any(a <= p < b for a, b in excepted)}

    def weight(self, text: str) -> float:
        folded = fold(text)
        total = sum(self.matches(folded).values())
        return float(np.log1p(total / np.sqrt(1 + folded.count(" ") / 100)))

    def score(self, weights: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * weights + self.intercept)


def _prune(rows: list[tuple[str, float]]) -> dict[str, float]:
    """Entries and weights without those that a shorter kept entry covers about as well."""
    kept: dict[str, float] = {}
    for entry, weight in sorted(rows, key=lambda r: (len(r[0].rstrip()), r[0])):
        shorter = [kept[entry[:n]] for n in range(2, len(entry.rstrip()) + 1) if entry[:n] in kept]
        if not shorter or weight > max(shorter) + 0.7:
            kept[entry] = weight
    return kept


def _significant(counts: DataFrame, n1: int, n0: int) -> DataFrame:
    """(entry, weight) of entries that are surely more usual in toxic documents: G² and ratio test.

    ``t`` of n1 toxic and ``c`` of n0 other documents have the entry.
    """
    t, c = F.col("t"), F.col("c")
    p1, p0, both = (t + 0.5) / (n1 + 1), (c + 0.5) / (n0 + 1), (t + c + 1) / (n1 + n0 + 2)
    g2 = 2 * ((t + 0.5) * F.log(p1 / both) + (c + 0.5) * F.log(p0 / both)
              + (n1 - t + 0.5) * F.log((1 - p1) / (1 - both)) + (n0 - c + 0.5) * F.log((1 - p0) / (1 - both)))
    return (counts.select("entry", "t", g2.alias("g2"), F.log(p1 / p0).alias("weight"))
            .where((F.col("t") >= 5) & (F.col("g2") >= MIN_G2) & (F.col("weight") >= float(np.log(MIN_RATIO))))
            .select("entry", "weight"))


def _phrases_udf(lexicon: Lexicon):
    @arrow_udf("array<string>")
    def phrases(texts: pa.Array) -> pa.Array:
        """Word pairs around the matches of each text."""
        out = []
        for t in texts:
            folded, found = fold(t.as_py() or ""), set()
            for start in lexicon.matches(folded):
                end = folded.index(" ", start + 1)
                if end + 1 < len(folded):
                    found.add(folded[start: folded.index(" ", end + 1) + 1])
                if start > 0:
                    found.add(folded[folded.rindex(" ", 0, start): end + 1])
            out.append(sorted(found))
        return pa.array(out, pa.list_(pa.string()))

    return phrases


def _weights_udf(lexicon: Lexicon):
    @arrow_udf("double")
    def weights(texts: pa.Array) -> pa.Array:
        return pa.array([lexicon.weight(t.as_py() or "") for t in texts], pa.float64())

    return weights


def train(docs: DataFrame, labels: DataFrame, label: str, keep: Column,
          per_class: int = PER_CLASS) -> Lexicon:
    """The lexicon of ``label``, learned from rows of labels that ``keep`` allows."""
    sample = cut(labelled_sample(docs, labels, label, keep, per_class))
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Lexicon({}, [], *fit_sigmoid(np.zeros(n1 + n0), np.repeat([1, 0], [n1, n0])))

    def counted(column: Column) -> DataFrame:
        return (sample.select("label", F.explode(column).alias("entry"))
                .groupBy("entry").agg(F.sum("label").alias("t"),
                                      F.sum(1 - F.col("label")).alias("c")))

    entries = _significant(counted(_sample_features_udf()("text")), n1, n0).collect()
    lexicon = Lexicon(_prune([tuple(r) for r in entries]))
    clean = (F.col("c") >= 3) & (F.col("c") * n1 > F.col("t") * n0)
    phrases = counted(_phrases_udf(lexicon)("text")).where(clean).select("entry").collect()
    lexicon = Lexicon(lexicon.weights, sorted(r["entry"] for r in phrases))
    pairs = sample.select("label", _weights_udf(lexicon)("text").alias("w")).toArrow()
    x, y = np.array(pairs["w"].to_pylist(), float), np.array(pairs["label"].to_pylist(), int)
    order = np.lexsort((x, y))
    lexicon.slope, lexicon.intercept = fit_sigmoid(x[order], y[order])
    return lexicon


def score_udf(lexicon: Lexicon):
    """Column function text → probability of label 1."""

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        weights = np.array([lexicon.weight(t.as_py() or "") for t in texts], float)
        return pa.array(lexicon.score(weights))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, label: str, keep: Column,
                    id_col: str = "doc_id", text_col: str = "text",
                    per_class: int = PER_CLASS) -> DataFrame:
    """(id, score) of every document."""
    lexicon = train(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                    labels, label, keep, per_class)
    return docs.select(F.col(id_col), score_udf(lexicon)(F.col(text_col)).alias("score"))
