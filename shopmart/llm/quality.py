"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Features are indicators, hashed to ``2**BITS`` slots: words and word pairs; one to three
word shapes (letters, capitals, digits and punctuation with runs collapsed);
and one to three flags of a word repeating the one before.  Each indicator is
scaled by its class log-count ratio, a text's vector has unit length before
scaling, and a linear hinge-loss model is fitted by dual coordinate descent.
Scores are margins through a sigmoid that was fitted on margins of held-back
halves of the training sample.

Training uses at most ``per_class`` labelled documents of each class, chosen
by a hash of the id (a documented bound; only their feature numbers come to
the driver); scoring reads every whole text, with no shuffle.

Defined results: null and empty texts have no features and score the
intercept; without labels of both classes every score is the same constant;
repeated rows, null ids and extra columns pass; an empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shopmart.llm import bytehash
from shopmart.llm.common import labelled_sample
from shopmart.llm.linear import fit_sigmoid, sigmoid

BITS = 18
PER_CLASS = 2000
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B], _SHAPE[0x61:0x7B], _SHAPE[0x30:0x3A] = ord("A"), ord("a"), ord("0")
_SHAPE[0x80:] = ord("a")


def _grams(tokens: np.ndarray, text: np.ndarray, kind: int, longest: int):
    """Hashes and text numbers of the runs of 1 to ``longest`` tokens inside texts."""
    value = tokens
    for n in range(1, longest + 1):
        if n > 1:
            value = value[:-1] * np.uint64(bytehash.BASE) + tokens[n - 1:]
        owner = text[: len(value)]
        inside = owner == text[n - 1:]
        salt = np.uint64((kind * 8 + n) * bytehash.INVERSE % (1 << 64))
        yield bytehash.mix(value[inside] ^ salt), owner[inside]


def features(buf: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """(text number, slot) of the distinct features of a block of texts, by text."""
    starts, ends, words = bytehash.words(buf, offsets, _WORD, bytehash.CODES)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.searchsorted(offsets, starts, "right") - 1
    shape = _SHAPE[buf]
    keep = np.ones(len(buf), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[starts] = True
    keep[~_WORD[buf]] = False
    place = np.concatenate(([0], np.cumsum(keep)))
    pre = bytehash.prefix(shape[keep])
    shapes = bytehash.span_hash(pre, place[starts], place[ends])
    again = np.zeros(len(words), np.uint64)
    again[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    keys = []
    for kind, (tokens, longest) in enumerate(((words, 2), (shapes, 3), (again + np.uint64(1), 3))):
        for value, owner in _grams(tokens, text, kind, longest):
            keys.append(owner.astype(np.int64) << bits | (value >> np.uint64(64 - bits)).astype(np.int64))
    found = np.unique(np.concatenate(keys))
    return found >> bits, found & ((1 << bits) - 1)


def _blocks(texts: pa.Array):
    buf, offsets = bytehash.text_bytes(texts)
    for lo, hi in bytehash.blocks(np.diff(offsets)):
        yield lo, hi, buf[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]


def _feature_slots_udf():
    @arrow_udf("array<int>")
    def _feature_slots(texts: pa.Array) -> pa.Array:
        out = []
        for lo, hi, buf, offsets in _blocks(texts):
            owner, slot = features(buf, offsets)
            edges = np.searchsorted(owner, np.arange(hi - lo + 1))
            out.append(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)),
                                                pa.array(slot.astype(np.int32))))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))

    return _feature_slots


def _descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = 1.0,
             epochs: int = 20, seed: int = 1) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L2-regularised hinge loss; the bias is a constant feature."""
    values = [ratio[r] / np.sqrt(max(len(r), 1)) for r in rows]
    square = np.array([v @ v + 1.0 for v in values])
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            r, v = rows[i], values[i]
            slope = y[i] * (w[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * v
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w * ratio, bias


@dataclass
class QualityModel:
    weights: np.ndarray  # per slot: log-count ratio times the fitted weight
    bias: float
    slope: float
    intercept: float

    @classmethod
    def fit(cls, rows: list[np.ndarray], label: np.ndarray, bits: int = BITS) -> QualityModel:
        size = 1 << bits
        if len(set(label.tolist())) < 2:
            slope, intercept = fit_sigmoid(np.zeros(len(label)), label)
            return cls(np.zeros(size), 0.0, slope, intercept)

        def train(pick: np.ndarray):
            count = np.ones((2, size))
            for i in pick:
                count[label[i], rows[i]] += 1
            count /= count.sum(axis=1, keepdims=True)
            ratio = np.log(count[1] / count[0])
            return _descend([rows[i] for i in pick], np.where(label[pick] == 1, 1.0, -1.0), ratio)

        margin = np.zeros(len(label))
        half = np.zeros(len(label), int)  # alternating within each class, so both halves have both
        for value in (0, 1):
            half[label == value] = np.arange((label == value).sum()) % 2
        for side in (0, 1):
            fit_on, rest = np.flatnonzero(half == side), np.flatnonzero(half != side)
            if len(set(label[fit_on].tolist())) == 2:
                w, b = train(fit_on)
                margin[rest] = [w[rows[i]].sum() / np.sqrt(max(len(rows[i]), 1)) + b for i in rest]
        slope, intercept = fit_sigmoid(margin, label)
        w, b = train(np.arange(len(label)))
        return cls(w, b, max(slope, 1e-6), intercept)


def train(docs: DataFrame, labels: DataFrame, label: str, keep: Column,
          per_class: int = PER_CLASS) -> QualityModel:
    """The model of ``label``, fitted on labelled rows that ``keep`` (a column of labels) allows."""
    sample = labelled_sample(docs, labels, label, keep, per_class)
    # Bounded: at most 2 * per_class rows of feature numbers.
    table = sample.select("label", _feature_slots_udf()("text").alias("slots")).toArrow()
    rows = [np.array(r.as_py() or [], np.int64) for c in table["slots"].chunks for r in c]
    y = np.array(table["label"].to_pylist(), int)
    order = sorted(range(len(rows)), key=lambda i: (y[i], rows[i].tolist()))  # in any layout
    return QualityModel.fit([rows[i] for i in order], y[order] if len(order) else y)


def score_udf(model: QualityModel, spark):
    """Column function text → probability of label 1."""
    shared = spark.sparkContext.broadcast(model)  # 2**BITS numbers

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        m, out = shared.value, np.zeros(len(texts))
        for lo, hi, buf, offsets in _blocks(texts):
            owner, slot = features(buf, offsets)
            n = np.bincount(owner, minlength=hi - lo)
            total = np.bincount(owner, m.weights[slot], minlength=hi - lo)
            out[lo:hi] = total / np.sqrt(np.maximum(n, 1)) + m.bias
        return pa.array(sigmoid(m.slope * out + m.intercept))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, label: str, keep: Column,
                    id_col: str = "doc_id", text_col: str = "text",
                    per_class: int = PER_CLASS) -> DataFrame:
    """(id, score) of every document."""
    model = train(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                  labels, label, keep, per_class)
    return docs.select(F.col(id_col), score_udf(model, docs.sparkSession)(F.col(text_col)).alias("score"))
