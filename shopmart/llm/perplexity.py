"""Quality rules and n-gram perplexity: documents outside their language's usual range go.

The language model is an interpolated modified Kneser-Ney model of order 4 over the bytes of the UTF-8
texts, each of the 256 a symbol of its own.  The number of distinct 4-grams grows with the corpus, so Spark
counts them over all whole texts and estimates the model in tables, joined by n-gram and by context; contexts of
lower order count distinct left neighbours.  A model knows the 4-grams it was estimated from too well, so the
texts are halved by their hash and each half is judged by the model of the other.  The ``HELD`` most frequent
4-grams and their log probabilities, sorted by code, are broadcast and looked up for the distinct 4-grams of a
block of text; occurrences of the others, if there are any, are joined with their probabilities as rows.

A document's figure is its mean log probability per 4-gram.  For each language and length (power of
two) exact quartiles come from a histogram over all documents; a document is rejected when it lies more
than ``width`` quartile ranges below the lower or above the upper quartile (the range counts as at
least ``least`` nats).

Defined results: a null text is empty; texts of under four bytes have no perplexity and are not
rejected for it; a null language is a language of its own; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shopmart.llm import runs
from shopmart.llm.bytehash import blocks, text_bytes
from shopmart.llm.common import cut

ORDER = 4
BIN = 500  # histogram bins a nat
SYMBOLS = 256
CLASS = np.arange(SYMBOLS, dtype=np.uint8)  # symbol of each byte: itself
HELD = 1 << 21    # 4-grams of a broadcast, 8 bytes each
COUNTED = 1 << 22  # 4-grams that a counting task holds before it passes them on


def ngram_codes(buf: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start positions, codes) of all 4-grams within a text, a bounded piece of the buffer at a time."""
    for lo in range(0, len(buf), runs.BLOCK):
        hi = min(len(buf), lo + runs.BLOCK)
        symbols = CLASS[buf[lo: hi + ORDER - 1]]
        n = min(hi, len(buf) - ORDER + 1) - lo
        if n <= 0:
            return
        codes = symbols[:n].astype(np.uint32)
        for i in range(1, ORDER):
            codes *= SYMBOLS
            codes += symbols[i: i + n]
        whole = np.ones(n, bool)
        for i in range(1, ORDER):  # within 3 bytes of a text's end (its own or, if short, the next's)
            late = offsets[1:] - i - lo
            whole[late[(late >= 0) & (late < n)]] = False
        starts = np.flatnonzero(whole)
        yield starts + lo, codes[starts]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their counts in all parts."""
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def count_ngrams(docs: DataFrame, half: Column | None = None) -> DataFrame:
    """(half, code, n): how often each 4-gram occurs in the texts of a half (0 or 1), summed within a task first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            codes, counts = parts[0]
            for lo in range(0, len(codes), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[lo: lo + (1 << 16)]), pa.array(counts[lo: lo + (1 << 16)])], ["key", "n"])

        for batch in batches:
            buf, offsets = text_bytes(batch.column(0))
            halves = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, codes in ngram_codes(buf, offsets):
                keys = codes.astype(np.int64) * 2 + halves[np.searchsorted(offsets, at, "right") - 1]
                parts.append(np.unique(keys, return_counts=True))
                held += len(parts[-1][0])
                if held > COUNTED:
                    parts = [_merged(parts)]
                    held = len(parts[0][0])
                    if 2 * held > COUNTED:
                        yield from passed_on()
                        parts, held = [], 0
        if parts:
            parts = [_merged(parts)]
            yield from passed_on()

    half = F.lit(0) if half is None else half
    return (docs.select("text", half.cast("int").alias("half")).mapInArrow(counted, "key bigint, n bigint")
            .groupBy("key").agg(F.sum("n").alias("n"))
            .select((F.col("key") % 2).alias("half"), F.shiftright("key", 1).alias("code"), "n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What a count of 1, 2 and 3 or more gives away, from how many counts are 1, 2, 3 and 4.

    Where one of these is zero the estimate is undefined, and 0.5, 1 and 1.5 are used.
    """
    if not (n1 and n2 and n3 and n4):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return [min(max(d, 0.0), float(most)) for most, d in enumerate(found, 1)]


def _last(order: int, code: str = "code") -> Column:
    """The last ``order`` symbols of a code."""
    return F.col(code) % F.lit(SYMBOLS ** order)


def _context(order: int, code: str = "code") -> Column:
    """All but the last of the last ``order`` symbols of a code."""
    return F.shiftright(_last(order, code), 8)


@dataclass
class KneserNey:
    """By order: n-grams (code, n, prob) and contexts (context, weight, the share that backs off)."""

    grams: dict[int, DataFrame]
    contexts: dict[int, DataFrame]

    def scores(self, codes: DataFrame) -> DataFrame:
        """``codes`` and log_prob, log p(last symbol | the three before), backing off where it is unknown."""
        out, prob = codes, F.lit(1 / SYMBOLS)
        for order in range(1, ORDER + 1):
            grams = self.grams[order].select(F.col("code").alias("_code"), F.col("prob").alias(f"_p{order}"))
            contexts = self.contexts[order].select(F.col("context").alias("_context"),
                                                   F.col("weight").alias(f"_w{order}"))
            out = (out.join(grams, _last(order) == F.col("_code"), "left").drop("_code")
                   .join(contexts, _context(order) == F.col("_context"), "left").drop("_context"))
            prob = F.coalesce(f"_p{order}", F.coalesce(f"_w{order}", F.lit(1.0)) * prob)
        return out.select(*codes.columns, F.log(prob).cast("float").alias("log_prob"))

    def score(self, codes: np.ndarray) -> np.ndarray:
        """Log probabilities of some 4-grams."""
        asked = self.grams[ORDER].sparkSession.createDataFrame(
            pa.table({"at": np.arange(len(codes)), "code": codes.astype(np.int64)}))
        return self.scores(asked).orderBy("at").toArrow()["log_prob"].to_numpy()


def train(docs: DataFrame) -> KneserNey:
    """The model of all texts."""
    return estimate(cut(count_ngrams(docs)))


def estimate(counts: DataFrame) -> KneserNey:
    """The model from the counts of all 4-grams; 16 counts of counts reach the driver.

    Tables of lower order are small beside the counts and used several times, so they are written.
    """
    levels = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = cut(levels[order + 1].groupBy(_last(order).alias("code")).agg(F.count("*").alias("n")))
    n = F.col("n")
    often = None
    for order, level in levels.items():
        row = level.agg(*(F.count_if(n == k).alias(f"n{k}") for k in (1, 2, 3, 4))).withColumn("order", F.lit(order))
        often = row if often is None else often.unionByName(row)
    off = {r.order: discounts(r.n1, r.n2, r.n3, r.n4) for r in often.collect()}
    grams, contexts = {}, {}
    for order in range(1, ORDER + 1):
        once, twice, more = (F.lit(d) for d in off[order])
        here = levels[order].select("code", "n", _context(order).alias("context"))
        totals = here.groupBy("context").agg(
            F.sum("n").alias("total"), (F.count_if(n == 1) * once + F.count_if(n == 2) * twice
                                        + F.count_if(n > 2) * more).alias("given"))
        weight = F.greatest(F.col("given") / F.col("total"), F.lit(1e-12))
        contexts[order] = totals.select("context", weight.alias("weight"))
        joined, lower = here.join(totals, "context"), F.lit(1 / SYMBOLS)
        if order > 1:
            below = grams[order - 1].select(F.col("code").alias("_below"), F.col("prob").alias("lower"))
            joined, lower = joined.join(below, _last(order - 1) == F.col("_below")), F.col("lower")
        gave = F.when(n == 1, once).when(n == 2, twice).otherwise(more)
        prob = (n - gave) / F.col("total") + F.col("given") / F.col("total") * lower
        grams[order] = joined.select("code", "n", prob.alias("prob"))
        if order < ORDER:
            grams[order] = cut(grams[order])
    return KneserNey(grams, contexts)


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_grams")
_MEASURED = pa.struct([(m, pa.int64()) for m in _MEASURES]
                      + [("log_prob", pa.float64()), ("others", pa.list_(pa.int64()))])
_SYMBOL = runs.byte_class(b"#*$%&|<>")
_LEAD = np.arange(256) & 0xC0 != 0x80


def _repeated(ids: np.ndarray, text: np.ndarray, window: int) -> np.ndarray:
    """Words that lie in a window of words found twice or more in its text, the first included.

    Windows are told apart exactly: a window of k + 1 words is a number for its first k and a next word.
    """
    covered = np.zeros(len(ids) + 1, np.int64)
    if len(ids) >= window:
        distinct = int(ids.max()) + 1
        at = np.flatnonzero(text[: len(ids) - window + 1] == text[window - 1:])
        number = text[at].astype(np.int64)
        for i in range(window):
            _, number, often = np.unique(number * distinct + ids[at + i], return_inverse=True,
                                         return_counts=True)
            again = often[number] > 1
            at, number = at[again], number[again]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + window, -1)
    return np.cumsum(covered)[:-1] > 0


def _line_repeats(buf: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    breaks = buf == 10
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(breaks) + 1]))
    starts = starts[starts < len(buf)]
    out = np.zeros(len(offsets) - 1, np.int64)
    if not len(starts):
        return out
    ends = np.append(starts[1:], len(buf))
    sizes = ends - starts - breaks[ends - 1]
    ids, _ = runs.numbered(buf, ~breaks, sizes)
    filled = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    text = np.searchsorted(offsets, starts[filled], "right") - 1
    pairs = np.unique(text * np.int64(len(starts)) + ids[filled])
    return np.bincount(text, minlength=len(out)) - np.bincount(pairs // len(starts), minlength=len(out))


def base_measures(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The rule columns of each text of a block."""
    mask = ~runs.BLANK[buf]
    starts, ends = runs.runs(mask, offsets)
    ids, _ = runs.numbered(buf, mask, ends - starts)
    text = np.searchsorted(offsets, starts, "right") - 1
    n = len(offsets) - 1
    repeated = _repeated(ids, text, 5)
    return {"n_words": np.bincount(text, minlength=n),
            "word_chars": runs.per_text(mask & _LEAD[buf], offsets),
            "n_symbols": runs.per_text(_SYMBOL[buf], offsets),
            "n_dup_lines": _line_repeats(buf, offsets, starts),
            "n_repeat_words": np.bincount(text[repeated], minlength=n)}


class _Scorer:
    """Sums of log probabilities; each distinct 4-gram of a block is searched once."""

    def __init__(self, codes: np.ndarray, log_prob: np.ndarray):
        self.codes, self.log_prob = codes, log_prob

    def sums(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text 4-grams and the sum of those held; (text, code) of each that is not held."""
        n = len(offsets) - 1
        count, total, others = np.zeros(n, np.int64), np.zeros(n), [np.zeros((2, 0), np.int64)]
        for at, codes in ngram_codes(buf, offsets):
            text = np.searchsorted(offsets, at, "right") - 1
            count += np.bincount(text, minlength=n)
            distinct, number = np.unique(codes, return_inverse=True)
            if len(self.codes):
                place = np.minimum(np.searchsorted(self.codes, distinct), len(self.codes) - 1)
                held = self.codes[place] == distinct
                scores = np.where(held, self.log_prob[place], 0)
            else:
                held, scores = np.zeros(len(distinct), bool), np.zeros(len(distinct))
            total += np.bincount(text, scores[number], minlength=n)
            if not held.all():
                left = ~held[number]
                others.append(np.stack([text[left], codes[left].astype(np.int64)]))
        return count, total, np.concatenate(others, axis=1)


def measures_udf(codes: np.ndarray, log_prob: np.ndarray):
    """Column function text → rule columns, number of 4-grams, the sum of the log probabilities held, and the others."""
    scorer = _Scorer(codes, log_prob)

    @arrow_udf(f"struct<{','.join(f'{m}:bigint' for m in _MEASURES)},log_prob:double,others:array<bigint>>")
    def measured(texts: pa.Array) -> pa.Array:
        buf, offsets = text_bytes(texts)
        parts, others = [], [np.zeros((2, 0), np.int64)]
        for lo, hi in blocks(np.diff(offsets), runs.BLOCK):
            piece, cuts = buf[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
            found = base_measures(piece, cuts)
            found["n_grams"], found["log_prob"], left = scorer.sums(piece, cuts)
            parts.append(found)
            others.append(left + np.array([[lo], [0]]))
        columns = [np.concatenate([p[m] for p in parts]) if parts else np.zeros(0)
                   for m in (*_MEASURES, "log_prob")]
        text, left = np.concatenate(others, axis=1)  # ascending by text
        ends = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
        return pa.StructArray.from_arrays(
            [*(pa.array(c, f.type) for c, f in zip(columns, _MEASURED)),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(left))], fields=list(_MEASURED))

    return measured


def measure_documents(docs: DataFrame, model: KneserNey, counts: DataFrame | None = None) -> DataFrame:
    """All columns of ``docs`` and ``measures``; ``counts`` are the 4-grams of ``docs`` where they are known.

    The most frequent 4-grams are broadcast.  Where there are others, the documents and their
    occurrences of the others are written once, joined with the other probabilities and summed.
    """
    scores = cut(model.scores(count_ngrams(docs) if counts is None else counts).select("code", "n", "log_prob"))
    some = scores if scores.count() <= HELD else scores.orderBy(F.col("n").desc(), "code").limit(HELD)
    held = some.select("code", "log_prob").toArrow().sort_by("code")
    codes = held["code"].to_numpy().astype(np.uint32)
    measured = docs.withColumn("measures", measures_udf(codes, held["log_prob"].to_numpy())(F.col("text")))
    whole = F.struct(*(F.col(f"measures.{m}").alias(m) for m in _MEASURES), F.col("measures.log_prob").alias("log_prob"))
    if some is scores:
        return measured.withColumn("measures", whole)
    measured = cut(measured.withColumn("_row", F.monotonically_increasing_id()))
    rest = (measured.select("_row", F.explode("measures.others").alias("code")).groupBy("_row", "code")
            .agg(F.count("*").alias("times")).join(scores.select("code", F.col("log_prob").alias("each")), "code")
            .groupBy("_row").agg(F.sum(F.col("times") * F.col("each")).alias("_rest")))
    total = F.col("measures.log_prob") + F.coalesce("_rest", F.lit(0.0))
    return (measured.join(rest, "_row", "left").withColumn("measures", whole.withField("log_prob", total))
            .select(*docs.columns, "measures"))


def _position(measures: str = "measures"):
    """(length class, mean log perplexity) of a measured document; null without 4-grams."""
    n = F.col(f"{measures}.n_grams")
    some = n > 0
    return (F.when(some, F.floor(F.log2(n)).cast("int")),
            F.when(some, -F.col(f"{measures}.log_prob") / n))


def bands(measured: DataFrame, width: float, least: float) -> DataFrame:
    """lang, size, low, high: the accepted range of mean log perplexity.

    Quartiles are exact to a bin of 1/500 nat.  A language and length has at most some thousand
    bins, which is what a task of the window holds.
    """
    size, value = _position()
    bins = (measured.select("lang", size.alias("size"), F.floor(value * BIN).alias("bin"))
            .where(F.col("bin").isNotNull()).groupBy("lang", "size", "bin").agg(F.count("*").alias("n")))
    group = Window.partitionBy("lang", "size")
    upto = F.sum("n").over(group.orderBy("bin"))
    all_ = F.sum("n").over(group)
    ranked = bins.select("lang", "size", "bin", (upto / all_).alias("share"))
    quarter = lambda q: F.min(F.when(F.col("share") >= q, F.col("bin"))) / BIN
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
    return (ranked.groupBy("lang", "size").agg(quarter(0.25).alias("q1"), quarter(0.75).alias("q3"))
            .select("lang", "size", (F.col("q1") - width * spread).alias("low"),
                    (F.col("q3") + width * spread + 1 / BIN).alias("high")))


def judge(docs: DataFrame, width: float = 3.0, least: float = 0.02, id_column: str = "doc_id") -> DataFrame:
    """id, lang, measures, log_perplexity, base_failed and kept, one row for each row of ``docs``.

    ``base_failed``: under 10 words, or over a fifth of the words in repeated windows.  ``kept``: neither
    that nor outside the band of its language and length.
    """
    rows = docs.select(id_column, "lang", "text").withColumn("_half", F.pmod(F.xxhash64("text"), F.lit(2)))
    counts = cut(count_ngrams(rows, F.col("_half")))
    halves = [counts.where(F.col("half") == half) for half in (0, 1)]
    parts = [measure_documents(rows.where(F.col("_half") == half), estimate(halves[1 - half]), halves[half])
             for half in (0, 1)]
    measured = cut(parts[0].unionByName(parts[1]).drop("text", "_half"))
    size, value = _position()
    placed = measured.select("*", size.alias("size"), value.alias("log_perplexity"),
                             ((F.col("measures.n_words") < 10) | (100 * F.col("measures.n_repeat_words")
                              > 20 * F.col("measures.n_words"))).alias("base_failed"))
    found = bands(measured, width, least).withColumnsRenamed({"lang": "band_lang", "size": "band_size"})
    joined = placed.join(found, F.col("lang").eqNullSafe(F.col("band_lang"))
                         & (F.col("size") == F.col("band_size")), "left")
    outside = (F.col("log_perplexity") < F.col("low")) | (F.col("log_perplexity") > F.col("high"))
    return joined.select(id_column, "lang", "measures", "log_perplexity", "low", "high", "base_failed",
                         (~F.col("base_failed") & ~F.coalesce(outside, F.lit(False))).alias("kept"))
