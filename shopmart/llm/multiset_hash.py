"""Order-independent document fingerprints: a homomorphic multiset hash of paragraphs.

Each paragraph is hashed (BLAKE2b) to a wide vector: eight words uniform over 64 bits, and ``lanes``
signs (±1).  A document's fingerprint is the sum of its paragraphs' vectors, the words modulo 2**64
and the signs modulo 2**32.  Sums commute, so paragraph order does not matter, and a paragraph is
inserted or deleted by adding or subtracting its vector; no text is needed.

The eight words tell equality: texts with equal paragraphs, repeats counted, have equal ones; for
others all eight agree with a chance of about (g / 2**64)**8, where g is the power of two that divides
all differences of their counts (2**16 for 65,536 copies against none).  The signs are a random
projection of the document's paragraph counts: the mean product of two fingerprints' signs estimates
how many paragraphs they share, and ``likeness`` is the cosine of that estimate, clipped to 0..1
(standard error about 1/sqrt(lanes)), and 1 for equal words only.  Sign sums stay readable up to
2**31 - 1 equal paragraphs.

Paragraphs are the pieces between line ends and sentence ends, stripped of
white space, empty ones left out: long texts without line ends would
otherwise be one paragraph.

Defined results: null text is empty; an empty document has the all-zero
fingerprint; two such have likeness 1, one such and another document 0.
Neighbours are taken by ascending doc_id, null ids last, equal ids by a hash of the text, then the text;
after the last comes the first, which for a single row is itself.  Repeated
rows and extra columns are allowed; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

LANES = 128
WORDS = 8
_CUT = re.compile(r"[\n\r]+|(?<=[.!?])\s+")


def paragraphs(text: str | None) -> list[str]:
    return [p for p in (q.strip() for q in _CUT.split(text or "")) if p]


@lru_cache(maxsize=1 << 15)  # an edited text shares most paragraphs with its sources
def _digest(part: str) -> bytes:
    return hashlib.blake2b(part.encode(), digest_size=64).digest()


@dataclass(frozen=True)
class Fingerprint:
    """``words`` (uint64) for equality, ``signs`` (uint32) for likeness."""

    words: np.ndarray
    signs: np.ndarray

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.words + other.words, self.signs + other.signs)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.words - other.words, self.signs - other.signs)

    def __eq__(self, other) -> bool:
        return bool((self.words == other.words).all() and (self.signs == other.signs).all())

    def insert(self, part: str) -> Fingerprint:
        """The fingerprint with one more paragraph."""
        return self + of_paragraphs([part], len(self.signs))

    def delete(self, part: str) -> Fingerprint:
        """The fingerprint with one paragraph less."""
        return self - of_paragraphs([part], len(self.signs))

    def hex(self) -> str:
        return self.words.astype(">u8").tobytes().hex() + self.signs.astype(">u4").tobytes().hex()

    @staticmethod
    def of_hex(text: str) -> Fingerprint:
        raw = bytes.fromhex(text)
        return Fingerprint(np.frombuffer(raw[: 8 * WORDS], ">u8").astype(np.uint64),
                           np.frombuffer(raw[8 * WORDS:], ">u4").astype(np.uint32))


def of_paragraphs(parts: list[str], lanes: int = LANES) -> Fingerprint:
    """The sum of the paragraphs' vectors (``lanes``: a multiple of 8, at most 512)."""
    raw = np.frombuffer(b"".join(map(_digest, parts)), np.uint8).reshape(len(parts), 64)
    words = np.ascontiguousarray(raw).view(">u8").astype(np.uint64).sum(axis=0, dtype=np.uint64)
    ones = np.unpackbits(raw[:, : lanes // 8], axis=1).sum(axis=0, dtype=np.int64)
    return Fingerprint(words, (2 * ones - len(parts)).astype(np.uint32))


def fingerprint(text: str | None, lanes: int = LANES, block: int = 4096) -> Fingerprint:
    """The sum over all paragraphs, a block at a time."""
    parts = paragraphs(text)
    total = of_paragraphs([], lanes)
    for at in range(0, len(parts), block):
        total += of_paragraphs(parts[at: at + block], lanes)
    return total


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Estimated cosine of the paragraph counts; 1 for equal fingerprints and only for them."""
    if a == b:
        return 1.0
    x, y = a.signs.view(np.int32).astype(float), b.signs.view(np.int32).astype(float)
    size = np.sqrt((x * x).sum() * (y * y).sum())
    return float(np.clip((x * y).sum() / size, 0.0, np.nextafter(1.0, 0.0))) if size else 0.0


class _Ranges:
    """Numbers of the ranges of (no_id, doc_id, text hash), ascending with them.

    Ranges end at quantiles of the ids.  An id that several quantiles fall on, and the rows
    without id, get as many ranges over the hash.
    """

    def __init__(self, quantiles: list[int], null_ranges: int):
        self.edges, often = np.unique(np.array(quantiles, np.int64), return_counts=True)
        self.parts = np.append(np.where(often > 1, often, 0), 0)  # of the edge's own id; the last has no edge
        self.start = np.concatenate([[0], np.cumsum(self.parts + 1)])
        self.null_ranges = max(1, null_ranges)

    def number(self, no_id: np.ndarray, doc_id: np.ndarray, key: np.ndarray) -> np.ndarray:
        share = key / 2.0 ** 64 + 0.5
        slot = np.searchsorted(self.edges, doc_id, "left")
        own = np.append(self.edges, 0)[slot] == doc_id
        parts = np.where(own, self.parts[slot], 0)
        found = self.start[slot] + np.where(parts > 0, 1 + np.minimum(share * parts, parts - 1).astype(int), 0)
        nulls = self.start[-1] + np.minimum(share * self.null_ranges, self.null_ranges - 1).astype(int)
        return np.where(no_id, nulls, found).astype(np.int32)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              buckets: int | None = None) -> DataFrame:
    """(bucket, no_id, doc_id, text_key, text, guest): rows dealt to ranges for a walk in order.

    Ranges are cut at ``buckets`` approximate quantiles of the ids; an id that holds more than one
    range's share, and the rows without id, are cut by the hash of the text.  The least row of a range goes to
    the range before it as a guest (the very first to the last), so each range has the successor
    of its last row and text moves once.  Driver data: a few numbers per range.
    """
    spark = docs.sparkSession
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).isNull().alias("no_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc_id"),
                       F.xxhash64(text).alias("text_key"), text.alias("text"))
    found = rows.agg(F.percentile_approx(F.when(~F.col("no_id"), F.col("doc_id")),
                                         [i / n for i in range(1, n + 1)], 10 * n).alias("q"),
                     F.count("*").alias("all"), F.count_if("no_id").alias("nulls")).first()
    ranges = _Ranges(found["q"] or [], -(-n * found["nulls"] // max(1, found["all"])))

    @arrow_udf("int")
    def range_of(no_id: pa.Array, doc_id: pa.Array, key: pa.Array) -> pa.Array:
        return pa.array(ranges.number(no_id.to_numpy(zero_copy_only=False), doc_id.to_numpy(),
                                      key.to_numpy()))

    rows = rows.withColumn("bucket", range_of("no_id", "doc_id", "text_key"))
    firsts = (rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "text_key")).alias("least"))
              .orderBy("bucket").collect())
    own = rows.select("bucket", F.lit(False).alias("guest"), "no_id", "doc_id", "text_key", "text")
    if not firsts:
        return own
    hosts = spark.createDataFrame(
        [(r["bucket"], *r["least"], firsts[i - 1]["bucket"]) for i, r in enumerate(firsts)],
        "bucket int, doc_id long, text_key long, host int")
    # One row per range: as small as the list of ranges.
    guests = (rows.join(F.broadcast(hosts), ["bucket", "doc_id", "text_key"])
              .groupBy("host", "no_id", "doc_id", "text_key").agg(F.min("text").alias("text"))
              .select(F.col("host").alias("bucket"), F.lit(True).alias("guest"), "no_id", "doc_id",
                      "text_key", "text"))
    return own.unionByName(guests)


def _walk(lanes: int):
    def result(this, after) -> tuple:
        doc_id, text, total = this
        half = len(text) // 2
        edited = text[: len(text) - half] + after[1][:half]
        edited_total = fingerprint(edited, lanes)
        return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), total.hex(),
                edited_total.hex(), likeness(total, edited_total), likeness(total, after[2]))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket = last = None
        for pdf in batches:
            out = []
            for place, guest, no_id, doc_id, text in zip(
                    *(pdf[c] for c in ("bucket", "guest", "no_id", "doc_id", "text"))):
                if place != bucket:
                    bucket, last = place, None
                row = (None if no_id else doc_id, text, fingerprint(text, lanes))
                if last is not None:
                    out.append(result(last, row))
                last = None if guest else row
            got = pd.DataFrame(out, columns=names)
            got["doc_id"] = got["doc_id"].astype("Int64")
            yield got

    return run


def compare_with_next(docs: DataFrame, lanes: int = LANES, id_col: str = "doc_id",
                      text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its text edited with the next document's."""
    dealt = with_next(docs, id_col, text_col, buckets)
    # Guests come after all of the range's own rows.
    ordered = dealt.repartition("bucket").sortWithinPartitions(
        "bucket", "guest", "no_id", "doc_id", "text_key", "text")
    return ordered.mapInPandas(
        _walk(lanes), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                      "edited_fingerprint string, near_edited double, near_next double")


def fingerprints(docs: DataFrame, lanes: int = LANES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"),
                                "fingerprint": [fingerprint(t, lanes).hex() for t in pdf["text"]]})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, fingerprint string").withColumnRenamed("doc_id", id_col)
