"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted.  Pieces (documents; what is longer than the
largest length is cut into full pieces and a rest) are placed by best-fit
decreasing: longest first, into the open bin with the least room that holds
the piece; if none does, the bin size with the least cost per token it can
still use is opened.  At the end each bin is downsized to the smallest
permitted length that holds its contents.

Which bins exist depends only on how many pieces have each length, and there
are at most ``largest length`` distinct lengths: Spark makes the exact histogram,
the driver packs counts instead of pieces (equal lengths that fare alike are
placed together), and the placements - intervals of ranks within a length -
go back to the executors, where every piece looks up its bin by its rank.
Ranks are counted in salted groups, as many for a length as its pieces call
for, so a length that a third of all documents share is no bottleneck at any size.  The histogram and the placements are bounded by
the number of distinct lengths, not by the documents.

Defined results: lengths are at least 1, and UTF-8 bytes plus ``overhead`` (an end mark) unless
another length column is given; null and empty texts are pieces of length
``overhead``; repeated rows are packed each; null ids pass; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shopmart.llm.common import cut

CAPACITIES = (1024, 2048, 4096, 8192)
SEQUENCE_COST = 64   # cost of a sequence besides its positions, in positions
SALTS = 64
GROUP_ROWS = 1 << 20  # pieces of one length that one task numbers, about


def bin_cost(capacity: int) -> int:
    """What a sequence costs: its positions and a fixed share."""
    return capacity + SEQUENCE_COST


@dataclass
class Placement:
    """``bins`` bins from ``first`` on take ``each`` pieces of a length, its ranks from ``rank`` on."""

    length: int
    rank: int
    first: int
    bins: int
    each: int


class BestFit:
    """Best-fit decreasing over counts; groups of equal open bins are id ranges."""

    def __init__(self, capacities: tuple[int, ...], cost=bin_cost):
        self.capacities = sorted(capacities)
        self.cost = cost
        self.rooms: list[int] = []                          # distinct rooms of open bins, sorted
        self.groups: dict[int, list[tuple[int, int, int]]] = {}  # room -> (first, bins, capacity)
        self.placements: list[Placement] = []
        self.opened = 0

    def _open_group(self, room: int, group: tuple[int, int, int]) -> None:
        if room not in self.groups:
            insort(self.rooms, room)
            self.groups[room] = []
        self.groups[room].append(group)

    def _take_group(self, room: int) -> tuple[int, int, int]:
        group = self.groups[room].pop()
        if not self.groups[room]:
            del self.groups[room]
            self.rooms.pop(bisect_left(self.rooms, room))
        return group

    def _capacity_for(self, length: int, left: int, later: int) -> int:
        """The size that costs least per token it will hold.

        ``left`` pieces of this length and ``later`` tokens of shorter ones are
        still to come, so a bin can count on being filled as far as they reach.
        """
        def per_token(size: int) -> float:
            return self.cost(size) / min(size, length * min(left, size // length) + later)

        return min((s for s in self.capacities if s >= length), key=lambda s: (per_token(s), s))

    def place(self, length: int, count: int, later: int) -> None:
        """All ``count`` pieces of a length no longer than those before."""
        rank = 0
        while rank < count:
            at = bisect_left(self.rooms, length)
            left = count - rank
            if at < len(self.rooms):
                room = self.rooms[at]
                first, bins, size = self._take_group(room)
            else:
                size = self._capacity_for(length, left, later)
                room, first = size, self.opened
                bins = -(-left // (size // length))
                if left % (size // length) and bins > 1:
                    bins -= 1  # the last, emptier bin is chosen by its own cost
                self.opened += bins
            each = room // length
            full = min(bins, left // each)
            if full:
                self.placements.append(Placement(length, rank, first, full, each))
                self._open_group(room - each * length, (first, full, size))
                rank += full * each
            if full < bins:
                rest = count - rank
                if 0 < rest < each:
                    self.placements.append(Placement(length, rank, first + full, 1, rest))
                    self._open_group(room - rest * length, (first + full, 1, size))
                    rank, full = count, full + 1
                if full < bins:
                    self._open_group(room, (first + full, bins - full, size))

    def downsized(self) -> list[tuple[int, int, int, int]]:
        """(first, bins, used, final capacity) of all groups of bins."""
        out = []
        for room, groups in self.groups.items():
            for first, bins, size in groups:
                used = size - room
                out.append((first, bins, used, next(c for c in self.capacities if c >= used)))
        return sorted(out)


def pack_counts(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES,
                cost=bin_cost) -> BestFit:
    """Pack ``{length: pieces}``; every length is between 1 and the largest capacity."""
    fit = BestFit(capacities, cost)
    later = sum(n * c for n, c in histogram.items())
    for length in sorted(histogram, reverse=True):
        later -= length * histogram[length]
        fit.place(length, histogram[length], later)
    return fit


def pieces_of(docs: DataFrame, largest: int, length: Column, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, piece, length): documents cut into pieces of at most ``largest``."""
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.greatest(length.cast("long"), F.lit(1)).alias("n"))
    count = F.greatest(F.lit(1), F.ceil(F.col("n") / largest))
    piece = F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("piece")
    return rows.select("doc_id", "n", piece).select(
        "doc_id", "piece",
        F.least(F.lit(largest).cast("long"), F.col("n") - F.col("piece") * largest).alias("length"))


def _lookup_udf(fit: BestFit, spark):
    """(length, rank) → bin, place in it and its capacity, from the broadcast placements."""
    p = sorted((q.length, q.rank, q.first, q.each) for q in fit.placements)
    groups = np.array(fit.downsized(), np.int64).reshape(-1, 4)
    shared = spark.sparkContext.broadcast((np.array(p, np.int64).reshape(-1, 4), groups))

    @arrow_udf("struct<bin:bigint,capacity:bigint,used:bigint>")
    def lookup(length: pa.Array, rank: pa.Array) -> pa.Array:
        places, bins = shared.value
        n, r = length.to_numpy(), rank.to_numpy()
        width = np.int64(1) << np.int64(40)
        at = np.searchsorted(places[:, 0] * width + places[:, 1], n * width + r, "right") - 1
        found = places[at, 2] + (r - places[at, 1]) // places[at, 3]
        group = np.searchsorted(bins[:, 0], found, "right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(found), pa.array(bins[group, 3]), pa.array(bins[group, 2])],
            names=["bin", "capacity", "used"])

    return lookup


def pack_documents(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, cost=bin_cost,
                   length: Column | None = None, overhead: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", salts: int = SALTS,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: id, piece, length, bin, start (its place in the bin), and the bin's
    capacity and used positions.

    A length's pieces are numbered in ``salts`` groups, or in more of about ``group_rows``."""
    spark = docs.sparkSession
    if length is None:
        length = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + overhead
    pieces = pieces_of(docs, max(capacities), length, id_col)
    # Row numbers are given once, before the checkpoint, so ranks are the same in every attempt.
    pieces = cut(pieces.withColumn("row", F.monotonically_increasing_id()))
    histogram = {r["length"]: r["n"] for r in  # at most max(capacities) rows
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    groups = [(length, -(-n // group_rows)) for length, n in histogram.items() if n > salts * group_rows]
    parts = F.lit(salts)
    if groups:  # at most max(capacities) rows
        pieces = pieces.join(F.broadcast(spark.createDataFrame(groups, "length long, parts long")),
                             "length", "left")
        parts = F.coalesce("parts", parts)
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("row"), parts))
    counts = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    fit = pack_counts(histogram, capacities, cost)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("row")
    ranked = (pieces.withColumn("number", F.row_number().over(inside))
              .join(offsets, ["length", "salt"])
              .withColumn("rank", F.col("before") + F.col("number") - 1))
    found = _lookup_udf(fit, spark)("length", "rank")
    placed = (ranked.select("doc_id", "piece", "length", "rank", found.alias("at"))
              .select("doc_id", "piece", "length", "rank", "at.*"))
    # A bin has at most max(capacities) pieces.
    order = (Window.partitionBy("bin").orderBy(F.desc("length"), "rank")
             .rowsBetween(Window.unboundedPreceding, -1))
    return (placed.withColumn("start", F.coalesce(F.sum("length").over(order), F.lit(0)))
            .select("doc_id", "piece", "length", "bin", "start", "capacity", "used")
            .withColumnRenamed("doc_id", id_col))
