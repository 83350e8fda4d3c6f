"""Benchmark decontamination with suffix arrays over the training shards.

A shard is a block of texts of a scan task.  Its words (runs of ASCII letters
and digits and non-ASCII characters, A-Z as a-z) become numbers, its suffixes
are sorted by their leading words, and every test suffix (each window of
``window`` benchmark words) is binary-searched in that array; the array is
sorted only as deep as the searches go, one word at a time.  Neighbouring
windows on one diagonal are joined to the longest verbatim matches, with their
places in document and item.  Documents do not move: there is no shuffle.

Words are compared by their bytes.  The benchmark is the fixed query set:
it is read in blocks of ``block_words`` words, and each block goes to the
executors as an index of bounded size.  Of several blocks each is applied, its result written
to the checkpoint folder and its index released before the next is made, so driver and
executors hold one block at a time; a benchmark of one block moves no document.

Defined results: null or wordless texts have no words and no hits; items
without words match nothing; an item of fewer than ``window`` words is one
window; repeated items count by their id (equal ids once); items with a null
id mark words but are not listed; repeated rows, null ids and extra columns
pass; empty tables give empty or clean results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shopmart.llm import bytehash, runs
from shopmart.llm.common import cut

IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
BLOCK_WORDS = 1 << 22
SHARD_BYTES = 1 << 21


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_ids(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(starts, a number per word, the distinct words by number) of a block of texts."""
    buf = LOWER[buf]
    mask = IS_WORD[buf]
    starts, ends = runs.runs(mask, offsets)
    return starts, *runs.numbered(buf, mask, ends - starts)


class TestSuffixes:
    """The windows of a block of items, by length, as sorted rows of word numbers."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        texts = pa.array([t for _, t in items], pa.string())
        buf, offsets = bytehash.text_bytes(texts)
        starts, numbers, self.vocabulary = word_ids(buf, offsets)
        numbers = numbers + 1
        self.ids = [i for i, _ in items]
        edges = np.searchsorted(starts, offsets)
        rows = defaultdict(list)  # window length -> (words, item, place)
        for item, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
            size = min(window, hi - lo)
            if size:
                rows[int(size)] += [(numbers[i: i + size], item, i - lo)
                                    for i in range(lo, hi - size + 1)]
        self.groups = []
        for size, found in sorted(rows.items()):
            table, which = np.unique(np.array([r[0] for r in found]), axis=0, return_inverse=True)
            order = np.argsort(which.ravel(), kind="stable")
            first = np.searchsorted(which.ravel()[order], np.arange(len(table) + 1))
            places = np.array([(r[1], r[2]) for r in found])[order]
            self.groups.append((size, self._levels(table), first, places))

    def _levels(self, table: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per depth: the sorted (class of the words before, word) keys of the test suffixes."""
        levels, parent = [], np.zeros(len(table), np.int64)
        for depth in range(table.shape[1]):
            keys, parent = np.unique(parent * self.base + table[:, depth], return_inverse=True)
            levels.append(keys)
        return levels

    @property
    def base(self) -> int:
        return len(self.vocabulary) + 1

    def search(self, numbers: np.ndarray, text: np.ndarray):
        """(window length, positions, window numbers) of all occurrences in a shard."""
        for size, levels, first, places in self.groups:
            at = np.flatnonzero(numbers)
            at = at[at + size <= len(numbers)]
            at = at[text[at] == text[at + size - 1]]
            prefix = np.zeros(len(at), np.int64)  # class of the words matched so far
            depth = 0
            while depth < size and len(at):
                keys = prefix * self.base + numbers[at + depth]
                tests = levels[depth]
                if depth == 0 and size > 1:  # the first two words at once
                    above, word = np.divmod(levels[1], self.base)
                    tests = levels[0][above] * self.base + word
                    keys = keys * self.base + numbers[at + 1]
                    depth = 1
                order = np.argsort(keys, kind="stable")
                keys, at = keys[order], at[order]
                lo = np.searchsorted(keys, tests, "left")
                n = np.searchsorted(keys, tests, "right") - lo
                pick = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                at, prefix = at[pick], np.repeat(np.arange(len(tests)), n)
                depth += 1
            if len(at):
                yield size, at, prefix, first, places


def _matches(size, at, which, first, places, text):
    """Longest matches as rows (text, place, item, item place, words)."""
    n = first[which + 1] - first[which]
    pick = np.repeat(first[which] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    at = np.repeat(at, n)
    item, place = places[pick, 0], places[pick, 1]
    order = np.lexsort((at, at - place, item, text[at]))
    at, item, place = at[order], item[order], place[order]
    t, diagonal = text[at], at - place
    new = np.ones(len(at), bool)
    new[1:] = ((t[1:] != t[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1])
               | (at[1:] != at[:-1] + 1))
    head = np.flatnonzero(new)
    runs = np.diff(np.append(head, len(at)))
    return t[head], at[head], item[head], place[head], runs + size - 1


RESULT = ("struct<n_words:bigint,hits:array<struct<start:bigint,stop:bigint>>,"
          "items:array<bigint>,matches:array<struct<item_id:bigint,place:bigint,"
          "item_place:bigint,n_words:bigint>>>")
_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("hits", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ("items", pa.list_(pa.int64())),
    ("matches", pa.list_(pa.struct([(c, pa.int64()) for c in
                                    ("item_id", "place", "item_place", "n_words")])))])


def _shard(index: TestSuffixes, buf: np.ndarray, offsets: np.ndarray) -> list[dict]:
    starts, ids, words = word_ids(buf, offsets)
    text = np.searchsorted(offsets, starts, "right") - 1
    edges = np.searchsorted(starts, offsets)
    out = [{"n_words": int(b - a), "hits": [], "items": [], "matches": []}
           for a, b in zip(edges[:-1], edges[1:])]
    if not len(index.vocabulary) or not len(ids):
        return out
    known = pc.fill_null(pc.index_in(words, index.vocabulary), -1).to_numpy()
    number = known.astype(np.int64)[ids] + 1
    mark = np.zeros(len(number) + 1, np.int64)
    items = defaultdict(set)
    for size, at, which, first, places in index.search(number, text):
        np.add.at(mark, at, 1)
        np.add.at(mark, at + size, -1)
        for t, place, item, item_place, n in zip(
                *(c.tolist() for c in _matches(size, at, which, first, places, text))):
            out[t]["matches"].append({"item_id": index.ids[item], "place": place - int(edges[t]),
                                      "item_place": item_place, "n_words": n})
            if index.ids[item] is not None:
                items[t].add(index.ids[item])
    hit = np.concatenate(([False], np.cumsum(mark[:-1]) > 0, [False]))
    for t, found in items.items():
        out[t]["items"] = sorted(found)
    begin = np.flatnonzero(hit[1:] & ~hit[:-1])
    end = np.flatnonzero(hit[:-1] & ~hit[1:])
    for a, b in zip(begin.tolist(), end.tolist()):
        # windows end with their text, but hits of two texts may touch
        while a < b:
            t = int(text[a])
            stop = min(b, int(edges[t + 1]))
            out[t]["hits"].append({"start": a - int(edges[t]), "stop": stop - int(edges[t])})
            a = stop
    return out


def match_udf(index: Broadcast):
    """Column function text → RESULT for one block of the benchmark."""

    @arrow_udf(RESULT)
    def match(texts: pa.Array) -> pa.Array:
        buf, offsets = bytehash.text_bytes(texts)
        out: list[dict] = []
        for lo, hi in bytehash.blocks(np.diff(offsets), SHARD_BYTES):
            out += _shard(index.value, buf[offsets[lo]: offsets[hi]],
                          offsets[lo: hi + 1] - offsets[lo])
        return pa.array(out, _ARROW)

    return match


def _union_length_udf():
    @arrow_udf("bigint")
    def _union_length(hits: pa.Array) -> pa.Array:
        """Words covered by intervals that may overlap."""
        out = []
        for row in hits.to_pylist():
            reach = total = 0
            for r in sorted(row or [], key=lambda r: r["start"]):
                total += max(0, r["stop"] - max(reach, r["start"]))
                reach = max(reach, r["stop"])
            out.append(total)
        return pa.array(out, pa.int64())

    return _union_length


def benchmark_blocks(bench: DataFrame, window: int, block_words: int = BLOCK_WORDS,
                     id_col: str = "item_id", text_col: str = "text"
                     ) -> Iterator[tuple[Broadcast, bool]]:
    """(the index of about ``block_words`` words, is it the last), one block after the other."""
    sc = bench.sparkSession.sparkContext
    held, size = [], 0
    for row in bench.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        if size >= block_words:
            yield sc.broadcast(TestSuffixes(held, window)), False
            held, size = [], 0
        held.append((row["i"], row["t"]))
        size += len(row["t"] or "") // 4 + 1
    yield sc.broadcast(TestSuffixes(held, window)), True


def find_contamination(docs: DataFrame, bench: DataFrame, window: int = 10,
                       id_col: str = "doc_id", text_col: str = "text",
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: id, n_words, n_hit, items (ids with windows in it), matches."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    several = False
    for index, last in benchmark_blocks(bench, window, block_words):
        found = match_udf(index)(F.col("text")).alias("found")
        if not several:
            rows = rows.select("id", "text", found)
        else:
            both = rows.select("id", "text", F.col("found").alias("before"), found)
            rows = both.select("id", "text", F.struct(
                F.col("found.n_words").alias("n_words"),
                *(F.concat(f"before.{c}", f"found.{c}").alias(c) for c in ("hits", "items", "matches")))
                .alias("found"))
        if not last:
            several, rows = True, cut(rows)
            index.unpersist()
    hits, items = F.col("found.hits"), F.col("found.items")
    n_hit = _union_length_udf()(hits) if several else F.aggregate(
        hits, F.lit(0).cast("long"), lambda n, h: n + h["stop"] - h["start"])
    return rows.select(F.col("id").alias(id_col), F.col("found.n_words").alias("n_words"),
                       n_hit.alias("n_hit"), (F.array_sort(F.array_distinct(items)) if several else items)
                       .alias("items"), F.col("found.matches").alias("matches"))


def remove_contaminated(docs: DataFrame, bench: DataFrame, window: int = 10,
                        text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window, all columns."""
    for index, last in benchmark_blocks(bench, window, block_words):
        docs = docs.where(F.size(match_udf(index)(F.col(text_col))["hits"]) == 0)
        if not last:
            docs = cut(docs)
            index.unpersist()
    return docs


def items_digest(items: Column) -> Column:
    """sha256 of the ids, sorted as strings, comma-joined."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda i: i.cast("string"))), ","), 256)
