"""Repeated passages by a range-partitioned suffix array over the suffixes that can repeat.

A byte is removed when a string of ``span`` bytes that covers it also starts
anywhere else.  Sorting the suffixes at every byte would move ``span`` bytes
for each byte of input, so the array holds only suffixes whose leading token
occurs twice, in three steps:

1. Leading tokens.  Each start of a ``span``-byte string has an anchor: the
   position of the smallest hash among the ``token``-byte strings inside it.
   Equal strings have equal anchors, so neighbouring starts that share an
   anchor form a run, and a run whose anchor token occurs once in the corpus
   holds no repeated string.  Tokens are counted with map-side sums.
2. Whole runs.  Runs of one token whose complete bytes (first start to the
   end of the last string) occur twice are repeated in full; they are decided
   by count, and one of each stays as witness for the others.
3. Suffix order.  For the other runs and the witnesses, Spark's sampled
   splitters range-partition the runs by their leading token, so all
   suffixes that can be equal are in one bucket; there, the suffixes of all starts
   are sorted by their bytes with multikey quicksort, and strings that agree to
   their last byte are repeated.  Splitters lie between distinct tokens, so no equal
   suffixes lie on two sides of a boundary: comparing the last suffix of a bucket with the
   first of the next could find nothing, and is left out.
   A token with more than ``hot_token`` different runs does not go to one bucket:
   its suffixes are counted as rows, with map-side sums.

Equality is judged by bytes in the buckets, else by 64-bit hashes (suffixes of hot
tokens: by 128 bits, token and suffix).

Defined results: null and empty texts have no bytes; strings never cross
documents; copies of a text (repeated rows too) count as other occurrences;
each input row gives one result row, null ids included; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm import bytehash
from shopmart.llm.common import cut, splittable
from shopmart.llm.multikey import multikey_quicksort

TOKEN = 32
PLACE = np.uint64((1 << 22) - 1)  # a block has fewer bytes
SMALL_BATCH = 256     # rows handled at a time
RUN_NAMES = ["token", "witness", "key", "start", "n", "bytes"]
RUN_TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
RUN_BYTES = 1 << 19   # run bytes whose suffixes are sorted at a time


def _slide_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1: n])


def _block_runs(buf: np.ndarray, offsets: np.ndarray, span: int, token: int):
    """Runs of a block of texts: text number, first start in it, starts, token hash, run hash."""
    first, last = offsets[:-1], offsets[1:] - span  # allowed starts of each text
    if len(buf) < span or not (last >= first).any():
        return None
    pre = bytehash.prefix(buf)
    hashes = bytehash.fixed_hash(pre, token)
    # Hash above, place below: of equal hashes the leftmost is the anchor.
    least = _slide_min(hashes & ~PLACE | np.arange(len(hashes), dtype=np.uint64), span - token + 1)
    anchor = (least & PLACE).astype(np.int64)
    change = np.ones(len(least), bool)
    np.not_equal(anchor[1:], anchor[:-1], out=change[1:])
    heads = offsets[:-1]
    change[heads[heads < len(least)]] = True
    start = np.flatnonzero(change)
    end = np.append(start[1:], len(least))
    text = np.searchsorted(offsets, start, "right") - 1
    end = np.minimum(end, last[text] + 1)
    keep = start < end
    start, end, text = start[keep], end[keep], text[keep]
    return (text, start - offsets[text], end - start, hashes[anchor[start]],
            bytehash.span_hash(pre, start, end - 1 + span))


def _long_text_runs(buf: np.ndarray, span: int, token: int):
    """Runs of one text of any length, block by block.

    Blocks overlap by span - 1 bytes, so every start is in one block with its string.
    A run cut at a block border would get another run hash in a copy at another
    place, so blocks end where the anchor changes.
    """
    size, at = bytehash.BLOCK_BYTES, 0
    while at + span <= len(buf):
        piece = buf[at: at + size]
        got = _block_runs(piece, np.array([0, len(piece)]), span, token)
        _, start, count, tokens, runs = got
        if at + size < len(buf) and len(start) > 1:  # the last run may go on
            start, count, tokens, runs = start[:-1], count[:-1], tokens[:-1], runs[:-1]
        yield start + at, count, tokens, runs
        at += int(start[-1] + count[-1])


def _runs_map(span: int, token: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies: Counter[int] = Counter()
        small = (b.slice(at, SMALL_BATCH) for b in batches
                 for at in range(0, b.num_rows, SMALL_BATCH))
        for batch in small:
            # Two copies of a text in a task count as many: the rest add nothing.
            wanted = []
            for key in batch.column("key").to_pylist():
                copies[key] += 1
                wanted.append(copies[key] <= 2)
            batch = batch.filter(pa.array(wanted, pa.bool_()))
            buf, offsets = bytehash.text_bytes(batch.column("text"))
            keys = batch.column("key").to_numpy()
            for lo, hi in bytehash.blocks(np.diff(offsets)):
                part, base = buf[offsets[lo]: offsets[hi]], offsets[lo]
                if hi - lo == 1:
                    found = [(np.full(len(r[0]), lo), *r) for r in _long_text_runs(part, span, token)]
                else:
                    got = _block_runs(part, offsets[lo: hi + 1] - base, span, token)
                    found = [(got[0] + lo, *got[1:])] if got is not None else []
                for text, start, count, tokens, runs in found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tokens.view(np.int64)), pa.array(runs.view(np.int64)),
                         pa.array(keys[text]), pa.array(start.astype(np.int64)),
                         pa.array(count.astype(np.int32))],
                        names=["token", "run", "key", "start", "n"])

    return run


def _suffix_map(span: int):
    """Repeated starts (key, start, stop) among the runs of a bucket, sorted by token."""

    def resolve(rows: pd.DataFrame) -> pd.DataFrame:
        buf = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
        n = rows["n"].to_numpy(np.int64)
        begin = np.concatenate(([0], np.cumsum(n + span - 1)[:-1]))
        owner = np.repeat(np.arange(len(n)), n)
        at = np.repeat(begin - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        _, hit = multikey_quicksort(buf, at, span)
        return _intervals(rows, owner, at - begin[owner], hit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        small = (b.iloc[at: at + SMALL_BATCH] for b in batches
                 for at in range(0, len(b), SMALL_BATCH))
        for pdf in small:
            held.append(pdf)
            size += int(pdf["n"].sum()) + len(pdf) * (span - 1)
            if size < RUN_BYTES:
                continue
            rows = pd.concat(held, ignore_index=True)
            open_ = (rows["token"] == rows["token"].iloc[-1]).to_numpy()
            if not open_.all():
                yield resolve(rows[~open_].reset_index(drop=True))
            held, size = [rows[open_]], 0
        if held and sum(map(len, held)):
            yield resolve(pd.concat(held, ignore_index=True))

    return run


def _intervals(rows: pd.DataFrame, owner: np.ndarray, place: np.ndarray,
               hit: np.ndarray) -> pd.DataFrame:
    """Neighbouring hit starts of each run that is not a witness, as [start, stop)."""
    wanted = hit & ~rows["witness"].to_numpy()[owner]
    owner, place = owner[wanted], place[wanted]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)
    head = np.flatnonzero(new)
    stop = place[np.append(head[1:], len(owner)) - 1] + 1 if len(head) else place[head]
    start = rows["start"].to_numpy()[owner[head]]
    return pd.DataFrame({"key": rows["key"].to_numpy()[owner[head]],
                         "start": start + place[head], "stop": start + stop})


def _row_map(span: int):
    """One row per start of the runs of a hot token: its suffix hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                tail = bytehash.fixed_hash(bytehash.prefix(np.frombuffer(row.bytes, np.uint8)), span)
                yield pd.DataFrame({"token": row.token, "tail": tail.view(np.int64), "key": row.key,
                                    "start": row.start + np.arange(len(tail)),
                                    "witness": row.witness})

    return run


def _cut_runs(span: int):
    """The bytes of the listed runs, from the first copy of each text that a task meets.

    A text's copies may be split over tasks.  Its runs then come twice, which tells
    nothing wrong: what it holds is repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, SMALL_BATCH):
                out = []
                for row in zip(*(batch.column(c).slice(at, SMALL_BATCH) for c in
                                 ("key", "text", "token", "witness", "start", "n"))):
                    key, text, *runs = (v.as_py() for v in row)
                    if key in seen:
                        continue
                    seen.add(key)
                    data = text.encode()
                    out += [(token, witness, key, start, n, data[start: start + n + span - 1])
                            for token, witness, start, n in zip(*runs)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), RUN_TYPES)], names=RUN_NAMES)

    return run


def _kept(text: str, start, stop, span: int) -> tuple[int, int, int, bytes]:
    data = text.encode()
    if start is None or not len(start):
        return len(data), 0, 0, data
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, np.asarray(start, np.int64), 1)
    np.add.at(edge, np.asarray(stop, np.int64) + span - 1, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()


RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
          "kept binary")


def _apply_map(span: int, with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SMALL_BATCH):
                part = batch.slice(at, SMALL_BATCH)
                rows = []
                for text, start, stop in zip(*(part.column(c) for c in ("text", "start", "stop"))):
                    n, gone, spans, kept = _kept(text.as_py(), start.as_py(), stop.as_py(), span)
                    rows.append((n, gone, spans, hashlib.sha256(kept).hexdigest(),
                                 kept if with_bytes else None))
                n, gone, spans, digest, kept = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(spans, pa.int64()), pa.array(digest, pa.string()),
                     pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def _run_bytes(texts: DataFrame, runs: DataFrame, span: int) -> DataFrame:
    """The bytes of ``runs`` (token, witness, key, start, n), cut from their texts.

    All columns of ``texts`` are read, so the texts cross the exchange once for
    this join and for the final one.
    """
    by_text = runs.groupBy("key").agg(
        F.collect_list(F.struct("token", "witness", "start", "n")).alias("runs"))
    return texts.join(splittable(by_text), "key").select(
        *texts.columns, *(f"runs.{c}" for c in ("token", "witness", "start", "n"))).mapInArrow(
        _cut_runs(span), "token long, witness boolean, key long, start long, n int, bytes binary")


def remove_repeats(docs: DataFrame, span: int = 200, token: int = TOKEN, id_col: str = "doc_id",
                   text_col: str = "text", hot_token: int = 4096,
                   with_bytes: bool = True) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes."""
    token = min(token, span)
    text = F.coalesce(F.col(text_col), F.lit(""))
    # A text is known by its hash: equal texts have equal repeats.
    texts = docs.select(F.xxhash64(text).alias("key"), F.col(id_col).cast("long").alias("doc_id"),
                        text.alias("text"))
    runs = texts.select("key", "text").where(F.octet_length("text") >= span).mapInArrow(
        _runs_map(span, token), "token long, run long, key long, start long, n int")

    # 1. Tokens that occur twice, and their runs.
    twice = runs.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    runs = cut(runs.join(splittable(twice), "token", "left_semi"))
    # 2. Whole runs that occur twice; tokens with several different runs.
    whole = runs.groupBy("token", "run").agg(
        F.count("*").alias("c"), F.min(F.struct("key", "start", "n")).alias("one"))
    kinds = whole.groupBy("token").agg(F.count("*").alias("kinds")).where("kinds > 1")
    known = whole.where("c > 1").select("token", "run")
    repeated = (runs.join(splittable(known), ["token", "run"], "left_semi")
                .select("key", "start", (F.col("start") + F.col("n")).alias("stop")).distinct())
    # 3. One of each different run of a token that has several, by text.
    rest = (whole.join(splittable(kinds), "token")
            .select("token", "kinds", "one.*", (F.col("c") > 1).alias("witness")))
    cold = (_run_bytes(texts, rest.where(F.col("kinds") <= hot_token), span)
            .repartitionByRange("token").sortWithinPartitions("token")
            .mapInPandas(_suffix_map(span), "key long, start long, stop long"))
    rows = _run_bytes(texts, rest.where(F.col("kinds") > hot_token), span).mapInPandas(
        _row_map(span), "token long, tail long, key long, start long, witness boolean")
    often = rows.groupBy("token", "tail").agg(F.count("*").alias("c")).where("c > 1")
    hot = (rows.where("not witness").join(splittable(often), ["token", "tail"], "left_semi")
           .select("key", "start", (F.col("start") + 1).alias("stop")))
    starts = (repeated.unionByName(cold).unionByName(hot)
              .groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("starts")))
    out = (texts.join(splittable(starts), "key", "left")
           .select("doc_id", "text", "starts.start", "starts.stop")
           .mapInArrow(_apply_map(span, with_bytes), RESULT))
    out = out if with_bytes else out.drop("kept")
    return out.withColumnRenamed("doc_id", id_col)
