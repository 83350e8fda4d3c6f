"""SimHash near-duplicates by multi-index hashing.

Fingerprints are 64-bit SimHashes of word shingles; two documents are linked
when their fingerprints differ in at most ``max_bits`` bits; a group is a
connected component of links.

Search: the 64 bits are cut into segments.  If two fingerprints differ in at
most r bits, some segment i differs in at most r_i bits whenever the radii
add up to r - segments + 1.  For each segment every fingerprint is stored under its
own segment value and probes the values of a small Hamming ball around it;
equal values meet in one bucket, where the full distance is verified.
Only probes whose lowest flipped bit is a zero are sent: of two values that
differ in the same bits, exactly one has it.

Equal fingerprints are one node, so groups of copies cost nothing.  A bucket
returns a spanning forest of its links, never all pairs; buckets whose
store is larger than ``hot_bucket`` are cut into blocks and every pair of
blocks becomes its own task group.

Defined results: null text is empty text; texts without words have
fingerprint 0, linked like any other; repeated rows are kept, one result row
each; null doc_ids are kept and never chosen as a group's id unless the group
has no other (then its component_id is null); extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from shopmart.llm.common import cut, splittable

HASH_SEED = 42
PAIR_BLOCK = 1 << 20    # candidate pairs compared at a time
ROW_BLOCK = 1 << 18     # bucket rows gathered before they are compared
BROADCAST_ROWS = 100_000  # listed buckets (32 bytes each) that go to every task
PROBES = 16  # probes of a bucket part for each stored row it may have
COUNT_BLOCK = 1 << 17   # shingle hashes whose bits are counted at a time


def _shingle_hashes(text: bytes | None, shingle: int) -> list[int]:
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return []
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [h(joined, HASH_SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    return [h(joined[a:b], HASH_SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]


def _majority(hashes: list[int], sizes: list[int]) -> np.ndarray:
    """The fingerprint of each run of hashes: bits set in more than half of them."""
    out = np.zeros((len(sizes), 64), np.int64)
    values, at = np.array(hashes, dtype=">u8"), 0
    owner = np.repeat(np.arange(len(sizes)), sizes)
    while at < len(values):
        part = values[at: at + COUNT_BLOCK]
        bits = np.unpackbits(part.view(np.uint8)).reshape(-1, 64)
        rows = owner[at: at + COUNT_BLOCK]
        heads = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        out[rows[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
        at += COUNT_BLOCK
    set_bits = (2 * out > np.array(sizes)[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprint_udf(shingle: int):
    """Column function text → fingerprint, as the bits of a signed long."""

    @arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), np.uint64)
        hashes: list[int] = []
        sizes: list[int] = []
        done = 0
        for text in texts.cast(pa.large_binary()):
            got = _shingle_hashes(text.as_py(), shingle)
            hashes += got
            sizes.append(len(got))
            if len(hashes) >= COUNT_BLOCK:
                out[done: done + len(sizes)] = _majority(hashes, sizes)
                done, hashes, sizes = done + len(sizes), [], []
        if sizes:
            out[done:] = _majority(hashes, sizes)
        return pa.array(out.view(np.int64))

    return fingerprint


def segment_plan(max_bits: int, count: int) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) per segment, for about 2**bits = ``count`` fingerprints.

    More segments are narrower (larger buckets, fewer probes).  The radii are
    as even as they can be, none above 2, and always complete for max_bits.
    """
    want = max(2, int(max(count, 2)).bit_length())
    least = -(-(max_bits + 1) // 3)  # radii of at most 2
    n = min(max_bits + 1, max(least, 64 // want))
    radii = [0] * n
    for i in range(max_bits - n + 1):
        radii[i % n] += 1
    edges = np.linspace(0, 64, n + 1).astype(int)
    return [(int(a), int(b - a), r) for a, b, r in zip(edges, edges[1:], radii)]


def _bucket_rows(fps: DataFrame, plan: list[tuple[int, int, int]]) -> DataFrame:
    """(seg, key, fp, home): each fingerprint's own bucket and its probes, per segment."""
    rows = None
    for seg, (first, bits, radius) in enumerate(plan):
        key = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1))
        masks = [0] + [1 << i for i in range(bits) if radius]
        pairs = [(1 << i) | (1 << j) for i in range(bits) for j in range(i) if radius > 1]
        probe = fps.select("fp", key.alias("own"), F.explode(
            F.array(*[F.lit(m).cast("long") for m in masks + pairs])).alias("mask"))
        # Of two values that differ in the bits of a mask, one has a zero at its lowest bit.
        lowest = F.col("mask").bitwiseAND(-F.col("mask"))
        part = probe.where(F.col("own").bitwiseAND(lowest) == 0).select(
            F.lit(seg).alias("seg"), F.col("own").bitwiseXOR(F.col("mask")).alias("key"),
            "fp", (F.col("mask") == 0).alias("home"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


class _Forest:
    """Union-find over local node numbers, relabelled in bulk after each block."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def _root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Links (a[i], b[i]); those that joined two trees."""
        while True:  # point every node at its root
            up = self.parent[self.parent]
            if (up == self.parent).all():
                break
            self.parent = up
        apart = self.parent[a] != self.parent[b]
        edges = []
        for i, j in zip(a[apart].tolist(), b[apart].tolist()):
            x, y = self._root(i), self._root(j)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                edges.append((i, j))
        return edges


def _bucket_forest(pdf: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Spanning forest of the links inside the buckets of ``pdf``, sorted by bucket."""
    fp = pdf["fp"].to_numpy().view(np.uint64)
    home = pdf["home"].to_numpy()
    place = pdf[["seg", "key", "part"]].to_numpy()
    bucket = np.concatenate(([0], np.cumsum((place[1:] != place[:-1]).any(axis=1))))
    nodes, number = np.unique(fp, return_inverse=True)
    forest, edges = _Forest(len(nodes)), []
    store = np.flatnonzero(home)  # in bucket order, as the rows are
    of = bucket[store]
    lo = np.searchsorted(of, bucket, "left")
    hi = np.searchsorted(of, bucket, "right")
    # A stored row meets the stored rows after it (in one turn of its bucket), a probe all of them.
    rank = np.empty(len(fp), np.int64)
    rank[store] = np.arange(len(store))
    lo = np.where(home, np.maximum(lo, rank + 1), lo) if len(store) else lo
    width = np.where(home & ~pdf["pairs"].to_numpy(), 0, np.maximum(hi - lo, 0))
    todo = np.flatnonzero(width)
    at = 0
    while at < len(todo):
        total = np.cumsum(width[todo[at:]])
        end = at + max(1, int(np.searchsorted(total, PAIR_BLOCK, "right")))
        rows = todo[at:end]
        at = end
        if width[rows[0]] > PAIR_BLOCK:
            steps = range(0, int(width[rows[0]]), PAIR_BLOCK)
        else:
            steps = (0,)
        for step in steps:
            n = np.minimum(width[rows] - step, PAIR_BLOCK) if len(steps) > 1 else width[rows]
            a = np.repeat(rows, n)
            b = store[np.repeat(lo[rows] + step - np.concatenate(([0], np.cumsum(n)[:-1])), n)
                      + np.arange(n.sum())]
            near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
            edges += forest.add(number[a[near]], number[b[near]])
    if not edges:
        return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
    e = nodes[np.array(edges)].view(np.int64)
    return pd.DataFrame({"u": e[:, 0], "v": e[:, 1]})


def _forest_map(max_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size < ROW_BLOCK:
                continue
            rows = pd.concat(held, ignore_index=True)
            last = rows.iloc[-1]
            open_ = ((rows["seg"] == last["seg"]) & (rows["key"] == last["key"])
                     & (rows["part"] == last["part"])).to_numpy()
            done = rows[~open_]
            if len(done):
                yield _bucket_forest(done.reset_index(drop=True), max_bits)
            held, size = [rows[open_]], int(open_.sum()) // 2
        if held:
            yield _bucket_forest(pd.concat(held, ignore_index=True), max_bits)

    return run


def deal(rows: DataFrame, hot_bucket: int = 4096) -> DataFrame:
    """(seg, key, part, fp, home, pairs): bucket rows in parts of a bounded size.

    A bucket of many stored rows is cut into store blocks that meet two by two, and a bucket of many probes into
    probe blocks, each of which gets the stored rows; store blocks meet among themselves in the first of
    those only (``pairs``).  Probes of a large bucket that stores nothing go before the exchange.  Only
    buckets of over ``hot_bucket`` stored rows or ``PROBES`` times as many probes are listed; the list is
    counted first, and broadcast when it is small, so the rows cross one exchange.
    """
    home = F.col("home")
    sizes = (rows.groupBy("seg", "key").agg(F.count_if(home).alias("stored"), F.count_if(~home).alias("probes"))
             .where((F.col("stored") > hot_bucket) | (F.col("probes") > PROBES * hot_bucket))
             .select("seg", "key", "stored",
                     F.greatest(F.lit(1), F.ceil(F.col("stored") / hot_bucket)).cast("int").alias("parts"),
                     F.greatest(F.lit(1), F.ceil(F.col("probes") / (PROBES * hot_bucket))).cast("int").alias("turns")))
    sizes = cut(sizes)
    listed = F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else splittable(sizes)
    rows = (rows.join(listed, ["seg", "key"], "left")
            .where(home | F.coalesce(F.col("stored") > 0, F.lit(True)))
            .withColumns({c: F.coalesce(c, F.lit(1)) for c in ("parts", "turns")}))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    turn = F.pmod(F.xxhash64(F.col("fp"), F.lit("turn")), F.col("turns")).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    rows = rows.select("seg", "key", "fp", "home", "parts", "turns", own.alias("own"),
                       F.explode(F.when(home, every("turns")).otherwise(F.array(turn))).alias("turn"))
    rows = rows.select("*", F.explode(every("parts")).alias("other"))
    # Store blocks meet once, in (lower, higher); a probe's block meets every store block.
    lower, higher = F.least("own", "other"), F.greatest("own", "other")
    part = ((lower * F.col("parts") + higher).cast("long") * F.col("turns") + F.col("turn")).alias("part")
    return rows.select("seg", "key", part, "fp", "home", (F.col("turn") == 0).alias("pairs"))


def links(fps: DataFrame, max_bits: int, count: int, hot_bucket: int = 4096) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fps`` (fp), enough to connect every group."""
    rows = deal(_bucket_rows(fps, segment_plan(max_bits, count)), hot_bucket)
    dealt = rows.repartition("seg", "key", "part").sortWithinPartitions("seg", "key", "part")
    return dealt.mapInPandas(_forest_map(max_bits), "u long, v long")


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(fp, root): connected components of (u, v) by alternating large and small stars.

    Each round is two aggregations and two joins on the remaining links and is cut to
    the checkpoint folder; the number of rounds grows with the logarithm of the nodes.
    """
    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                         F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.where("v > u").join(splittable(least), "u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(splittable(least), "u")
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                         F.col("m").alias("v"))
                 .where("u <> v").distinct())
        e = cut(small)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return e.select(F.col("u").alias("fp"), F.col("v").alias("root"))
        seen = state
    raise RuntimeError("components did not settle")


def _identity(id_col: str, text_col: str):
    """Columns that tell documents apart: null flag and value of the id, hash of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col), F.lit(0)).alias("doc_id"),
            F.xxhash64(text).alias("text_key"))


def _groups(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str,
            hot_bucket: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Marked documents (first, fp), nodes (fp, root) and groups (root, first)."""
    marked = cut(docs.select(
        F.struct(*_identity(id_col, text_col)).alias("first"),
        fingerprint_udf(shingle)(F.col(text_col)).alias("fp")))
    nodes = marked.groupBy("fp").agg(F.min("first").alias("first"))
    found = components(links(nodes.select("fp"), max_bits, nodes.count(), hot_bucket))
    nodes = (nodes.join(found, "fp", "left")
             .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    return marked, nodes, nodes.groupBy("root").agg(F.min("first").alias("first"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4,
                    id_col: str = "doc_id", text_col: str = "text",
                    hot_bucket: int = 4096) -> DataFrame:
    """One row per document: id, fp (long), component_id (smallest id of its group)."""
    def id_of(first):
        return F.when(~F.col(first)["no_id"], F.col(first)["doc_id"])

    marked, nodes, groups = _groups(docs, shingle, max_bits, id_col, text_col, hot_bucket)
    named = groups.select("root", id_of("first").alias("component_id"))
    by_fp = nodes.join(splittable(named), "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(id_of("first").alias(id_col), "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one_per_group(docs: DataFrame, shingle: int = 4, max_bits: int = 4,
                       id_col: str = "doc_id", text_col: str = "text",
                       hot_bucket: int = 4096) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, all columns.

    The document with the group's smallest id stays (of several texts with
    that id the one with the smallest text hash, of rows equal in both the one with the
    smallest hash of all columns but maps); a document without id stays only in groups without any id.
    """
    _, _, groups = _groups(docs, shingle, max_bits, id_col, text_col, hot_bucket)
    keys = ["no_id", "doc_id", "text_key"]
    hashable = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    rows = docs.select(*_identity(id_col, text_col), F.struct(*docs.columns).alias("row"),
                       F.xxhash64(*hashable).alias("row_key"))
    kept = rows.join(groups.select("first.*"), keys, "left_semi")
    return kept.groupBy(*keys).agg(F.min_by("row", "row_key").alias("row")).select("row.*")
