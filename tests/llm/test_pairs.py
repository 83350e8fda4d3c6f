"""SimHash groups, multiset fingerprints and repeated passages against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shopmart.llm import multikey, multiset_hash, queries, simhash, suffix_dedup
from tests.llm.conftest import LONG, ODD_ROWS, SF_SMALL


def brute_fingerprint(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, max_bits=4):
    """Fingerprint → representative of its component."""
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f
    for a, b in itertools.combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= max_bits:
            parent[root(a)] = root(b)
    return {f: root(f) for f in parent}


def test_op1_equals_brute_force(spark, texts):
    got = {r.doc_id: r for r in queries.op1_simhash_near_dedup(spark, SF_SMALL).collect()}
    fps = {d: brute_fingerprint(t) for d, t in texts.items()}
    assert {d: r.fingerprint for d, r in got.items()} == {d: f"{f:016x}" for d, f in fps.items()}
    group = brute_groups(set(fps.values()))
    least = {}
    for d, f in fps.items():
        least[group[f]] = min(least.get(group[f], d), d)
    assert {d: r.component_id for d, r in got.items()} == {d: least[group[f]] for d, f in fps.items()}


@pytest.mark.parametrize("max_bits,count,hot", [(4, 100, 4096), (4, 1 << 40, 4096), (4, 10**6, 5),
                                                (1, 100, 4096), (7, 1000, 20)])
def test_links_connect_what_is_near(spark, max_bits, count, hot):
    """Dense clusters and lone points; narrow, wide and split buckets."""
    rng = random.Random(max_bits)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(40):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, max_bits)):
                value ^= 1 << bit
            fps.add(value)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = simhash.components(simhash.links(df, max_bits, count, hot)).collect()
    root = {f: f for f in signed} | {r.fp: r.root for r in found}
    want = brute_groups(fps, max_bits)
    as_signed = dict(zip(fps, signed))
    got = {f: root[as_signed[f]] for f in fps}
    assert len(set(want.values())) == len(set(got.values()))
    assert len({(want[f], got[f]) for f in fps}) == len(set(want.values()))


def test_segments_are_complete():
    for max_bits, count in itertools.product(range(0, 9), (2, 10**4, 10**7, 10**12)):
        plan = simhash.segment_plan(max_bits, count)
        assert sum(b for _, b, _ in plan) == 64
        assert sum(r + 1 for _, _, r in plan) > max_bits  # one segment is within its radius
        assert all(r <= 2 for _, _, r in plan)


def test_simhash_odd_rows(spark, odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD_ROWS)
    fp = {}
    for r in rows:
        fp.setdefault(r.doc_id, set()).add(r.fp & (1 << 64) - 1)
    assert fp[4] == fp[5] == {0} and brute_fingerprint("one") in fp[6]
    groups = {(r.doc_id, r.component_id) for r in rows}
    assert (2, 1) in groups and (None, 1) in groups and (9, 8) in groups
    assert (5, 3) in groups and (None, 3) in groups          # wordless texts, null id
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one_per_group(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        {r.component_id: 1 for r in rows} | {3: 2})
    assert simhash.keep_one_per_group(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(0, 300).select((F.col("id") * 7919 % 301).alias("a"),
                                       ((F.col("id") + 1) * 7919 % 301).alias("b"))
    found = simhash.components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    assert {r.root for r in found.collect()} == {0}


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def signed_hash(text):
    found = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return found - (1 << 64) if found >= 1 << 63 else found


def brute_multiset(text, lanes=128):
    """(hex, sign sums) by plain integers."""
    words, signs = [0] * 8, [0] * lanes
    for part in re.split(r"[\n\r]+|(?<=[.!?])\s+", text):
        if part.strip():
            digest = hashlib.blake2b(part.strip().encode(), digest_size=64).digest()
            for i in range(8):
                words[i] += int.from_bytes(digest[8 * i: 8 * i + 8], "big")
            for i in range(lanes):
                signs[i] += 1 if digest[i // 8] >> (7 - i % 8) & 1 else -1
    return ("".join(f"{w % 2**64:016x}" for w in words) + "".join(f"{s % 2**32:08x}" for s in signs)), signs


def brute_cosine(a, b):
    size = (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
    return 1.0 if a == b else max(0.0, sum(x * y for x, y in zip(a, b)) / size) if size else 0.0


def test_op2_equals_its_definition(spark, texts):
    got = {r.doc_id: r for r in queries.op2_document_fingerprints(spark, SF_SMALL).collect()}
    ids = sorted(texts)
    assert sorted(got) == ids
    for d, after in zip(ids, ids[1:] + ids[:1]):
        text, other, r = texts[d], texts[after], got[d]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        (mine, vector), (theirs, other_vector) = brute_multiset(text), brute_multiset(edited)
        assert r.fingerprint == mine and r.edited_fingerprint == theirs
        assert r.near_edited == pytest.approx(brute_cosine(vector, other_vector))
        assert r.near_next == pytest.approx(brute_cosine(vector, brute_multiset(other)[1]))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len({r.fingerprint for r in got.values()}) >= len(set(texts.values())) - 2
    long = [d for d in ids if len(texts[d]) > 2000]
    assert sum(got[d].near_edited > got[d].near_next + 0.2 for d in long) > 0.8 * len(long)


def test_multiset_hash_is_a_homomorphism():
    parts = [f"paragraph {i}" for i in range(50)] + ["again"] * 3
    total = multiset_hash.fingerprint("\n".join(parts))
    random.Random(3).shuffle(parts)
    assert multiset_hash.fingerprint("\n\n".join(parts)) == total
    more = total.insert("new one")
    assert more == multiset_hash.fingerprint("\n".join([*parts, "new one"]))
    assert more.delete("new one") == total
    assert multiset_hash.Fingerprint.of_hex(total.hex()) == total
    assert multiset_hash.likeness(total, total) == 1.0
    assert multiset_hash.likeness(total, multiset_hash.fingerprint("")) == 0.0
    fewer = total.delete("again")
    assert fewer != total and 1 > multiset_hash.likeness(fewer, total) > 0.9


def test_often_repeated_paragraphs_have_their_own_fingerprints(spark):
    """Sums of signs alone would wrap: 2**16 copies of anything to zero, 2**15 of any two to the same."""
    texts = ["x\n" * 65536, "", "aaa\n" * 32768, "bbb\n" * 32768, "x\n" * 131072, "x\n" * 65535]
    found = multiset_hash.compare_with_next(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert len({r.fingerprint for r in found}) == len(texts)
    assert all(r.near_next < 1 for r in found) and found[2].near_next < 0.5 and found[0].near_next == 0


def test_op2_hot_ids_are_spread_over_ranges(spark):
    """A third of the rows without id and a third under one id: no range holds much of them."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).when(F.col("id") % 3 == 1, F.lit(77)).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    dealt = multiset_hash.with_next(rows, buckets=30)
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("guest").alias("guests")).collect()
    assert max(r.n for r in sizes) < 9000 / 30 * 2.5 and {r.guests for r in sizes} == {1}
    got = multiset_hash.compare_with_next(rows, buckets=30).collect()
    order = sorted(((r.doc_id is None, r.doc_id or 0, signed_hash(r.text), r.text) for r in rows.collect()))
    want = Counter()
    for a, b in zip(order, order[1:] + order[:1]):
        half = len(a[3]) // 2
        want[None if a[0] else a[1], sha256(a[3][: len(a[3]) - half] + b[3][:half])] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == want


def test_op2_odd_rows(odd, empty):
    for buckets in (1, 3, 40):
        rows = multiset_hash.compare_with_next(odd, buckets=buckets).collect()
        order = sorted(((d is None, d or 0, signed_hash(t or ""), t or "") for d, t in ODD_ROWS))
        want = Counter()
        for (no_id, d, _, t), (*_, after) in zip(order, order[1:] + order[:1]):
            half = len(t) // 2
            edited = t[: len(t) - half] + after[:half]
            want[(None if no_id else d, len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    assert multiset_hash.compare_with_next(empty).count() == 0
    one = multiset_hash.compare_with_next(odd.where("doc_id = 6")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def brute_removed(texts, span):
    """(n_bytes, n_removed, n_spans, kept sha256) per text, by counting all strings."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + span] for b in raw for i in range(len(b) - span + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - span + 1):
            if count[b[i:i + span]] > 1:
                gone[i:i + span] = True
        gone = gone[:len(b)]
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def digest(row):
    return (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256)


def test_op6_equals_brute_force(spark, texts):
    got = {r.doc_id: digest(r) for r in queries.op6_suffix_array_dedup(spark, SF_SMALL).collect()}
    ids = sorted(texts)
    assert [got[d] for d in ids] == brute_removed([texts[d] for d in ids], 200)


@pytest.mark.parametrize("size,letters", [(1, 3), (5, 2), (8, 2), (13, 2), (24, 3), (200, 1), (200, 2), (200, 256)])
def test_multikey_quicksort_sorts_by_bytes(size, letters):
    """Any string length, bytes above 127, overlaps, a copied passage, all strings equal."""
    rng = np.random.default_rng(size)
    buf = (256 - letters + rng.integers(0, letters, 2000 + size - 1)).astype(np.uint8)
    buf[1200:1600] = buf[100:500]
    at = rng.permutation(2000)
    order, equal = multikey.multikey_quicksort(buf, at, size)
    strings = [bytes(buf[p:p + size]) for p in at]
    assert [strings[i] for i in order] == sorted(strings)
    often = Counter(strings)
    assert equal.tolist() == [often[s] > 1 for s in strings]


@pytest.mark.parametrize("size", [1, 200])
def test_multikey_quicksort_of_no_strings(size):
    order, equal = multikey.multikey_quicksort(np.zeros(0, np.uint8), np.zeros(0, np.int64), size)
    assert len(order) == len(equal) == 0


@pytest.mark.parametrize("hot_token", [4096, 0])
def test_suffix_dedup_small_alphabets(spark, hot_token):
    """Periodic texts, overlaps, repeats inside a text, prefixes and suffixes of others."""
    rng = random.Random(5)
    texts = ["ab" * 40, "ab" * 40 + "c", "a" * 60, "é" * 30, ""]
    base = "".join(rng.choice("abcd") for _ in range(120))
    texts += [base, base[:70], base[50:], base[20:90] + "zz", base[::-1], base + base]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randint(0, 90))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: digest(r) for r in
           suffix_dedup.remove_repeats(df, span=24, token=6, hot_token=hot_token).collect()}
    assert [got[i] for i in range(len(texts))] == brute_removed(texts, 24)


def test_suffix_dedup_blocks_of_a_long_text(spark, monkeypatch):
    """A text longer than a block, and its copy at another place."""
    from shopmart.llm import bytehash
    monkeypatch.setattr(bytehash, "BLOCK_BYTES", 512)
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    raw = [text, "x" * 37 + text[100:4000], text[4500:]]
    rows = []
    for t in raw:
        buf = np.frombuffer(t.encode(), np.uint8)
        rows.append([tuple(int(v[i]) for v in (a, n, k)) for a, n, k, _ in
                     suffix_dedup._long_text_runs(buf, 50, 8) for i in range(len(a))])
    for t, found in zip(raw, rows):
        assert sum(n for _, n, _ in found) == len(t) - 50 + 1
        assert [a for a, _, _ in found] == list(itertools.accumulate(
            [0] + [n for _, n, _ in found[:-1]]))
    tokens = [{a + i: k for a, n, k in found for i in range(n)} for found in rows]
    assert all(tokens[1][i - 100 + 37] == tokens[0][i] for i in range(100, 3950))


def test_suffix_dedup_odd_rows(odd, empty):
    got = suffix_dedup.remove_repeats(odd, span=30).collect()
    want = brute_removed([t if t is None or len(t) < 1000 else t[:300] for _, t in ODD_ROWS], 30)
    assert len(got) == len(ODD_ROWS)
    short = Counter((d, *w) for (d, t), w in zip(ODD_ROWS, want) if t is None or len(t) < 1000)
    assert not short - Counter((r.doc_id, *digest(r)) for r in got)
    for r in got:
        if r.doc_id == 8:
            assert (r.n_removed, r.n_spans, bytes(r.kept)) == (len(LONG), 1, b"")
        if r.doc_id == 9:
            assert (r.n_removed, bytes(r.kept)) == (len(LONG), b"x")
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_op1_hot_probes_are_dropped_or_split(spark):
    """Fingerprints that share a segment probe the same keys, most of which store nothing."""
    rng = random.Random(8)
    fps = [(rng.getrandbits(40) << 21 | 0x155555) & (1 << 61) - 1 for _ in range(3000)]
    fps += [f ^ 1 << rng.randrange(40, 60) for f in fps[:40]]
    near = 0x155555 ^ 1 << 7            # a neighbouring key that few store and all probe
    fps += [(rng.getrandbits(40) << 21 | near) & (1 << 61) - 1 for _ in range(3)]
    fps += [fps[0] ^ 1 << 7, fps[1] ^ 1 << 7 ^ 1 << 50]
    df = spark.createDataFrame([(f,) for f in set(fps)], "fp long")
    rows = simhash._bucket_rows(df, [(0, 21, 1), (21, 21, 1), (42, 22, 0)])
    before = rows.groupBy("seg", "key").agg(F.max("home").alias("stores"), F.count("*").alias("n"))
    assert before.where("not stores and n > 2900").count() > 5
    dealt = simhash.deal(rows, hot_bucket=100)
    after = dealt.groupBy("seg", "key", "part").agg(F.max("home").alias("stores"), F.count("*").alias("n"))
    limit = simhash.PROBES * 100
    assert after.agg(F.max("n")).first()[0] <= 1.3 * limit
    assert after.where(f"not stores and n > {limit}").count() == 0
    found = simhash.components(simhash.links(df, 3, df.count(), hot_bucket=100))
    roots = {r.fp: r.root for r in found.collect()}
    want = {}
    values = np.array(sorted(set(fps)), np.uint64)
    for i, f in enumerate(values):
        for g in values[i + 1:][np.bitwise_count(values[i + 1:] ^ f) <= 3]:
            want.setdefault(int(f), set()).add(int(g))
    root = lambda f: roots.get(f, f)  # noqa: E731  (a root has no row of its own)
    assert want and all(root(f) == root(g) for f, others in want.items() for g in others)
    assert set(roots) | set(roots.values()) == set(want) | {g for others in want.values() for g in others}


def test_one_row_of_equal_ids_and_texts_is_kept_by_its_other_columns(spark):
    """Whatever the order and partitions of the rows, the same one stays."""
    rows = [(1, "the same words again here", f"source {i}", {"k": i}) for i in range(40)]
    kept = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, source string, extra map<string,int>")
        kept.add(tuple(r.source for r in simhash.keep_one_per_group(df.repartition(seed + 1)).collect()))
    assert len(kept) == 1 and len(next(iter(kept))) == 1
