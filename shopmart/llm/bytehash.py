"""Vectorised hashing of byte spans: the numpy part that several operators share.

``prefix`` of a buffer is the running sum of ``code(byte) * BASE**i`` modulo
2**64, with a random 64-bit code per byte value; the hash of any span is the
difference of two prefix values divided by ``BASE**start`` (BASE is odd, so
it has an inverse), mixed with the span's length.  Every span hash is thus
two look-ups, whatever its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 18  # bytes hashed at a time; a dozen work arrays take 8 bytes a byte each


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix64's finaliser)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


CODES = mix((np.arange(1, 257, dtype=np.uint64)) * np.uint64(BASE))
CODES_LOWER = CODES.copy()
CODES_LOWER[65:91] = CODES[97:123]

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        factor = np.full(max(n, 1 << 16), BASE if kind == "up" else INVERSE, np.uint64)
        factor[0] = 1
        _powers[kind] = np.cumprod(factor, dtype=np.uint64)
    return _powers[kind]


def prefix(buf: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(codes[buf] * _power("up", len(buf))[: len(buf)], out=out[1:], dtype=np.uint64)
    return out


def span_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end) of the prefixed buffer; empty spans hash alike."""
    down = _power("down", len(pre))
    length = (np.asarray(end) - np.asarray(start)).astype(np.uint64)
    return mix((pre[end] - pre[start]) * down[start] + length * np.uint64(0xD6E8FEB86659FD93))


def fixed_hash(pre: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every position that has as many."""
    n = len(pre) - 1 - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((pre[size:] - pre[:n]) * _power("down", len(pre))[:n])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with the UTF-8 bytes of all texts and the n + 1 offsets into it; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offsets[0]: offsets[-1]], offsets - offsets[0]


def words(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray,
          codes: np.ndarray = CODES_LOWER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of each text's maximal runs of word bytes (A-Z hash as a-z).

    Long buffers are hashed in blocks cut between words, so the work arrays
    stay bounded however long one text is (but for a single word longer than
    a block).
    """
    first, last = is_word[buf], is_word[buf]
    mask = first.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    filled = offsets[:-1] < offsets[1:]  # a word ends where its text ends
    head, tail = offsets[:-1][filled], offsets[1:][filled] - 1
    first[head], last[tail] = mask[head], mask[tail]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK_BYTES, "right")))
        base = starts[lo]
        pre = prefix(buf[base: ends[hi - 1]], codes)
        hashes[lo:hi] = span_hash(pre, starts[lo:hi] - base, ends[lo:hi] - base)
        lo = hi
    return starts, ends, hashes


def blocks(sizes: np.ndarray, limit: int = BLOCK_BYTES) -> list[tuple[int, int]]:
    """Row ranges whose sizes add up to at most ``limit`` (a larger row stands alone)."""
    out, lo, total = [], 0, 0
    for i, size in enumerate(sizes):
        if i > lo and total + size > limit:
            out.append((lo, i))
            lo, total = i, 0
        total += int(size)
    if lo < len(sizes):
        out.append((lo, len(sizes)))
    return out
