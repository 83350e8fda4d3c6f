"""Vectorised splitting of texts: runs of bytes, and exact numbers for equal runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 22  # bytes of text worked on at a time


def byte_class(values: bytes) -> np.ndarray:
    """True for the given bytes."""
    table = np.zeros(256, bool)
    table[np.frombuffer(values, np.uint8)] = True
    return table


BLANK = byte_class(b" \t\n\x0b\x0c\r")


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs where ``mask`` holds; runs don't cross text borders."""
    edge = np.zeros(len(mask) + 1, bool)
    edge[1:-1] = mask[1:] != mask[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    if not len(mask):
        return cuts[:0], cuts[:0]
    cuts[-1] = len(mask)
    inside = mask[cuts[:-1]]
    return cuts[:-1][inside], cuts[1:][inside]


def numbered(buf: np.ndarray, keep: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number per run, equal for equal bytes only, and the distinct runs by number.

    ``keep`` marks the bytes of the runs and ``sizes`` their lengths in order.
    """
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    values = pa.Array.from_buffers(pa.large_binary(), len(sizes), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf[keep]))])
    found = values.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often ``flags`` holds in each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
