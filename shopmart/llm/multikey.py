"""Multikey quicksort of byte strings in one buffer, all segments of a level at once.

The characters are words of eight bytes.  A segment of strings that agree in their
first words is split three ways by a pivot's next word: smaller and larger strings stay at
that word, those equal to the pivot go on to the next one.  A segment that is equal
in every word holds equal strings.  Numpy splits all open segments in one step; segments
of one string are closed.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def words_at(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a number that orders as the bytes do; zeros follow the end."""
    padded = np.concatenate([buf, np.zeros(WORD - 1, np.uint8)])
    out = np.zeros(len(buf), np.uint64)
    for i in range(WORD):
        out = (out << np.uint64(8)) | padded[i: i + len(buf)]
    return out


def multikey_quicksort(buf: np.ndarray, at: np.ndarray, size: int,
                       seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings ``buf[p : p + size]`` for p in ``at``, and whether each has an equal.

    ``at[order]`` is sorted by bytes; ``equal`` is in the order of ``at``.
    """
    rng = np.random.default_rng(seed)
    words = words_at(buf)
    # The last word ends with the string: it may overlap the one before, which is equal there.
    places = np.minimum(np.arange(0, size, WORD), max(size - WORD, 0))
    shift = np.uint64(8 * max(WORD - size, 0))
    order = np.arange(len(at))
    equal = np.zeros(len(at), bool)
    start, count, depth = np.array([0]), np.array([len(at)]), np.array([0])
    while True:
        whole = (count > 1) & (depth == len(places))
        if whole.any():
            equal[order[_members(start[whole], count[whole])]] = True
        open_ = (count > 1) & (depth < len(places))
        if not open_.any():
            return order, equal
        start, count, depth = start[open_], count[open_], depth[open_]
        slots = _members(start, count)
        held = order[slots]
        base = np.cumsum(count) - count
        word = words[at[held] + np.repeat(places[depth], count)] >> shift
        a, b, c = (word[base + (rng.random(len(count)) * count).astype(np.int64)] for _ in range(3))
        pivot = np.repeat(np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c)), count)
        less, more = word < pivot, word > pivot
        n_less, n_more = (np.add.reduceat(x, base, dtype=np.int64) for x in (less, more))
        n_same = count - n_less - n_more
        for side, first in ((less, start), (~(less | more), start + n_less),
                            (more, start + n_less + n_same)):
            n = n_less if side is less else n_more if side is more else n_same
            order[_members(first, n)] = held[side]
        start = np.concatenate([start, start + n_less, start + n_less + n_same])
        count = np.concatenate([n_less, n_same, n_more])
        depth = np.concatenate([depth, depth + 1, depth])


def _members(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All positions of the segments [start, start + count), segment by segment."""
    before = np.cumsum(count) - count
    return np.repeat(start - before, count) + np.arange(count.sum())
