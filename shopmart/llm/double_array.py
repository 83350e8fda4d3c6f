"""Double-array tries over rows of numbers, built and walked in numpy.

A child of node ``s`` by symbol ``c`` stands at ``base[s] + c`` and has ``check`` equal to ``s``; so a step
is two look-ups, for any number of positions of a text at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TRIED = 2048  # free places tried for a node's children before they go to the end


@dataclass
class DoubleArray:
    base: np.ndarray
    check: np.ndarray

    ROOT = 0

    def step(self, nodes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The child of each node by its symbol; -1 where the node or symbol is -1 or there is none."""
        at = self.base[nodes] + symbols
        good = (nodes >= 0) & (symbols >= 0) & (at >= 0) & (at < len(self.check))
        at = np.where(good, at, 0)
        return np.where(good & (self.check[at] == nodes), at, -1)


class _Places:
    """Free and used places while the children are laid out."""

    def __init__(self):
        self.used = np.zeros(1024, bool)
        self.used[0] = True  # the root
        self.first = 1

    def _grow(self, size: int) -> None:
        if size > len(self.used):
            self.used = np.concatenate([self.used, np.zeros(max(size, 2 * len(self.used))
                                                            - len(self.used), bool)])

    def base_for(self, symbols: np.ndarray) -> int:
        """A base at which all of a node's (ascending) symbols find free places."""
        span = symbols - symbols[0]
        end = int(np.flatnonzero(self.used)[-1]) + 1
        self._grow(end + int(span[-1]) + 2)
        free = np.flatnonzero(~self.used[self.first: end])[:TRIED] + self.first
        for lo in range(0, len(free), 64):
            part = free[lo: lo + 64]
            self._grow(int(part[-1] + span[-1]) + 1)
            good = ~self.used[part[:, None] + span[None, :]].any(axis=1)
            if good.any():
                place = int(part[np.argmax(good)])
                break
        else:
            place = end
            if len(free) == TRIED:  # crowded: later nodes look further on
                self.first = int(free[TRIED // 2])
        self.used[place + span] = True
        return place - int(symbols[0])

    def singles(self, count: int) -> np.ndarray:
        """The first free places, for nodes with one child each."""
        self._grow(len(self.used) + count)
        places = np.flatnonzero(~self.used)[:count]
        self.used[places] = True
        return places


def build(rows: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
    """The trie of all rows (symbols from 0, filled up with -1) and each row's node.

    Rows are laid out depth by depth, nodes of many children first; nodes of one child
    then fill the holes.
    """
    order = np.lexsort(rows.T[::-1])
    sorted_rows = rows[order]
    places = _Places()
    base, check = {}, {}
    node = np.zeros(len(rows), np.int64)  # of the prefix so far
    prefix = np.zeros(len(rows), np.int64)  # number of the prefix so far
    bases, children = [], []
    for depth in range(rows.shape[1]):
        live = np.flatnonzero(sorted_rows[:, depth] >= 0)
        if not len(live):
            break
        symbol, parent = sorted_rows[live, depth], prefix[live]
        new = np.ones(len(live), bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (parent[1:] != parent[:-1])
        heads = np.flatnonzero(new)
        family = np.ones(len(heads), bool)
        family[1:] = parent[heads][1:] != parent[heads][:-1]
        starts = np.flatnonzero(family)
        sizes = np.diff(np.append(starts, len(heads)))
        symbols, parents = symbol[heads].astype(np.int64), node[live][heads]
        place = np.empty(len(heads), np.int64)
        for f in np.argsort(-sizes, kind="stable"):
            if sizes[f] == 1:
                break
            own = slice(starts[f], starts[f] + sizes[f])
            place[own] = places.base_for(symbols[own]) + symbols[own]
        alone = starts[sizes == 1]
        place[alone] = places.singles(len(alone))
        children.append((place, parents))
        bases.append((parents, place - symbols))
        number = np.cumsum(new) - 1
        node[live], prefix[live] = place[number], number
    size = max((int(p.max()) for p, _ in children), default=0) + 1
    base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    for place, parents in children:
        check[place] = parents
    for parents, offset in bases:
        base[parents] = offset
    nodes = np.empty(len(rows), np.int64)
    nodes[order] = node
    return DoubleArray(base, check), nodes
