"""A tree as balanced parentheses, with a range min-max tree over blocks of their excess, in vectorised numpy.

A node is an opening parenthesis, numbered in preorder; its subtree ends at the closing one. The excess of a place is
the number of open minus closed ones up to it.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        self.bits, self.block = bits, block
        self.excess = np.cumsum(2 * bits.astype(np.int32) - 1, dtype=np.int32)
        self.opens = np.flatnonzero(bits)
        level = np.minimum.reduceat(self.excess, np.arange(0, len(bits), block)) if len(bits) else self.excess
        self.levels = [level]  # least excess of each block, then of each pair of the level below
        while len(level) > 1:
            level = np.minimum.reduceat(level, np.arange(0, len(level), 2))
            self.levels.append(level)
        leaf = np.zeros(len(bits), dtype=np.int64)
        leaf[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        self._leaves = np.append(0, np.cumsum(leaf))

    def depth(self) -> np.ndarray:
        """Depth of every node, the root's being 0."""
        return self.excess[self.opens] - 1

    def find_close(self, places: np.ndarray) -> np.ndarray:
        """The closing place of each opening place: the first behind it whose excess is one less."""
        places = np.asarray(places, dtype=np.int64)
        target = self.excess[places] - 1
        found = np.full(len(places), -1, dtype=np.int64)
        last = np.minimum((places // self.block + 1) * self.block, len(self.bits))
        self._scan(places + 1, last, target, found, np.arange(len(places)))
        rest = np.flatnonzero(found < 0)
        if len(rest):
            block = self._next_block(places[rest] // self.block, target[rest])
            start = block * self.block
            self._scan(start, np.minimum(start + self.block, len(self.bits)), target[rest], found, rest)
        return found

    def _scan(self, start: np.ndarray, end: np.ndarray, target: np.ndarray, found: np.ndarray, where: np.ndarray) -> None:
        """Look inside one block each; ``found[where]`` gets the first place at or below the target."""
        active = np.flatnonzero(start < end)
        at = start[active]
        while len(active):
            hit = self.excess[at] <= target[active]
            found[where[active[hit]]] = at[hit]
            going = ~hit & (at + 1 < end[active])
            active, at = active[going], at[going] + 1

    def _next_block(self, block: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first block behind each block that reaches the target: up until a right neighbour does, then down."""
        node, level = block.copy(), np.full(len(block), -1)
        for height, least in enumerate(self.levels):
            up = np.flatnonzero(level < 0)
            right = node[up] + 1
            hit = (node[up] % 2 == 0) & (right < len(least)) & (least[np.minimum(right, len(least) - 1)] <= target[up])
            node[up[hit]], level[up[hit]] = right[hit], height
            node[up[~hit]] //= 2
        for height in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(level == height)
            left = 2 * node[down]
            node[down] = np.where(self.levels[height - 1][left] <= target[down], left, left + 1)
            level[down] = height - 1
        return node

    def leaves(self, opened: np.ndarray, closed: np.ndarray) -> np.ndarray:
        """Leaf pairs between each opening and closing place, by the rank of both."""
        return self._leaves[closed] - self._leaves[opened]

    def parents(self) -> np.ndarray:
        """Preorder number of each node's parent, -1 for a root: the last node before it that is one less deep."""
        depth, n = self.depth().astype(np.int64), len(self.opens)
        number = np.arange(n)
        ordered = np.sort(depth * n + number)
        at = np.searchsorted(ordered, (depth - 1) * n + number) - 1
        return np.where(depth > 0, ordered[at] % max(n, 1), -1)
