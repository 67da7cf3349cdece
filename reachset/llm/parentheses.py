"""Balanced parentheses of a forest, with range min-max blocks over the excess.

A node is an opening and a closing parenthesis round its subtree, in preorder.
The excess is the number of parentheses open so far.  Each block of ``BLOCK``
parentheses has the smallest and the largest excess in it, and pairs of blocks
up to the whole form a tree over these ranges: as the excess moves by one, a
block holds a value exactly if its range does, so a search passes over blocks
that don't.  All searches here are vectorised over many nodes.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


def pack(opens: np.ndarray) -> bytes:
    """The parentheses as bits, an opening one as 1."""
    return np.packbits(opens).tobytes()


def unpack(bits: bytes, nodes: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=2 * nodes).astype(bool)


def block_ranges(opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest excess of each block."""
    excess = np.cumsum(np.where(opens, 1, -1), dtype=np.int32)
    first = np.arange(0, len(excess), BLOCK)
    return np.minimum.reduceat(excess, first), np.maximum.reduceat(excess, first)


class Parentheses:
    def __init__(self, opens: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1), dtype=np.int32)
        self.start = np.flatnonzero(opens)  # of each node, in preorder
        self.levels = [(low, high)]
        while len(low) > 1:
            odd = len(low) % 2
            low = np.minimum.reduceat(low, np.arange(0, len(low), 2)) if odd else low.reshape(-1, 2).min(1)
            high = np.maximum.reduceat(high, np.arange(0, len(high), 2)) if odd else high.reshape(-1, 2).max(1)
            self.levels.append((low, high))
        pairs = opens[:-1] & ~opens[1:]
        self._leaves = np.concatenate([[0], np.cumsum(pairs), [np.count_nonzero(pairs)]])

    def _scan(self, at: np.ndarray, target: np.ndarray, found: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Looks for the target from ``at`` to the end of its block; those not found."""
        end = np.minimum((at // BLOCK + 1) * BLOCK, len(self.excess))
        while len(which):
            live = at < end
            hit = live & (self.excess[np.minimum(at, len(self.excess) - 1)] == target)
            found[which[hit]] = at[hit]
            if not (live & ~hit).any():
                return which[~hit]
            go = ~hit
            at, end, target, which = at[go] + live[go], end[go], target[go], which[go]
        return which

    def _holds(self, level: int, x: np.ndarray, target: np.ndarray) -> np.ndarray:
        low, high = self.levels[level]
        inside = x < len(low)
        x = np.minimum(x, len(low) - 1)
        return inside & (low[x] <= target) & (target <= high[x])

    def find_close(self) -> np.ndarray:
        """The place of the closing parenthesis of every node, in preorder."""
        close = np.full(len(self.start), -1, dtype=np.int64)
        target = self.excess[self.start] - 1
        far = self._scan(self.start + 1, target, close, np.arange(len(self.start)))
        x, level = self.start[far] // BLOCK + 1, np.full(len(far), -1)
        for k in range(len(self.levels)):  # up: the first range to the right that holds the target
            seek = level < 0
            hit = seek & (x % 2 == 1) & self._holds(k, x, target[far])
            level[hit] = k
            x = np.where(seek & ~hit, (x + x % 2) // 2, x)
        for k in range(len(self.levels) - 2, -1, -1):  # and down to its first block
            down = level > k
            left = 2 * x
            x = np.where(down, left + ~self._holds(k, left, target[far]), x)
        self._scan(x * BLOCK, target[far], close, far)
        return close

    def leaves(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Rank of the pairs ``()`` from place ``first`` to ``last``: childless nodes between."""
        return self._leaves[last] - self._leaves[first]


def range_min(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The smallest of ``values[first : first + size]`` for each pair, sizes from 1."""
    out = np.empty(len(first), dtype=values.dtype)
    power = np.frexp(size)[1] - 1  # two windows of 2^power cover the range
    window = values
    for k in range(int(power.max(initial=0)) + 1):
        at = np.flatnonzero(power == k)
        out[at] = np.minimum(window[first[at]], window[first[at] + size[at] - (1 << k)])
        window = np.minimum(window[: -(1 << k)], window[1 << k :]) if len(window) > 1 << k else window
    return out
