"""Balanced parentheses: an ordered tree as a bit sequence, 1 where a node opens and 0 where it closes.

`find_close` finds the end of many subtrees at once. It looks through the node's own block of bits,
then climbs a min-max tree over the blocks' excess (opened minus closed) until a block falls below
the node's level, and descends to it. With the end of a subtree, ranks give its size and its
leaves, and differences of cumulative arrays give sums over it.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64  # bits


class Parentheses:
    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(bool)
        n = len(bits)
        self.excess = np.cumsum(np.where(self.bits, 1, -1)).astype(np.int64)
        self.opens = np.flatnonzero(self.bits)  # in preorder
        self.opened = np.cumsum(self.bits)  # rank: nodes opened up to a position
        pair = np.zeros(n, bool)
        pair[:-1] = self.bits[:-1] & ~self.bits[1:]
        self.pairs = np.cumsum(pair)  # rank of "()", the leaves
        blocks = -(-n // BLOCK)
        width = 1
        while width < max(blocks, 1):
            width *= 2
        top = np.iinfo(np.int64).max
        padded = np.full(blocks * BLOCK, top)
        padded[:n] = self.excess
        low = np.full(width, top)
        low[:blocks] = padded.reshape(-1, BLOCK).min(1)
        levels = [low]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).min(1))
        # as a heap: node 1 is the root, node k has the children 2k and 2k + 1
        self.low = np.concatenate([[top], *levels[::-1]])
        self.leaf = width

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Where each parenthesis that opens at a position closes: the first later one with an excess below."""
        want, found = self.excess[at] - 1, np.full(len(at), -1)
        go, block = self._scan(np.arange(len(at)), at + 1, want, found)
        node, todo = block + self.leaf, np.arange(len(go))
        while len(todo):  # climb until a block to the right falls low enough
            here = node[todo]
            if (here <= 1).any():
                raise ValueError("a parenthesis isn't closed")
            hit = here % 2 == 0
            hit &= self.low[here | 1] <= want[go[todo]]
            node[todo] = np.where(hit, here + 1, here // 2)
            todo = todo[~hit]
        todo = np.flatnonzero(node < self.leaf)
        while len(todo):  # descend to the first such block
            left = 2 * node[todo]
            node[todo] = np.where(self.low[left] <= want[go[todo]], left, left + 1)
            todo = todo[node[todo] < self.leaf]
        self._scan(go, (node - self.leaf) * BLOCK, want, found)
        return found

    def _scan(self, go: np.ndarray, at: np.ndarray, want: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Look from a position to the end of its block; those not found there, and the block."""
        missed = [(go[:0], at[:0])]
        limit = np.minimum((at // BLOCK + 1) * BLOCK, len(self.bits))
        while len(go):
            hit = self.excess[at] == want[go]
            found[go[hit]] = at[hit]
            go, at, limit = go[~hit], at[~hit] + 1, limit[~hit]
            out = at >= limit
            missed.append((go[out], (at[out] - 1) // BLOCK))
            go, at, limit = go[~out], at[~out], limit[~out]
        return tuple(np.concatenate(x) for x in zip(*missed, strict=True))
