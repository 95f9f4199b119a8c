"""Balanced parentheses of an ordered tree, with a range min-max directory of excess blocks.

A node is an opening parenthesis and the one that closes it; its subtree lies between them. The
excess at a position is the number of open nodes after it. ``find_close`` looks for the first
position after an opening one where the excess falls below its own: in the rest of its block, then
by climbing a tree of block minima, then in the block found. All nodes are searched at once.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    """``bits``: 1 opens, 0 closes; balanced."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        self.n = n
        self.excess = np.cumsum(bits.astype(np.int32) * 2 - 1, dtype=np.int32)
        self.opens = np.flatnonzero(bits)
        follows = np.zeros(n, bool)
        follows[:-1] = bits[1:] == 0
        # rank of leaf pairs "()": how many begin before a position
        self.leaf_rank = np.concatenate(([0], np.cumsum((bits == 1) & follows)))
        blocks = -(-n // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[:n] = self.excess
        self.blocks = padded.reshape(blocks, BLOCK)
        self.leaves = 1 << max(blocks - 1, 0).bit_length()
        self.least = np.full(2 * self.leaves, np.iinfo(np.int32).max, np.int32)
        self.least[self.leaves : self.leaves + blocks] = self.blocks.min(axis=1)
        level = self.leaves
        while level > 1:
            level >>= 1
            below = self.least[2 * level : 4 * level].reshape(level, 2)
            self.least[level : 2 * level] = below.min(axis=1)

    def depths(self) -> np.ndarray:
        """Depth of every node in preorder; the root has 0."""
        return self.excess[self.opens] - 1

    def find_close(self) -> np.ndarray:
        """The closing position of every node in preorder."""
        at, wanted = self.opens, self.excess[self.opens] - 1
        out = np.full(len(at), -1, np.int64)
        block, place = at // BLOCK, at % BLOCK
        rest = self._in_block(block, place + 1, wanted, out, np.arange(len(at)))
        # Climb to the first subtree of blocks to the right that falls low enough, then descend.
        node = self.leaves + block[rest]
        found = np.zeros(len(rest), bool)
        while not found.all():
            open_ = np.flatnonzero(~found)
            here = node[open_]
            left = (here & 1) == 0
            right_ok = np.zeros(len(here), bool)
            right_ok[left] = self.least[here[left] + 1] <= wanted[rest[open_[left]]]
            node[open_] = np.where(right_ok, here + 1, here >> 1)
            found[open_[right_ok]] = True
        while (node < self.leaves).any():
            node = self._down(node, wanted[rest])
        self._in_block(node - self.leaves, np.zeros(len(rest), np.int64), wanted[rest], out, rest)
        return out

    def _down(self, node: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        inner = node < self.leaves
        child = np.where(inner, 2 * node, node)
        go_right = inner & (self.least[np.where(inner, child, 0)] > wanted)
        return child + go_right

    def _in_block(self, block, start, wanted, out, rows) -> np.ndarray:
        """Fill ``out[rows]`` where the block holds the position; the indices of the others."""
        open_ = np.arange(len(block))
        for k in range(BLOCK):
            hit = (start[open_] <= k) & (self.blocks[block[open_], k] <= wanted[open_])
            found = open_[hit]
            out[rows[found]] = block[found] * BLOCK + k
            open_ = open_[~hit]
            if not len(open_):
                break
        return open_
