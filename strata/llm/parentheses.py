"""Balanced parentheses with a range min-max tree.

A tree in preorder is a row of bits: 1 where a node opens, 0 where it closes.
The excess (opened minus closed so far) of every bit is kept, and its least and
greatest value per block and, above the blocks, per pair of blocks, of pairs,
and so on. ``find_close`` skips every block that cannot hold the answer.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    def __init__(self, bits: np.ndarray, block: int = BLOCK):
        self.bits, self.block = bits.astype(bool), block
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        self.opened = np.concatenate([[0], np.cumsum(self.bits)])
        blocks = max(1, -(-len(bits) // block))
        width = 1 << (blocks - 1).bit_length()
        pad = width * block - len(bits)
        least = np.append(self.excess, np.full(pad, np.iinfo(np.int64).max)).reshape(width, block).min(axis=1)
        most = np.append(self.excess, np.full(pad, np.iinfo(np.int64).min)).reshape(width, block).max(axis=1)
        self.least, self.most = [least], [most]
        while len(least) > 1:
            least, most = least.reshape(-1, 2).min(axis=1), most.reshape(-1, 2).max(axis=1)
            self.least.append(least)
            self.most.append(most)

    def rank_open(self, at: np.ndarray) -> np.ndarray:
        """Ones before ``at``."""
        return self.opened[at]

    def _scan(self, at: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first place from ``at`` to the end of its block with an excess
        of ``goal`` or less, else -1."""
        found, todo, place = np.full(len(at), -1), np.arange(len(at)), at.copy()
        end = np.minimum((at // self.block + 1) * self.block, len(self.bits))
        while len(todo):
            todo = todo[place[todo] < end[todo]]
            hit = self.excess[place[todo]] <= goal[todo]
            found[todo[hit]] = place[todo[hit]]
            todo = todo[~hit]
            place[todo] += 1
        return found

    def _holds(self, level: int, node: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """Excess moves by one, so a block has ``goal`` if it lies between its
        least and greatest (from a start above ``goal``: if least reaches it)."""
        return (self.least[level][node] <= goal) & (self.most[level][node] >= goal - 1)

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The place of the zero that closes the one at each place of ``at``."""
        at = np.asarray(at, np.int64)
        goal = self.excess[at] - 1
        out = np.full(len(at), -1)
        same = at + 1
        inside = same % self.block != 0
        out[inside] = self._scan(same[inside], goal[inside])
        far = np.flatnonzero(out < 0)
        node, level, found = at[far] // self.block, np.zeros(len(far), np.int64), np.zeros(len(far), bool)
        for up in range(len(self.least) - 1):  # climb until a right neighbour holds the goal
            todo = np.flatnonzero(~found)
            left = todo[node[todo] % 2 == 0]
            hit = left[self._holds(up, node[left] + 1, goal[far[left]])]
            node[hit] += 1
            level[hit], found[hit] = up, True
            rest = np.flatnonzero(~found)
            node[rest] //= 2
        for down in range(len(self.least) - 1, 0, -1):  # and go down to its first block that does
            here = np.flatnonzero(found & (level == down))
            node[here] *= 2
            right = ~self._holds(down - 1, node[here], goal[far[here]])
            node[here] += right
            level[here] = down - 1
        out[far] = self._scan(node * self.block, goal[far])
        return out
