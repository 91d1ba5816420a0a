"""Merge rules of a byte-pair vocabulary and the adjacency test built on them.

A sequence of tokens is the encoding of its text exactly when every token is the encoding of its own
bytes and every two neighbours are the encoding of theirs.  Two neighbours are when no merge crosses
their border: replayed backwards, the symbols on both sides of the border are undone newest first, and no
pair that stood at the border may have a merge that came before one of the two was used up.
"""

from __future__ import annotations

import numpy as np

NEVER = np.int64(1) << 40


class PairLookup:
    """Open-addressed table from a pair of token ids to the rank of its merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> None:
        bits = max(4, int(len(left) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NEVER, np.int64)
        for key, r in zip((left.astype(np.int64) << 32 | right).tolist(), rank.tolist()):
            at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - bits)
            while self.keys[at] != -1 and self.keys[at] != key:
                at = (at + 1) & self.mask
            self.keys[at] = key
            self.ranks[at] = min(r, int(self.ranks[at]))

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        out = np.full(len(key), NEVER, np.int64)
        todo = np.arange(len(key))
        while len(todo):
            seen = self.keys[at]
            hit = seen == key
            out[todo[hit]] = self.ranks[at[hit]]
            more = ~hit & (seen != -1)
            todo, key, at = todo[more], key[more], (at[more] + 1) & self.mask
        return out


class MergeRules:
    """rank, left and right of every token (-1 for a token that no merge makes) and all ranked pairs."""

    def __init__(self, rank: np.ndarray, left: np.ndarray, right: np.ndarray, pairs: dict[tuple[int, int], int]) -> None:
        self.rank, self.left, self.right, self.pairs = rank, left, right, pairs
        keys = np.array(list(pairs), np.int64).reshape(-1, 2)
        self.lookup = PairLookup(keys[:, 0], keys[:, 1], np.array(list(pairs.values()), np.int64))
        self._known: dict[tuple[int, int], bool] = {}
        self._slots = np.full(1 << 20, -1, np.int64)      # recent answers: pair << 1 | answer

    def adjacent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each i, whether tokens a[i], b[i] may stand next to each other."""
        key = a.astype(np.int64) << 31 | b
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        seen = self._slots[slot]
        out = (seen & 1) == 1
        new = np.flatnonzero(seen >> 1 != key)
        if len(new):
            out[new] = self._replay(a[new], b[new])
            self._slots[slot[new]] = key[new] << 1 | out[new]
        return out

    def _replay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok, todo = np.ones(len(a), bool), np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_used, y_used = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(todo):
            crossing = self.lookup(x, y)
            # of equal ranks the leftmost merge comes first: x's own lies left of the border, y's right
            bad = (crossing < x_used) & (crossing <= y_used) & (crossing < NEVER)
            ok[todo[bad]] = False
            x_rank, y_rank = self.rank[x], self.rank[y]
            on = ~bad & ((x_rank >= 0) | (y_rank >= 0))
            todo, x, y, x_used, y_used, x_rank, y_rank = (v[on] for v in (todo, x, y, x_used, y_used, x_rank, y_rank))
            undo_x = x_rank > y_rank
            x_used, y_used = np.where(undo_x, x_rank, x_used), np.where(undo_x, y_used, y_rank)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return ok

    def adjacent_one(self, a: int, b: int) -> bool:
        """``adjacent`` for one pair, remembered."""
        known = self._known.get((a, b))
        if known is None:
            if len(self._known) > 1 << 20:
                self._known.clear()
            known = self._known[(a, b)] = self._replay_one(a, b)
        return known

    def _replay_one(self, x: int, y: int) -> bool:
        x_used = y_used = int(NEVER)
        while True:
            crossing = self.pairs.get((x, y))
            if crossing is not None and crossing < x_used and crossing <= y_used:
                return False
            x_rank, y_rank = int(self.rank[x]), int(self.rank[y])
            if x_rank < 0 and y_rank < 0:
                return True
            if x_rank > y_rank:
                x_used, x = x_rank, int(self.right[x])
            else:
                y_used, y = y_rank, int(self.left[y])


def merge_down(symbols: list[int], pairs: dict[tuple[int, int], int], made: dict[int, int]) -> tuple[list[int], list]:
    """Apply the merges to a short sequence: always the lowest rank, leftmost first.  ``made`` names the
    token of a rank.  Returns the tokens and the (left, right) of the last merge."""
    last = None
    symbols = list(symbols)
    while len(symbols) > 1:
        best = min(((pairs.get(p, int(NEVER)), i) for i, p in enumerate(zip(symbols, symbols[1:]))))
        if best[0] >= NEVER:
            break
        i = best[1]
        last = (symbols[i], symbols[i + 1])
        symbols[i:i + 2] = [made[best[0]]]
    return symbols, last
