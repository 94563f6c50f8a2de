"""Pair merging of many symbol sequences at once, lowest rank first, on ragged arrays."""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Rules (left, right) -> merged with a rank, found through an open-addressing hash table of arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        left, right = left.astype(np.int64), right.astype(np.int64)
        self.bits = max(8, int(np.ceil(np.log2(4 * max(1, len(left))))))
        keys = (left << 32) | right
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rules = np.full(1 << self.bits, len(left), np.int32)
        slot, waiting = self._home(keys), np.arange(len(keys))
        self.reach = 0
        while len(waiting):
            self.reach += 1
            free = waiting[self.keys[slot[waiting]] == -1]
            self.keys[slot[free]] = keys[free]  # of several for one slot, one stays
            self.rules[slot[free]] = free
            waiting = waiting[self.keys[slot[waiting]] != keys[waiting]]
            slot[waiting] = (slot[waiting] + 1) & ((1 << self.bits) - 1)
        self.rank = np.r_[rank.astype(np.int32), NONE]
        self.merged = np.r_[merged.astype(np.int32), np.int32(-1)]
        # Where a merged symbol takes part in a rule of lower or equal rank, occurrences must be merged one at a time.
        top = int(max(left.max(initial=0), right.max(initial=0), merged.max(initial=0))) + 1
        lowest = np.full(top, NONE, np.int32)
        np.minimum.at(lowest, left, rank.astype(np.int32))
        np.minimum.at(lowest, right, rank.astype(np.int32))
        self.single = np.r_[lowest[merged] <= rank, False]

    def _home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) ^ (keys.view(np.uint64) >> np.uint64(29))
        return ((mixed * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of the rule of each pair; the number of rules where there is none."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._home(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.rules[slot], np.int32(len(self.rank) - 1))
        waiting = np.flatnonzero((there != keys) & (there != -1))
        mask = (1 << self.bits) - 1
        while len(waiting):
            slot[waiting] = (slot[waiting] + 1) & mask
            there = self.keys[slot[waiting]]
            hit = there == keys[waiting]
            out[waiting[hit]] = self.rules[slot[waiting[hit]]]
            waiting = waiting[~hit & (there != -1)]
        return out

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every sequence to its end.  Rounds are common to all sequences: in each, every sequence applies its own
        lowest-rank pair, leftmost occurrences first; sequences without a rule left are set aside."""
        absent = len(self.rank) - 1
        symbols = symbols.astype(np.int32)
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        rule = np.full(len(symbols), absent, np.int32)
        pairs = np.flatnonzero(owner[1:] == owner[:-1])
        rule[pairs] = self.find(symbols[pairs], symbols[pairs + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            rank = self.rank[rule]
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            count = np.diff(np.r_[start, len(owner)])
            lowest = np.minimum.reduceat(rank, start)
            active = lowest != NONE
            if not active.all():
                stay = np.repeat(active, count)
                done.append((symbols[~stay], owner[~stay]))
                symbols, owner, rule, rank = symbols[stay], owner[stay], rule[stay], rank[stay]
                lowest, count = lowest[active], count[active]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, count))
            alone = self.single[rule[at]]
            if alone.any():
                leading = np.r_[True, owner[at[1:]] != owner[at[:-1]]]
                at = at[~alone | leading]
            # Overlapping occurrences (a a a): every second one of a run.
            begins = np.r_[True, np.diff(at) != 1]
            head = np.maximum.accumulate(np.where(begins, at, 0))
            at = at[(at - head) % 2 == 0]
            symbols[at] = self.merged[rule[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, owner, rule = symbols[stay], owner[stay], rule[stay]
            now = at - np.arange(len(at))
            changed = np.r_[now, now[now > 0] - 1]
            rule[changed] = absent
            paired = changed[changed + 1 < len(owner)]
            paired = paired[owner[paired] == owner[paired + 1]]
            rule[paired] = self.find(symbols[paired], symbols[paired + 1])
        if not done:
            return symbols, np.zeros(len(lengths), np.int64)
        flat = np.concatenate([s for s, _ in done])
        owners = np.concatenate([o for _, o in done])
        return flat[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(lengths))
