"""Rank-synchronous BPE merging on ragged numpy arrays.

Many pre-tokens lie in one flat symbol array with their sequence numbers. Each step finds
every sequence's lowest-rank adjacent pair and merges all of its non-overlapping occurrences,
in all sequences at once. Sequences without a pair left drop out.
"""

from __future__ import annotations

import numpy as np

_NONE = np.int64(1) << 40
_SPREAD = np.uint64(0x9E3779B97F4A7C15)  # 2^64 over the golden ratio


class Memo(dict):
    """Known words. Another word is noted in ``new`` and stands for itself until it is learned."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> str:
        self.new.append(word)
        self[word] = word
        return word


class RankMerger:
    def __init__(self, merges: dict, n_ids: int):
        self.n = np.int64(n_ids)
        left, right, rank, new = (np.array(x, dtype=np.int64) for x in
                                  zip(*((a, b, r, c) for (a, b), (r, c) in merges.items())))
        key = left * self.n + right
        order = np.argsort(key)
        self.key, self.rank, self.new = key[order], rank[order], new[order]
        # a table of places in the merge table by the pair's hash, an eighth full at most; clashes go to the next cell
        bits = max(8, (8 * len(key)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.cells = np.full(1 << bits, -1, np.int32)
        left_over, cell = np.arange(len(key)), self._cell(self.key)
        while len(left_over):
            free = np.flatnonzero(self.cells[cell] < 0)
            first = free[np.unique(cell[free], return_index=True)[1]]
            self.cells[cell[first]] = left_over[first]
            left_over, cell = np.delete(left_over, first), np.delete(cell, first) + 1 & self.mask

    def _cell(self, k: np.ndarray) -> np.ndarray:
        return (k.astype(np.uint64) * _SPREAD >> self.shift).astype(np.int64)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in the merge table, -1 where it has none."""
        k = left * self.n + right
        cell = self._cell(k)
        at = self.cells[cell].astype(np.int64)
        clash = np.flatnonzero((at >= 0) & (self.key[at] != k))
        while len(clash):
            cell[clash] = cell[clash] + 1 & self.mask
            at[clash] = self.cells[cell[clash]]
            clash = clash[(at[clash] >= 0) & (self.key[at[clash]] != k[clash])]
        return at

    def merge(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat symbols, lengths) of sequences after all merges, in the same order."""
        n = len(lengths)
        sym = flat.astype(np.int64)
        seq = np.repeat(np.arange(n), lengths)
        at = np.append(np.where(seq[:-1] == seq[1:], self._lookup(sym[:-1], sym[1:]), -1), -1)[:len(sym)]
        done_sym, done_seq = [], []
        while len(sym):
            rank = np.where(at >= 0, self.rank[at], _NONE)
            starts = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            best = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(sym)))
            if (best == _NONE).any():  # finished sequences leave
                live = np.repeat(best < _NONE, size)
                done_sym.append(sym[~live])
                done_seq.append(seq[~live])
                sym, seq, rank, at = sym[live], seq[live], rank[live], at[live]
                size, best = size[best < _NONE], best[best < _NONE]
                if not len(sym):
                    break
            hit = rank == np.repeat(best, size)
            # overlapping occurrences (aaa): every second one of a run, from the left; a sequence's
            # last symbol is never a hit, so a run stays inside its sequence
            prev = np.append(False, hit[:-1])
            if (hit & prev).any():
                run = np.maximum.accumulate(np.where(hit & ~prev, np.arange(len(hit)), 0))
                hit &= (np.arange(len(hit)) - run) % 2 == 0
            pos = np.flatnonzero(hit)
            sym[pos] = self.new[at[pos]]
            keep = np.ones(len(sym), dtype=bool)
            keep[pos + 1] = False
            sym, seq, at = sym[keep], seq[keep], at[keep]
            # only pairs that touch a merged symbol change
            pos -= np.arange(len(pos))
            near = np.zeros(len(sym) + 1, dtype=bool)
            near[pos] = near[pos - 1] = True  # position 0 marks the spare last cell
            touched = np.flatnonzero(near[:len(sym) - 1])
            same = seq[touched] == seq[touched + 1]
            at[touched] = np.where(same, self._lookup(sym[touched], sym[touched + 1]), -1)
            if len(sym):
                at[-1] = -1
        if not done_sym:
            return np.empty(0, np.int64), np.zeros(n, np.int64)
        sym, seq = np.concatenate(done_sym), np.concatenate(done_seq)
        order = np.argsort(seq, kind="stable")
        return sym[order], np.bincount(seq, minlength=n)
