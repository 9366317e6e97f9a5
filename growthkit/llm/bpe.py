"""Ranked byte-pair merges over many words at once.

A `Merges` table maps a pair of adjacent symbols to its rank, and a rank to the merged symbol. Words are rows of a
matrix; every step merges the leftmost lowest-ranked pair of each row, until no row has one.
"""

from __future__ import annotations

import heapq

import numpy as np

from growthkit.llm.hashing import mix

NONE = np.int32(np.iinfo(np.int32).max)
#: Symbols from which a word is merged with a heap, whose time grows with n log n instead of n squared.
LONG = 1024
#: Matrix cells that are worked on at once.
CELLS = 1 << 17


class Merges:
    """Open-addressing table over numpy arrays; about four slots for each pair."""

    def __init__(self, left, right, rank, merged) -> None:
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        size = 1 << int(4 * max(1, len(left)) - 1).bit_length()
        self.shift = np.uint64(64 - size.bit_length() + 1)
        self.mask = np.int64(size - 1)
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NONE, np.int32)
        self.merged = np.zeros(int(np.max(rank, initial=0)) + 1, np.int32)
        self.merged[np.asarray(rank, np.int64)] = merged
        keys = (left << 32) | right
        slot = self._slot(keys)
        rest = np.arange(len(keys))
        while len(rest):
            free = self.keys[slot[rest]] < 0
            at = rest[free]
            _, first = np.unique(slot[at], return_index=True)
            at = at[first]
            self.keys[slot[at]] = keys[at]
            self.rank[slot[at]] = np.asarray(rank)[at]
            rest = np.setdiff1d(rest, at, assume_unique=True)
            slot[rest] = (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; NONE if it never merges."""
        keys = ((left.astype(np.int64) << 32) | right).ravel()
        slot = self._slot(keys)
        found = self.keys[slot]
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & self.mask
            found = self.keys[slot[rest]]
            rest = rest[(found != keys[rest]) & (found >= 0)]
        return self.rank[slot].reshape(left.shape)

    def fold(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, offsets) after all merges of the words that `offsets` bounds in `symbols`."""
        symbols, size = symbols.astype(np.int32), np.diff(offsets)
        order = np.argsort(size, kind="stable")
        ordered = size[order]
        lo, hi = int(np.searchsorted(ordered, 2)), int(np.searchsorted(ordered, LONG))
        left = size.copy()
        at = lo
        while at < hi:
            to = min(hi, at + max(1, CELLS // int(ordered[min(hi, at + CELLS // int(ordered[at])) - 1])))
            self._fold_rows(symbols, offsets, order[at:to], int(ordered[to - 1]), size, left)
            at = to
        for i in order[hi:].tolist():
            word = self._fold_long(symbols[offsets[i] : offsets[i + 1]])
            symbols[offsets[i] : offsets[i] + len(word)] = word
            left[i] = len(word)
        place = np.arange(len(symbols)) - np.repeat(offsets[:-1], size)
        return symbols[place < np.repeat(left, size)], np.concatenate(([0], np.cumsum(left)))

    def _fold_rows(self, symbols, offsets, rows, width: int, size, left) -> None:
        column = np.arange(width + 1, dtype=np.int16)
        n = size[rows]
        place = offsets[rows][:, None] + column
        inside = column < n[:, None]
        ids = np.where(inside, symbols[np.minimum(place, len(symbols) - 1)], 0)
        rank = np.full(ids.shape, NONE, np.int32)
        rank[:, :-1] = np.where(inside[:, 1:], self.find(ids[:, :-1], ids[:, 1:]), NONE)
        while True:
            every = np.arange(len(rows))
            best = rank.argmin(axis=1)
            lowest = rank[every, best]
            live = lowest != NONE
            if live.sum() <= 0.7 * len(rows):
                over = ~live
                inside = column < n[over][:, None]
                symbols[(offsets[rows[over]][:, None] + column)[inside]] = ids[over][inside]
                left[rows[over]] = n[over]
                if not live.any():
                    return
                rows, n, best, lowest = rows[live], n[live], best[live], lowest[live]
                width = int(n.max())
                column = column[: width + 1]
                ids, rank = ids[live, : width + 1], rank[live, : width + 1]
                live, every = np.ones(len(rows), bool), np.arange(len(rows))
            at, to = every[live], best[live]
            ids[at, to] = self.merged[lowest[live]]
            later = column[:-1] > np.where(live, best, width)[:, None]
            ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
            rank[:, :-1] = np.where(later, rank[:, 1:], rank[:, :-1])
            n = n - live
            here, ends = ids[at, to], to >= n[at] - 1
            found = self.find(here, ids[at, to + 1])
            rank[at, to] = np.where(ends, NONE, found)
            at, to, here = at[to > 0], to[to > 0], here[to > 0]
            rank[at, to - 1] = self.find(ids[at, to - 1], here)

    def _fold_long(self, word: np.ndarray) -> np.ndarray:
        ids = word.tolist()
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        rank = self.find(word[:-1], word[1:]).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(rank) if r != NONE]
        heapq.heapify(heap)
        end = len(ids)

        def push(i: int, j: int) -> None:
            r = int(self.find(np.array([ids[i]]), np.array([ids[j]]))[0])
            if r != NONE:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j >= end or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return np.array([x for x in ids if x >= 0], np.int32)
