"""Token ids of text chunks, each distinct chunk encoded once while a worker remembers it."""

from __future__ import annotations

import numpy as np

from growthkit.llm.hashing import spans, sums

#: Chunks a worker remembers before it starts afresh.
MEMO = 1 << 20
#: Second bytes of two-byte characters U+00C0 to U+00FF that are no letters.
NO_LETTER = (0x97, 0xB7)


class ChunkMemo:
    """`encode` looks chunks up by a 64-bit hash; a subclass encodes the new ones in `learn`."""

    def __init__(self, limit: int = MEMO) -> None:
        self.limit = limit
        self.reset()

    def reset(self) -> None:
        size = 1 << (2 * self.limit - 1).bit_length()
        self.mask = np.int64(size - 1)
        self.keys = np.zeros(size, np.uint64)
        self.rows = np.full(size, -1, np.int32)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each chunk)."""
        raise NotImplementedError

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the chunks one after another, offset of each chunk and of the end)."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        if len(self.start) > self.limit or len(self.start) + len(starts) > 0.9 * len(self.keys):
            self.reset()
        keys = spans(sums(data), starts, ends)
        rows = self._find(keys)
        new = np.flatnonzero(rows < 0)
        if len(new):
            _, first = np.unique(keys[new], return_index=True)
            first = new[first]
            if len(first) > 0.4 * len(self.keys):  # one enormous text
                ids, size = self.learn(data, starts, ends)
                return ids, np.concatenate(([0], np.cumsum(size)))
            self._add(keys[first], *self.learn(data, starts[first], ends[first]))
            rows[new] = self._find(keys[new])
        size = self.size[rows]
        before = np.concatenate(([0], np.cumsum(size)))
        place = np.repeat(self.start[rows] - before[:-1], size) + np.arange(before[-1])
        return self.ids[place], before

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot = keys.astype(np.int64) & self.mask
        rest = np.flatnonzero((self.keys[slot] != keys) & (self.rows[slot] >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & self.mask
            at = slot[rest]
            rest = rest[(self.keys[at] != keys[rest]) & (self.rows[at] >= 0)]
        return self.rows[slot]

    def _add(self, keys: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        slot = keys.astype(np.int64) & self.mask
        row = np.arange(len(self.start), len(self.start) + len(keys), dtype=np.int32)
        rest = np.arange(len(keys))
        while len(rest):
            free = rest[self.rows[slot[rest]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            taken = free[first]
            self.keys[slot[taken]], self.rows[slot[taken]] = keys[taken], row[taken]
            rest = np.setdiff1d(rest, taken, assume_unique=True)
            slot[rest] = (slot[rest] + 1) & self.mask
        starts = len(self.ids) + np.concatenate(([0], np.cumsum(size)))[:-1]
        self.ids = np.concatenate((self.ids, ids))
        self.start, self.size = np.concatenate((self.start, starts)), np.concatenate((self.size, size))


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all spans one after another, offsets)."""
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    place = np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])
    return data[place], offsets


def two_byte(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first bytes, second bytes of U+00C0 to U+00FF; other bytes past ASCII)."""
    lead = data == 0xC3
    second = np.concatenate(([False], lead[:-1]))
    return lead, second, (data >= 0x80) & ~lead & ~second


def ordered(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes) of n chunks from parts of (chunk numbers, ids, sizes)."""
    size = np.zeros(n, np.int64)
    for which, _, sizes in parts:
        size[which] = sizes
    offsets = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(offsets[-1], np.int32)
    for which, ids, sizes in parts:
        before = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        out[np.repeat(offsets[which] - before, sizes) + np.arange(len(ids))] = ids
    return out, size
