"""Anchors: positions chosen from the content alone, such that equal strings get equal anchors.

Every window of `length` bytes is given the one anchor of its content: among the positions at which
GRAM bytes start inside the window, the one with the smallest hash, the last one on ties. Two equal
windows therefore have their anchors at the same place, wherever they stand.
"""

from __future__ import annotations

import numpy as np
import xxhash

from growthkit.llm.hashing import BASE, mix

#: Bytes whose hash ranks a position.
GRAM = 16
#: Window starts ranked at once: as many as the low bits of a rank can tell apart.
BITS = 20
_LOW = np.uint64((1 << BITS) - 1)


def _grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position."""
    x = data.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    return mix(mix(x[:-8]) * BASE + x[8:])


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, anchor) of each run of windows that share an anchor, in order."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    width = length - GRAM + 1
    block = (1 << BITS) - width
    firsts, lasts, places = [], [], []
    for at in range(0, n, block):
        starts = min(block, n - at)
        rank = _grams(data[at : at + starts + length - 1])
        rank = (rank & ~_LOW) | (_LOW - np.arange(len(rank), dtype=np.uint64))
        step = 1
        while 2 * step <= width:
            rank = np.minimum(rank[:-step], rank[step:])
            step *= 2
        if step < width:
            rank = np.minimum(rank[: step - width], rank[width - step :])
        place = (_LOW - (rank & _LOW)).astype(np.int64) + at
        first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
        last = np.concatenate((first[1:] - 1, [len(place) - 1]))
        if places and places[-1][-1] == place[0]:
            lasts[-1][-1] = last[0] + at
            first, last, place = first[1:], last[1:], place[first[1:]]
            if not len(first):
                continue
        else:
            place = place[first]
        firsts.append(first + at)
        lasts.append(last + at)
        places.append(place)
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(places)


def digest(data: memoryview, a: int, b: int, seed: int = 0) -> int:
    """A 64-bit hash of data[a:b] as a signed number."""
    x = xxhash.xxh3_64_intdigest(data[a:b], seed)
    return x - (1 << 64) if x >> 63 else x
