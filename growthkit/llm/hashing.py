"""64-bit hashes of words and shingles, many texts at once in numpy."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240229)
BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of each value over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which `spans` takes the hash of any span."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=out[1:])
    return out


def spans(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]; equal bytes give equal hashes wherever they stand."""
    _, down = powers(len(running))
    return mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of bytes outside `space`; runs never cross `offsets`."""
    inside = ~space[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    return np.flatnonzero(inside & (~before | cut[:-1])), np.flatnonzero(inside & (~after | cut[1:])) + 1


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text) of the texts that `offsets` bounds in `data`.

    A to Z count as a to z if `lower`.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    data = LOWER[data] if lower else data
    starts, ends = word_bounds(data, offsets)
    return spans(sums(data), starts, ends), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles.

    A text of fewer than k words has its whole sequence as the one shingle; one without words has none.
    """
    folded = hashes.copy()
    for j in range(1, k):
        folded[: len(folded) - j] = folded[: len(folded) - j] * BASE + hashes[j:]
    folded = mix(folded)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= k:
            out.append(np.unique(folded[lo : hi - k + 1]))
        elif hi > lo:
            one = hashes[lo]
            with np.errstate(over="ignore"):
                for h in hashes[lo + 1 : hi]:
                    one = one * BASE + h
                out.append(mix(np.array([one + np.uint64(hi - lo)])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
