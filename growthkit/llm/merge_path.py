"""Merging of two sorted arrays along the merge path, in independent pieces of equal work.

The path of a merge crosses every diagonal (so many elements taken in all) once, and a binary search finds where. Between
two diagonals a piece is merged without knowledge of the others; all pieces advance in step.
"""

from __future__ import annotations

import numpy as np

#: Elements that a piece takes.
WORK = 64


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d elements of the merge of `a` and `b` come from `a`, for each d; equal ones of `a` first."""
    lo, hi = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open := lo < hi).any():
        at = (lo + hi) >> 1
        here = a[np.minimum(at, len(a) - 1)] <= b[np.clip(diagonals - 1 - at, 0, len(b) - 1)]
        lo = np.where(open & here, at + 1, lo)
        hi = np.where(open & ~here, at, hi)
    return lo


def common(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the values that stand both in `a` and `b`, as their places there; both rise strictly."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, work), total)
    bounds = crossings(a, b, diagonals)
    i, j = bounds[:-1].copy(), diagonals[:-1] - bounds[:-1]
    to_i, to_j = bounds[1:], diagonals[1:] - bounds[1:]
    found = np.zeros((work, len(i)), bool)
    place_a, place_b = np.zeros((2, work, len(i)), np.int64)
    for step in range(work):
        from_a = (i < to_i) & ((j >= to_j) | (a[np.minimum(i, len(a) - 1)] <= b[np.minimum(j, len(b) - 1)]))
        from_b = ~from_a & (j < to_j)
        # an element of b meets its equal in the one of a taken last; at its start a piece is stitched to the one before
        found[step] = from_b & (i > 0) & (a[i - 1] == b[np.minimum(j, len(b) - 1)])
        place_a[step], place_b[step] = i - 1, j
        i += from_a
        j += from_b
    return place_a.T[found.T], place_b.T[found.T]
