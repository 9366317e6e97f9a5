"""SuperMinHash signatures: one permutation of the slots for each element, in vectorised rounds."""

from __future__ import annotations

import numpy as np

from growthkit.llm.hashing import BASE, mix

#: Elements whose permutations are held at once (one byte for each element and slot).
BLOCK = 1 << 13


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Matrix (set, slot) of ranks; equal ranks in a slot estimate the Jaccard similarity.

    Element e visits the slots in its own random order; its j-th visit offers the rank j + fraction.
    A set stops at round j once every slot holds a rank below j + 1, because all later offers are larger.
    """
    if not 1 <= slots <= 256:
        raise ValueError("1 to 256 slots")
    ranks = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for at in range(0, len(elements), BLOCK):
        _offer(ranks, elements[at : at + BLOCK], owner[at : at + BLOCK], slots)
    return ranks


def _offer(ranks: np.ndarray, elements: np.ndarray, owner: np.ndarray, slots: int) -> None:
    flat = ranks.reshape(-1)
    order = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
    low = np.uint64(0xFFFFFFFF)
    for j in range(slots):
        seed = np.uint64(((j + 1) * int(BASE)) & 0xFFFFFFFFFFFFFFFF)
        draw = mix(elements + seed)
        row = np.arange(len(elements))
        at = j + (((draw & low) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        slot = order[row, at].astype(np.int64)
        order[row, at] = order[:, j]
        np.minimum.at(flat, owner * slots + slot, (np.uint64(j) << np.uint64(32)) | (draw >> np.uint64(32)))
        here = np.unique(owner)
        going = np.zeros(len(ranks), bool)
        going[here] = (ranks[here].max(axis=1) >> np.uint64(32)) > j
        keep = going[owner]
        if keep.sum() < 0.7 * len(keep):
            elements, owner, order = elements[keep], owner[keep], order[keep]
            if not len(elements):
                return


def bands(ranks: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit hash for each run of `rows` slots; the band's number is part of it."""
    count = ranks.shape[1] // rows
    grouped = ranks[:, : count * rows].reshape(len(ranks), count, rows)
    out = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), grouped.shape[:2]).copy()
    for i in range(rows):
        out = mix(out * BASE + grouped[:, :, i])
    return out.view(np.int64)
