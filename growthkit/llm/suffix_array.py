"""Suffix arrays of one shard in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, rank of each suffix) of a sequence of whole numbers from 0.

    Suffixes are grouped by their first symbol; then every group that is still open is sorted by the
    ranks of its suffixes `step` symbols further on, and `step` doubles. Groups of one suffix are final
    and not touched again. A suffix that ends sorts before its extensions.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    sorted_symbols = symbols[order]
    head = np.concatenate(([True], sorted_symbols[1:] != sorted_symbols[:-1])) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = 1
    while True:
        single = head & np.concatenate((head[1:], [True])) if n else head
        open_at = np.flatnonzero(~single)
        if not len(open_at):
            return order, rank
        at = order[open_at]
        further = np.where(at + step < n, rank[np.minimum(at + step, n - 1)] + 1, 0)
        group = rank[at]
        by = np.argsort(group * np.int64(n + 1) + further, kind="stable")
        at, further, group = at[by], further[by], group[by]
        order[open_at] = at
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (further[1:] != further[:-1])))
        head[open_at] = new
        rank[at] = np.maximum.accumulate(np.where(new, open_at, 0))
        step *= 2


def kasai(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray, width: int) -> np.ndarray:
    """Common prefix of each suffix in order with the one before it, up to the end of its row.

    The sequence is rows of `width` symbols. As a suffix moves one symbol on, its common prefix loses at
    most one symbol, so the length is carried along each row; all rows move together.
    """
    n = len(symbols)
    out = np.zeros(n, np.int64)
    rows = np.arange(0, n, width)
    length = np.zeros(len(rows), np.int64)
    for column in range(width):
        at = rows + column
        before = np.where(rank[at] > 0, order[rank[at] - 1], -1)
        length = np.where(before >= 0, np.maximum(length - 1, 0), 0)
        room = np.minimum(width - column, width - before % width)
        live = np.flatnonzero((before >= 0) & (length < room))
        while len(live):
            same = symbols[at[live] + length[live]] == symbols[before[live] + length[live]]
            live = live[same]
            length[live] += 1
            live = live[length[live] < room[live]]
        length = np.minimum(length, room)
        out[rank[at]] = length
    return out


def _words(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of big-endian 8-byte words, bytes in each word) of rows cut or padded to `width` words."""
    padded = np.frombuffer(b"".join(r[: 8 * width].ljust(8 * width, b"\0") for r in rows), ">u8")
    size = np.fromiter((len(r) for r in rows), np.int64, len(rows))
    return padded.astype(np.uint64).reshape(len(rows), width), np.clip(size[:, None] - 8 * np.arange(width), 0, 8)


def sorted_rows(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows in order, bytes each shares with the one before) of byte strings of up to 8 * width bytes.

    The rows are the shard's text, read as words of eight bytes; all suffixes of that text are sorted, and
    the suffixes that start a row are picked out.
    """
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word, size = _words(rows, width)
    flat, inverse = np.unique(word, return_inverse=True)
    symbols = inverse.reshape(-1).astype(np.int64) * 9 + size.reshape(-1)
    order, rank = suffix_array(symbols)
    common = kasai(symbols, order, rank, width)
    first = np.sort(rank[np.arange(len(rows)) * width])
    picked = order[first] // width
    shared = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        bounds = np.stack((first[:-1] + 1, first[1:] + 1), axis=1).reshape(-1)
        bounds = np.minimum(bounds, len(common) - 1)
        whole = np.minimum.reduceat(common, bounds)[::2]
        a, b = picked[:-1], picked[1:]
        at = np.minimum(whole, width - 1)
        different = word[a, at] ^ word[b, at]
        bits = np.zeros(len(a), np.int64)
        left = different.copy()
        for half in (32, 16, 8):
            empty = (left >> np.uint64(64 - half)) == 0
            bits += np.where(empty, half, 0)
            left = np.where(empty, left << np.uint64(half), left)
        part = np.minimum(np.where(different == 0, 8, bits // 8), np.minimum(size[a, at], size[b, at]))
        shared[1:] = np.where(whole >= width, 8 * width, 8 * whole + part)
        shared[1:] = np.minimum(shared[1:], np.minimum(size[a].sum(axis=1), size[b].sum(axis=1)))
    return picked, shared
