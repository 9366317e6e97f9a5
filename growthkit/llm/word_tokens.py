"""Token ids of a lower-casing BPE vocabulary with word ends, as its library makes them, many texts at once.

Texts are cut at ASCII white space, over which no token reaches. Each distinct chunk is encoded once while
it is remembered: chunks of ASCII and of the letters to U+00FF with the ranked merges of `bpe`, chunks with
an apostrophe or other characters by the library itself.
"""

from __future__ import annotations

import json

import numpy as np

from growthkit.llm.bpe import Merges
from growthkit.llm.chunk_memo import NO_LETTER, ChunkMemo, gathered, ordered, two_byte
from growthkit.llm.hashing import LOWER, word_bounds


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


def vocabulary(path: str) -> dict:
    """What workers need of a tokenizer file: its text, the merge table and the first symbols of bytes."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    model = json.loads(text)["model"]
    ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = Merges(
        [ids[a] for a, _ in pairs], [ids[b] for _, b in pairs], range(len(pairs)), [ids[a + b] for a, b in pairs]
    )
    names = byte_characters()
    inner = np.array([ids[c] for c in names], np.int32)
    last = np.array([ids[c + suffix] for c in names], np.int32)
    return {"text": text, "merges": merges, "inner": inner, "last": last}


class WordTokens(ChunkMemo):
    def __init__(self, vocabulary: dict) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self.library = None
        self.kind = np.zeros(256, np.int8)  # 1 letter, 2 digit, 0 other
        self.kind[ord("a") : ord("z") + 1] = 1
        self.kind[ord("0") : ord("9") + 1] = 2

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts that `offsets` bounds in `data`, offsets of each text's ids)."""
        starts, ends = word_bounds(data, offsets)
        ids, before = self.encode(LOWER[data], starts, ends)
        return ids, before[np.searchsorted(starts, offsets)]

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat, offsets = gathered(data, starts, ends)
        lead, second, other = two_byte(flat)
        hard = np.maximum.reduceat(other | (flat == ord("'")), offsets[:-1])
        easy, hard = np.flatnonzero(~hard), np.flatnonzero(hard)
        parts = []
        if len(easy):
            flat, offsets = gathered(data, starts[easy], ends[easy])
            parts.append((easy, *self._easy(flat, offsets)))
        if len(hard):
            body = data.tobytes()
            chunks = [body[a:b] for a, b in zip(starts[hard].tolist(), ends[hard].tolist(), strict=True)]
            parts.append((hard, *self._hard(chunks)))
        return ordered(parts, len(starts))

    def _easy(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks of ASCII, without apostrophes, and of U+00C0 to U+00FF, whose capitals stand 32 lower."""
        lead, second, _ = two_byte(data)
        kind = self.kind[data]
        letter = second & ~np.isin(data, NO_LETTER)
        kind[letter] = 1
        kind[:-1][letter[1:]] = 1
        data = np.where(letter & (data < 0x9F), data + 0x20, data)
        new = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == 2)))
        new[offsets[:-1]] = True
        return self._merge(data, np.flatnonzero(new & ~second), offsets)

    def _merge(self, data: np.ndarray, first: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each chunk) from the chunks' bytes and the first bytes of their pieces."""
        symbols = self.vocabulary["inner"][data]
        ends = np.append(first[1:], len(data)) - 1
        symbols[ends] = self.vocabulary["last"][data[ends]]
        ids, before = self.vocabulary["merges"].fold(symbols, np.append(first, len(data)))
        return ids, np.diff(before[np.searchsorted(first, offsets)])

    def _hard(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        rows = [self._by_library(chunk.decode("utf-8", "replace")) for chunk in chunks]
        return np.array([i for row in rows for i in row], np.int32), np.fromiter(map(len, rows), np.int64, len(rows))

    def _by_library(self, text: str) -> list[int]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.vocabulary["text"])
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids
