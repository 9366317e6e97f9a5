"""Packing of documents into windows of a fixed number of tokens by the sum-of-squares rule.

A partition packs its documents one after another. What a document has beyond full windows goes to the
fill level that makes the sum of squares of the numbers of open windows by level smallest. Of the windows still
open at the end, the emptiest are cut up to fill the others, the rest of them at powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthkit.llm.arrow import arrow_type, slices
from growthkit.llm.shared import Shared
from growthkit.llm.word_tokens import WordTokens, vocabulary

#: Tokens of a window, and the id that ends a document.
WINDOW, END = 2048, 1
COLUMNS = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Packer:
    """The open windows of one partition; `rows` collects placed pieces.

    Open windows keep the ids of their pieces, in two bytes each where the vocabulary allows it.
    """

    def __init__(self, window: int, first_sequence: int) -> None:
        self.window = window
        self.next = first_sequence
        self.count = np.zeros(window + 1, np.int64)  # open windows by fill level
        self.open: list[list] = [[] for _ in range(window)]
        self.rows: list[tuple] = []

    def add(self, id, ids: np.ndarray) -> None:
        """Pack one document with all its ids."""
        whole = len(ids) - len(ids) % self.window
        for at in range(0, whole, self.window):
            self._close([(id, at, ids[at : at + self.window], len(ids))])
        if whole < len(ids):
            tail = ids[whole:]
            tail = tail.astype(np.uint16) if tail.max() < 1 << 16 else tail.copy()
            self._place((id, whole, tail, len(ids)))

    def level(self, size: int) -> int:
        """The fill level, 0 for a new window, whose change of the sum of squares is smallest; the fullest on ties."""
        room = self.window - size
        change = np.where(self.count[: room + 1] > 0, 1 - 2 * self.count[: room + 1], 1 << 40)
        change[0] = 0
        change[:room] += 1 + 2 * self.count[size : self.window]
        return room - int(change[::-1].argmin())

    def _place(self, piece: tuple) -> None:
        size = len(piece[2])
        level = self.level(size)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
        pieces.append(piece)
        if level + size == self.window:
            self._close(pieces)
        else:
            self.open[level + size].append(pieces)
            self.count[level + size] += 1

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for id, start, ids, total in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.rows.append((id, start, len(ids), crc, total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def finish(self) -> None:
        """Close all windows without padding.

        The fullest open windows stay as the rule filled them; the emptiest are taken apart, and their pieces, cut
        where needed, fill the others up. The last of them make windows of powers of two.
        """
        windows = [pieces for level in reversed(self.open) for pieces in level]
        self.open = [[] for _ in range(self.window)]
        self.count[:] = 0
        loose: list[tuple] = []
        at, end = 0, len(windows)
        while at < end:
            pieces, room = windows[at], self.window - sum(len(p[2]) for p in windows[at])
            while room and (loose or end > at + 1):
                if not loose:
                    end -= 1
                    loose = windows[end][::-1]
                room -= self._cut(loose, room, pieces)
            if room:
                loose = pieces[::-1]
            else:
                self._close(pieces)
            at += 1
        left = sum(len(p[2]) for p in loose)
        while left:
            pieces, room = [], 1 << (left.bit_length() - 1)
            left -= room
            while room:
                room -= self._cut(loose, room, pieces)
            self._close(pieces)

    @staticmethod
    def _cut(loose: list[tuple], room: int, pieces: list[tuple]) -> int:
        """Move the last of `loose`, or as much of it as there is room for, to `pieces`; the number of ids moved."""
        id, start, ids, total = loose.pop()
        if len(ids) > room:
            loose.append((id, start + room, ids[room:], total))
        pieces.append((id, start, ids[:room], total))
        return min(room, len(ids))


def _pack(shared, kind: pa.DataType, window: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(shared.value)
        packer = Packer(window, TaskContext.get().partitionId() << 40)

        def flush() -> pa.RecordBatch:
            columns = list(zip(*packer.rows, strict=True)) if packer.rows else [[] for _ in COLUMNS]
            packer.rows = []
            kinds = [kind] + [pa.int64()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], COLUMNS)

        for rows, data, offsets in slices(batches, "text"):
            ids, ends = tokens.texts(data, offsets)
            ends = ends.tolist()
            for id, a, b in zip(rows.column(0).to_pylist(), ends[:-1], ends[1:], strict=True):
                packer.add(id, np.append(ids[a:b], np.int32(end)))
            yield flush()
        packer.finish()
        yield flush()

    return run


def packed(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END
) -> DataFrame:
    """Per piece of a document: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The ids of a text are those of the file `tokenizer` without special tokens, then `end`. A document's
    ids lie in its pieces, each once; a sequence holds `window` ids, or a smaller power of two (at most one
    of each power in a partition). A null or empty text is the one id `end`. Repeated rows are packed as
    often as they stand, an id may be null, and other columns are not read.

    Nothing is shuffled: each partition packs its own rows in their order, and sequence_id starts with the
    partition's number, so that a task run again after a loss gives the same rows. `docs` must therefore have
    the same rows in the same order when a task is repeated, as files have. A task holds the ids of its open windows,
    at most those of its partition's documents beyond full windows.
    """
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    shared = Shared(docs.sparkSession, vocabulary(tokenizer))  # its size is the vocabulary's
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return docs.mapInArrow(_pack(shared, arrow_type(docs.schema["id"].dataType), window, end), schema).withColumnRenamed("id", id)
