"""Byte-level BPE by ranked merges: encoding, and decoding by concatenating the pieces of ids.

`fold_words` is the fold in Spark's higher-order functions over distinct words, with the ranks as a literal. It
gives right results, but putting the words of every text back together costs a shuffle of all word
occurrences, several times the input (figures in the README). `encoded` therefore runs the same fold of
ranked merges in numpy where the texts are, over the distinct chunks of a slice of texts, and remembers them.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthkit.llm.arrow import slices
from growthkit.llm.bpe import Merges
from growthkit.llm.chunk_memo import NO_LETTER, ChunkMemo, gathered, ordered, two_byte
from growthkit.llm.hashing import IS_SPACE
from growthkit.llm.shared import Shared


def rank_file(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def vocabulary(path: str, pattern: str) -> dict:
    """What workers need: the merge table, the id of each byte, the bytes of each id, and the split pattern.

    A piece that is a token as a whole is that token. `odd` holds the tokens that the merges do not reach.
    """
    ranks = rank_file(path)
    left, right, merged = [], [], []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                merged.append(rank)
    merges = Merges(left, right, merged, merged)
    first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    tokens = list(ranks)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int64)
    ids, before = merges.fold(first[np.frombuffer(b"".join(tokens), np.uint8)], offsets)
    whole = (np.diff(before) == 1) & (ids[before[:-1]] == np.array([ranks[t] for t in tokens]))
    odd = {t: ranks[t] for t, same in zip(tokens, whole.tolist(), strict=True) if not same}
    of_id = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        of_id[rank] = token
    return {"merges": merges, "first": first, "bytes": of_id, "odd": odd, "pattern": pattern}


class ByteTokens(ChunkMemo):
    def __init__(self, vocabulary: dict) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self.pattern = regex.compile(vocabulary["pattern"])
        self.kind = np.zeros(256, np.int8)  # 1 letter, 2 digit, 3 white space, 0 other
        for a, b, kind in (("a", "z", 1), ("A", "Z", 1), ("0", "9", 2)):
            self.kind[ord(a) : ord(b) + 1] = kind
        self.kind[IS_SPACE] = 3

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts that `offsets` bounds in `data`, offsets of each text's ids).

        A text is cut before every space that a byte of no white space follows; there the split pattern always
        starts a new piece. Bytes that may begin other white space are never cut off.
        """
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        follows = data[1:]
        cut = np.append((data[:-1] == 32) & ~IS_SPACE[follows] & ~np.isin(follows, (0xC2, 0xE1, 0xE2, 0xE3)), False)
        cut[offsets[1:-1][offsets[1:-1] > 0] - 1] = False  # a space that ends a text
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        ids, before = self.encode(data, starts, np.append(starts[1:], len(data)))
        return ids, before[np.searchsorted(starts, offsets)]

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat, offsets = gathered(data, starts, ends)
        _, _, other = two_byte(flat)
        space = self.kind[flat] == 3
        space[offsets[:-1]] &= (flat[offsets[:-1]] != 32) | (np.diff(offsets) == 1)
        hard = np.maximum.reduceat(other | space | (flat == ord("'")), offsets[:-1])
        easy, hard = np.flatnonzero(~hard), np.flatnonzero(hard)
        parts = []
        if len(easy):
            parts.append((easy, *self._easy(*gathered(data, starts[easy], ends[easy]))))
        if len(hard):
            body = data.tobytes()
            chunks = [body[a:b] for a, b in zip(starts[hard].tolist(), ends[hard].tolist(), strict=True)]
            parts.append((hard, *self._hard(chunks)))
        return ordered(parts, len(starts))

    def _easy(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, second, _ = two_byte(data)
        kind = self.kind[data]
        letter = second & ~np.isin(data, NO_LETTER)
        kind[letter] = 1
        kind[:-1][letter[1:]] = 1
        new = np.concatenate(([True], (kind[1:] != kind[:-1]) & (kind[:-1] != 3)))
        new[offsets[:-1]] = True
        return self._merge(data, np.flatnonzero(new & ~second), offsets)

    def _hard(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [[p.encode() for p in self.pattern.findall(c.decode("utf-8", "replace"))] for c in chunks]
        pieces = [p for row in found for p in row]
        first = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)
        offsets = first[np.concatenate(([0], np.cumsum([len(row) for row in found])))]
        return self._merge(np.frombuffer(b"".join(pieces), np.uint8), first[:-1], offsets)

    def _merge(self, data: np.ndarray, first: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each chunk) from the chunks' bytes and the first bytes of their pieces."""
        bounds = np.append(first, len(data))
        ids, before = self.vocabulary["merges"].fold(self.vocabulary["first"][data], bounds)
        if odd := self.vocabulary["odd"]:
            body = data.tobytes()
            rows = [
                np.array([odd[piece]], np.int32) if (piece := body[a:b]) in odd else ids[c:d]
                for a, b, c, d in zip(bounds[:-1], bounds[1:], before[:-1], before[1:], strict=True)
            ]
            ids, before = np.concatenate(rows), np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        return ids, np.diff(before[np.searchsorted(first, offsets)])


def _report(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens(shared.value)
        of_id = tokens.vocabulary["bytes"]
        names = [str(i) for i in range(len(of_id))]
        for rows, data, offsets in slices(batches, "text"):
            ids, ends = tokens.texts(data, offsets)
            counts, id_hash, text_hash = [], [], []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                own = ids[a:b].tolist()
                counts.append(b - a)
                id_hash.append(hashlib.sha256(",".join(map(names.__getitem__, own)).encode()).hexdigest())
                text_hash.append(hashlib.sha256(b"".join(map(of_id.__getitem__, own))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(counts, pa.int64()), pa.array(id_hash), pa.array(text_hash)],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _ids(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens(shared.value)
        for rows, data, offsets in slices(batches, "text"):
            ids, ends = tokens.texts(data, offsets)
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([rows.column(0), column], ["id", "ids"])

    return run


def _shared(docs: DataFrame, path: str, pattern: str) -> Shared:
    return Shared(docs.sparkSession, vocabulary(path, pattern))  # its size is the vocabulary's


def encode(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids): the token ids of each text by the ranks of the file `path`, without special tokens.

    Null and empty texts have no ids. Each row is encoded alone and in whole; repeated rows give repeated
    results, ids may be null, other columns are not read. Nothing is shuffled.
    """
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    out = docs.mapInArrow(_ids(_shared(docs, path, pattern)), f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id)


def decode(rows: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, bytes): the pieces of the ids of each row, concatenated. A null list gives null bytes."""
    of_id = {rank: token for token, rank in rank_file(path).items()}
    shared = rows.sparkSession.sparkContext.broadcast([of_id.get(i, b"") for i in range(max(of_id) + 1)])
    kind = rows.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if x is None else b"".join(map(shared.value.__getitem__, x)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["id", "bytes"])

    return rows.select(F.col(id).alias("id"), ids).mapInArrow(run, f"id {kind}, bytes binary").withColumnRenamed("id", id)


def token_report(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: id, n_tokens, ids_sha256 of the decimal ids joined by commas, decoded_sha256 of the
    bytes that the ids decode to. Rows are treated as `encode` does."""
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.mapInArrow(_report(_shared(docs, path, pattern)), schema).withColumnRenamed("id", id)


def fold_words(words: DataFrame, word: str, path: str, buckets: int = 1 << 14) -> DataFrame:
    """`words` with `ids`: the ids of each piece of text in the column `word`, by built-in functions only.

    The ranks are a literal: an array of small maps, found by a hash of the bytes, because a lookup in one
    map of the whole vocabulary reads all of it. Every step of the fold merges the leftmost pair of lowest rank.
    """
    ranks = rank_file(path)
    spark = words.sparkSession
    listed = spark.createDataFrame([(bytearray(t), r) for t, r in ranks.items()], "t binary, r int")
    hashed = listed.selectExpr(f"pmod(xxhash64(t), {buckets}) AS h", "hex(t) AS t", "r").collect()
    maps: list[dict] = [{} for _ in range(buckets)]
    for h, t, r in hashed:
        maps[h][t] = r
    literal = F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")

    def rank(piece):
        return F.try_element_at(F.get(literal, F.pmod(F.xxhash64(piece), F.lit(buckets))), F.hex(piece))

    def merged(pieces):
        pairs = F.transform(
            F.sequence(F.lit(1), F.size(pieces) - 1),
            lambda i: rank(F.concat(F.get(pieces, i - 1), F.get(pieces, i))),
        )

        def at(place):
            return F.concat(
                F.slice(pieces, F.lit(1), place - 1),
                F.array(F.concat(F.get(pieces, place - 1), F.get(pieces, place))),
                F.slice(pieces, place + 2, F.size(pieces)),
            )

        def lowest(found):
            return F.when(F.array_min(found).isNull(), pieces).otherwise(
                at(F.array_position(found, F.array_min(found)).cast("int"))
            )

        step = F.get(F.transform(F.array(pairs), lowest), F.lit(0))
        return F.when(F.size(pieces) < 2, pieces).otherwise(step)

    body = F.encode(F.col(word), "utf-8")
    one_by_one = F.transform(F.sequence(F.lit(1), F.octet_length(body)), lambda i: F.substring(body, i, F.lit(1)))
    steps = F.sequence(F.lit(1), F.octet_length(body))
    folded = F.aggregate(steps, one_by_one, lambda pieces, _: merged(pieces))
    whole = rank(body)
    ids = F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, rank))
    return words.withColumn("ids", F.when(F.octet_length(body) > 0, ids).otherwise(F.array().cast("array<int>")))
