"""Alignment of the tokens of two vocabularies over the same bytes.

Each text is encoded by both. Where a token of A and one of B end at the same byte, the text is cut into groups; the
ends are merged along the merge path. All tokens of A and B in a group are linked. How many texts of the corpus hold
a pair of ids linked is counted for every pair, over all texts.

A block of texts counts its pairs once, whatever the number of its texts that hold them; these counts are
added up, and each block gets the totals of its own pairs back. So what crosses shuffles is one row for each distinct pair of
a block, besides the packed pairs of each text, and no pair is brought to one place however often it occurs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthkit.llm.arrow import arrow_type, slices
from growthkit.llm.bpe import Merges
from growthkit.llm.byte_bpe import ByteTokens
from growthkit.llm.chunk_memo import ChunkMemo
from growthkit.llm.components import stored
from growthkit.llm.merge_path import common
from growthkit.llm.shared import Shared
from growthkit.llm.word_tokens import byte_characters

#: Bytes of text of a block, distinct chunks a worker remembers by vocabulary, and links that are written out at once.
BLOCK, MEMO, LINKS = 16 << 20, 1 << 19, 1 << 20
#: Links from which the ids of a group are counted before they are paired.
LARGE = 1 << 12
SPACE = "▁"


def byte_vocabulary(path: str) -> dict:
    """What workers need of a byte-level vocabulary in a tokenizer file: its text, merges, and the bytes of each id."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    model = json.loads(text)["model"]
    ids = model["vocab"]
    of_character = {c: i for i, c in enumerate(byte_characters())}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = Merges(
        [ids[a] for a, _ in pairs], [ids[b] for _, b in pairs], range(len(pairs)), [ids[a + b] for a, b in pairs]
    )
    first = np.array([ids[c] for c in byte_characters()], np.int32)
    of_id = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        if all(c in of_character for c in token):
            of_id[i] = bytes(of_character[c] for c in token)
    return {"text": text, "merges": merges, "first": first, "bytes": of_id, "odd": {}, "pattern": ""}


def piece_vocabulary(path: str) -> dict:
    """What workers need of a sentencepiece model: its file, and the bytes of each id."""
    import sentencepiece

    with open(path, "rb") as file:
        model = file.read()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [library.id_to_piece(i) for i in range(library.vocab_size())]
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("pieces that reach over a space cannot be sought word by word")
    of_id = [
        bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
    ]
    return {"model": model, "bytes": of_id, "space": library.piece_to_id(SPACE)}


class _ByteLevel(ByteTokens):
    """Byte-level tokens; chunks that its own rules do not cover go to the library."""

    def __init__(self, vocabulary: dict) -> None:
        super().__init__(vocabulary)
        self.limit, self.library = MEMO, None
        self.reset()

    def _hard(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.vocabulary["text"])
            self.library.encode_special_tokens = True
        rows = [self.library.encode(c.decode("utf-8", "replace"), add_special_tokens=False).ids for c in chunks]
        return np.array([i for row in rows for i in row], np.int32), np.fromiter(map(len, rows), np.int64, len(rows))


class _Pieces(ChunkMemo):
    """Pieces of a sentencepiece model. No piece reaches from another character to a space, so each run of spaces with the
    word behind it is encoded alone, once."""

    def __init__(self, vocabulary: dict) -> None:
        super().__init__(MEMO)
        self.vocabulary, self.library = vocabulary, None

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids) of texts that begin with the space which the model adds."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        cut = np.append(True, (data[1:] == 32) & (data[:-1] != 32))
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        ids, before = self.encode(data, starts, np.append(starts[1:], len(data)))
        return ids, before[np.searchsorted(starts, offsets)]

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.library is None:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_proto=self.vocabulary["model"])
        body = data.tobytes()
        chunks = [body[a + 1 : b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        rows = [row or [self.vocabulary["space"]] for row in self.library.encode(chunks, num_threads=1)]
        return np.array([i for row in rows for i in row], np.int32), np.fromiter(map(len, rows), np.int64, len(rows))


class _Side:
    """One vocabulary: its tokens, their bytes and their names in lists of groups."""

    def __init__(self, tokens, of_id: list[bytes], last: str) -> None:
        self.tokens = tokens
        self.size = np.fromiter(map(len, of_id), np.int64, len(of_id))
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(of_id), np.uint8)
        self.names = np.array([f"{i}," for i in range(len(of_id))] + [f"{i}{last}" for i in range(len(of_id))], object)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids, whether each text's tokens join to its bytes)."""
        ids, before = self.tokens.texts(data, offsets)
        size = self.size[ids]
        ends = np.append(0, np.cumsum(size))
        same = np.diff(ends[before]) == np.diff(offsets)
        keep = np.repeat(same, np.diff(before))
        kept, size = ids[keep], size[keep]
        at = np.repeat(self.start[kept] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        given = data[np.repeat(same, np.diff(offsets))]
        wrong = np.append(0, np.cumsum(self.bytes[at] != given))
        length = np.where(same, np.diff(offsets), 0)
        ends = np.cumsum(length)
        return ids, before, same & (wrong[ends] == wrong[ends - length])


def _spaced(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that `keep` marks, each behind a space, and no bytes for the others."""
    size = np.where(keep, np.diff(offsets) + 1, 0)
    ends = np.append(0, np.cumsum(size))
    out = np.full(ends[-1], 32, np.uint8)
    first = np.zeros(ends[-1], bool)
    first[ends[:-1][keep]] = True
    out[~first] = data[np.repeat(keep, np.diff(offsets))]
    return out, ends


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and their sums of counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def links(
    a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, text: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """(text * width**2 + a's id * width + b's id, number of links) of all groups, each key once.

    `n_a` and `n_b` are the numbers of tokens of each group, `text` is its text.
    """
    product = n_a * n_b
    from_a, from_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    found: list[tuple[np.ndarray, np.ndarray]] = []
    small = np.flatnonzero(product <= LARGE)
    cuts = np.append(0, np.flatnonzero(np.diff(np.cumsum(product[small]) // LINKS)) + 1)
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(small)], strict=True):
        some = small[lo:hi]
        group = np.repeat(some, product[some])
        if not len(group):
            continue
        ends = np.cumsum(product[some])
        place = np.arange(ends[-1]) - np.repeat(ends - product[some], product[some])
        left, right = np.divmod(place, n_b[group])
        key = (text[group] * width + a[from_a[group] + left]) * width + b[from_b[group] + right]
        found.append(np.unique(key, return_counts=True))
    for g in np.flatnonzero(product > LARGE).tolist():
        ids_a, times_a = np.unique(a[from_a[g] : from_a[g] + n_a[g]], return_counts=True)
        ids_b, times_b = np.unique(b[from_b[g] : from_b[g] + n_b[g]], return_counts=True)
        step = max(1, LINKS // len(ids_b))
        for at in range(0, len(ids_a), step):
            key = (text[g] * width + ids_a[at : at + step, None].astype(np.int64)) * width + ids_b
            found.append((key.ravel(), np.outer(times_a[at : at + step], times_b).ravel()))
    if len(found) < 2:
        return found[0] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return _summed(*(np.concatenate(x) for x in zip(*found, strict=True)))


class Aligner:
    """Groups and links of the texts of a slice."""

    def __init__(self, vocabularies: tuple[dict, dict]) -> None:
        self.a = _Side(_ByteLevel(vocabularies[0]), vocabularies[0]["bytes"], "|")
        self.b = _Side(_Pieces(vocabularies[1]), vocabularies[1]["bytes"], ";")
        self.width = max(len(self.a.size), len(self.b.size))

    def run(self, data: np.ndarray, offsets: np.ndarray) -> dict:
        """By text n_a, n_b, n_groups, n_links and groups_sha256; `keys`, `counts` as `links` gives them."""
        n = len(offsets) - 1
        data, offsets = _spaced(data, offsets, np.diff(offsets) > 0)
        a, first_a, whole_a = self.a.encode(data, offsets)
        b, first_b, whole_b = self.b.encode(data, offsets)
        keep = whole_a & whole_b & (np.diff(offsets) > 0)
        a, b = (x[np.repeat(keep, np.diff(first))] for x, first in ((a, first_a), (b, first_b)))
        n_a, n_b = (np.where(keep, np.diff(first), 0) for first in (first_a, first_b))
        i, j = common(np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b]))
        in_a, in_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        text = np.searchsorted(np.cumsum(n_a), i + 1)
        keys, counts = links(a, b, in_a, in_b, text, self.width)
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(text, minlength=n),
            "n_links": np.bincount(text, in_a * in_b, minlength=n).astype(np.int64),
            "groups_sha256": self._hashes(a, b, i, j, np.cumsum(n_a + n_b)),
            "keys": keys,
            "counts": counts,
        }

    def _hashes(self, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, ends: np.ndarray) -> list[str]:
        """The hash of each text's groups, whose tokens end at `ends` in the row of all; '' without tokens."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        group_a, group_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        group_a[i], group_b[j] = 1, 1
        name_a, name_b = a + group_a * len(self.a.size), b + group_b * len(self.b.size)
        group_a, group_b = np.cumsum(group_a) - group_a, np.cumsum(group_b) - group_b
        row = np.empty(len(a) + len(b), object)
        row[np.arange(len(a)) + np.append(0, j + 1)[group_a]] = self.a.names[name_a]
        row[np.arange(len(b)) + (i + 1)[group_b]] = self.b.names[name_b]
        out = []
        for lo, hi in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
            out.append(hashlib.sha256("".join(row[lo:hi])[:-1].encode()).hexdigest() if hi > lo else "")
        return out


def _pack(pairs: np.ndarray, counts: np.ndarray, press) -> bytes:
    """Rising pairs and their counts; bytes of equal weight stand together."""
    steps = np.diff(pairs, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T
    return press.compress(steps.tobytes() + counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(packed: bytes, press) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(press.decompress(packed), np.uint8).reshape(2, 8, -1)
    steps, counts = (np.ascontiguousarray(p.T).view("<i8").ravel() for p in planes)
    return np.cumsum(steps), counts


_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def _aligned(shared: Shared, kind: pa.DataType):
    """Texts to rows of texts (packed links) and rows of pairs (pair, docs) of their blocks."""
    schema = pa.schema(
        [("block", pa.int64()), ("id", kind), *((f, pa.int64()) for f in _FIGURES), ("groups_sha256", pa.string())]
        + [("packed", pa.binary()), ("pair", pa.int64()), ("docs", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, press = Aligner(shared.value), zstandard.ZstdCompressor(level=1)
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def table(columns: dict, n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
            )

        def pairs() -> pa.RecordBatch:
            found, docs = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            return table({"block": np.full(len(found), block), "pair": found, "docs": docs}, len(found))

        for rows, data, offsets in slices(batches, "text"):
            out = aligner.run(data, offsets)
            text, pair = np.divmod(out["keys"], aligner.width**2)
            cuts = np.searchsorted(text, np.arange(1, rows.num_rows))
            packed = [
                _pack(p, c, press) if len(p) else b"" for p, c in zip(np.split(pair, cuts), np.split(out["counts"], cuts), strict=True)
            ]
            columns = {f: out[f] for f in [*_FIGURES, "groups_sha256"]}
            id = rows.column(0).to_pylist()
            yield table(columns | {"block": np.full(len(id), block), "id": id, "packed": packed}, len(id))
            held = [_summed(*(np.concatenate(x) for x in zip(*held, np.unique(pair, return_counts=True), strict=True)))]
            size += len(data)
            if size >= BLOCK:
                yield pairs()
                block, held, size = block + 1, [], 0
        if held:
            yield pairs()

    return run


def _judged(kind: pa.DataType):
    """Rows of a block, its pairs (pair, total, best) before its texts, to finished rows of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        names = ["id", *_FIGURES, "n_best", "count_sum", "groups_sha256"]
        block, held, known = None, [], None
        for batch in batches:
            is_pair = batch.column("pair").is_valid().to_numpy(zero_copy_only=False)
            blocks = batch.column("block").to_numpy()
            cuts = np.flatnonzero(np.append(True, (blocks[1:] != blocks[:-1]) | (is_pair[1:] != is_pair[:-1])))
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(blocks)], strict=True):
                part = batch.slice(lo, hi - lo)
                if blocks[lo] != block:
                    block, held, known = blocks[lo], [], None
                if is_pair[lo]:
                    held.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "total", "best")])
                    continue
                if known is None:
                    pair, total, best = (np.concatenate(x) for x in zip(*held, strict=True)) if held else [np.zeros(0, np.int64)] * 3
                    order = np.argsort(pair)
                    known, held = (pair[order], total[order], best[order]), []
                n_best, count_sum = [], []
                for packed in part.column("packed").to_pylist():
                    if not packed:
                        n_best.append(0)
                        count_sum.append(0)
                        continue
                    pairs, counts = _unpack(packed, press)
                    at = np.searchsorted(known[0], pairs)
                    count_sum.append(int((counts * known[1][at]).sum()))
                    n_best.append(int(counts[known[2][at].astype(bool)].sum()))
                columns = [part.column(c) for c in ("id", *_FIGURES)]
                columns += [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), part.column("groups_sha256")]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def token_links(docs: DataFrame, byte_path: str, piece_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A's tokens are those of the byte-level vocabulary `byte_path` for a space and the text, B's those of the
    sentencepiece model `piece_path`; names of special tokens are plain text. Texts that are null, empty, or not the
    join of their tokens' bytes have no tokens: zeros and an empty hash. Every row is a text of its own, also a repeated one; ids
    may be null, other columns are not read.

    What Spark shuffles is described above; a task holds the pairs of one block of 16 MB of text, or of one longer text. Best counts
    of A's ids, one row for each id of the vocabulary, may be broadcast. A Spark job runs when this is called, and its rows stay in
    the shared folder.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    vocabularies = byte_vocabulary(byte_path), piece_vocabulary(piece_path)
    width = max(len(v["bytes"]) for v in vocabularies)
    kind = docs.schema["id"].dataType.simpleString()
    arrow = arrow_type(docs.schema["id"].dataType)
    figures = ", ".join(f"{f} long" for f in _FIGURES)
    schema = f"block long, id {kind}, {figures}, groups_sha256 string, packed binary, pair long, docs long"
    found = stored(docs.mapInArrow(_aligned(Shared(spark, vocabularies), arrow), schema), "links")

    of_block = found.where("pair IS NOT NULL").select("block", "pair", "docs")
    total = of_block.groupBy("pair").agg(F.sum("docs").alias("total"))
    total = stored(total.withColumn("a", F.expr(f"pair div {width}")), "pairs")
    best = total.groupBy("a").agg(F.max("total").alias("most"))
    total = total.join(best, "a").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    back = of_block.select("block", "pair").join(total, "pair")
    texts = found.where("pair IS NULL").drop("docs")
    rows = texts.unionByName(back, allowMissingColumns=True).select("block", *texts.columns[1:], "total", "best")
    rows = rows.repartition("block").sortWithinPartitions("block", F.col("pair").isNull())
    out = rows.mapInArrow(_judged(arrow), f"id {kind}, {figures}, n_best long, count_sum long, groups_sha256 string")
    return out.withColumnRenamed("id", id)
