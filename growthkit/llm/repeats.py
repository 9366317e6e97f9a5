"""Bytes that stand in a string repeated elsewhere, found with anchored suffix arrays.

Every window of `length` bytes belongs to the anchor of its content (`anchors`). The windows of one
anchor in one text form a context; equal windows have equal anchors at equal places, so only contexts
whose anchors are equal need comparing:

* contexts that are equal as a whole are counted by digest; two or more are repeated throughout;
* for the others, contexts of equal anchors are brought to one shard. A shard sorts what follows and,
  reversed, what precedes each anchor in suffix arrays with common prefixes, and reads off which
  windows stand in several contexts;
* an anchor with very many different contexts is dealt to many shards; each lists its windows by
  digest, and equal windows of different shards are found by a join on the digests.

Texts cross a shuffle compressed and by digest, at most twice; contexts cross once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthkit.llm.anchors import GRAM, anchors, digest
from growthkit.llm.arrow import slices
from growthkit.llm.components import stored
from growthkit.llm.hashing import mix, powers
from growthkit.llm.hashing import words as word_hashes
from growthkit.llm.suffix_array import sorted_rows

#: Bytes of contexts whose suffixes one shard sorts at once, and contexts of one anchor it takes.
SHARD_BYTES = 4 << 20
SHARD_CONTEXTS = 4096
#: Bytes that stand for a word when words are compared.
CODE = 8
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            body = memoryview(data.tobytes())
            out: list[list] = [[], [], [], [], [], []]
            for tid, lo, hi in zip(rows.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                if hi - lo < length:
                    continue
                first, last, place = anchors(data[lo:hi], length)
                before = None
                for a, e, p in zip((first + lo).tolist(), (last + lo).tolist(), (place + lo).tolist(), strict=True):
                    gram = digest(body, p, p + GRAM)
                    context = digest(body, a, e + length, p - a + 1)
                    if before == (gram, context):
                        out[4][-1] = e + length - lo
                        out[5][-1] += 1
                        continue
                    before = (gram, context)
                    for column, value in zip(out, (gram, context, tid, a - lo, e + length - lo, 1), strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 3 + [pa.int32()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["gram", "context", "tid", "lo", "hi", "n"]
            )

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for rows, data, offsets in slices(batches, "text"):
        body = data.tobytes()
        packed = [press.compress(body[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        kept = [i for i, name in enumerate(rows.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(i) for i in kept), pa.array(packed, pa.binary())],
            [*(rows.schema.names[i] for i in kept), "packed"],
        )


def _cut_out(length: int):
    """Rows (packed, wanted contexts) in, one row for each wanted context out, its bytes with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(batch.num_rows):
                text = press.decompress(batch.column(0)[at].as_py())
                wanted = batch.column(1)[at].values
                rows = [wanted.field(name).to_pylist() for name in ("gram", "context", "n", "many", "lo", "hi")]
                spans = list(zip(rows[4], rows[5], strict=True))
                places = [int(anchors(np.frombuffer(text[a:b], np.uint8), length)[2][0]) for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[0], pa.int64()),
                        pa.array(rows[1], pa.int64()),
                        pa.array(rows[2], pa.int64()),
                        pa.array(rows[3], pa.bool_()),
                        pa.array(places, pa.int32()),
                        pa.array([text[a:b] for a, b in spans], pa.binary()),
                    ],
                    ["gram", "context", "n", "many", "place", "bytes"],
                )

    return run


def _repeated(group: np.ndarray, place: np.ndarray, rows: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) start of the windows of each row that another row of its group also has; (-1, -1) if none."""
    left = [r[:p][::-1] for r, p in zip(rows, place.tolist(), strict=True)]
    right = [r[p:] for r, p in zip(rows, place.tolist(), strict=True)]
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    by_group = np.unique(group, return_inverse=True)[1]
    first = np.full(len(rows), -1, np.int64)
    last = np.full(len(rows), -1, np.int64)
    sides = []
    for side in (left, right):
        # the group goes first, so that rows of a group stand together
        keyed = [int(g).to_bytes(8, "big") + r for g, r in zip(by_group, side, strict=True)]
        order, shared = sorted_rows(keyed, 1 + -(-length // 8))
        sides.append((order, shared - 8))
    every = np.arange(len(rows), dtype=np.int64)
    for before in range(length - GRAM + 1):
        start = place - before
        inside = (start >= 0) & (start + length <= size)
        if not inside.any():
            continue
        key = np.zeros(len(rows), np.int64)
        for (order, shared), depth in zip(sides, (before, length - before), strict=True):
            of = np.empty(len(rows), np.int64)
            of[order] = np.cumsum(shared < depth)
            key = key * np.int64(len(rows) + 1) + of
        here = every[inside]
        _, inverse, count = np.unique(key[here], return_inverse=True, return_counts=True)
        here = here[count[inverse] > 1]
        last[here] = np.maximum(last[here], start[here])
        first[here] = np.where(first[here] < 0, start[here], np.minimum(first[here], start[here]))
    return first, last


def _in_shards(length: int, shard_bytes: int):
    """Contexts in order of their anchors in; the repeated part of those that are not repeated as a whole out."""

    def of_shard(table: pa.Table) -> pa.RecordBatch:
        gram, context, n, place = (table.column(c).to_numpy() for c in ("gram", "context", "n", "place"))
        _, once = np.unique(np.stack((gram, context)), axis=1, return_index=True)
        rows = table.column("bytes").take(pa.array(once)).to_pylist()
        gram, context, n, place = gram[once], context[once], n[once], place[once].astype(np.int64)
        first, last = _repeated(gram, place, rows, length)
        keep = (first >= 0) & (n == 1)
        columns = [gram[keep], context[keep], first[keep].astype(np.int32), (last[keep] + length).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "context", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            gram = batch.column(0).to_numpy()
            ends = [*(np.flatnonzero(gram[1:] != gram[:-1]) + 1).tolist(), batch.num_rows]
            at = 0
            for end in ends:
                if held and size >= shard_bytes and held[-1].column(0)[-1].as_py() != gram[at]:
                    yield of_shard(pa.Table.from_batches(held))
                    held, size = [], 0
                if end > at:
                    held.append(batch.slice(at, end - at))
                    lengths = batch.column(5).slice(at, end - at)
                    size += sum(len(x.as_buffer()) for x in lengths)
                at = end
        if held:
            yield of_shard(pa.Table.from_batches(held))

    return run


def _windows(length: int):
    """One row for each window of a context: its digest and its start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, context, n, place = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
            for i in range(batch.num_rows):
                body = memoryview(batch.column(5)[i].as_py())
                starts = range(len(body) - length + 1)
                hashes = [digest(body, s, s + length, place[i] - s) for s in starts]
                k = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([gram[i]] * k, pa.int64()),
                        pa.array([context[i]] * k, pa.int64()),
                        pa.array([n[i]] * k, pa.int64()),
                        pa.array(hashes, pa.int64()),
                        pa.array(starts, pa.int32()),
                    ],
                    ["gram", "context", "n", "window", "start"],
                )

    return run


def repeated_spans(
    docs: DataFrame, text: str, length: int, shard_bytes: int = SHARD_BYTES, shard_contexts: int = SHARD_CONTEXTS
) -> DataFrame:
    """(tid, spans): for each distinct text with a repeated string of `length` bytes, by its digest
    (`text_digest`), the byte spans that such strings cover; spans may overlap. Jobs run when called."""
    texts = docs.select(text_digest(text).alias("tid"), F.col(text).alias("text"))
    found = texts.mapInArrow(_contexts(length), "gram long, context long, tid long, lo int, hi int, n int")
    found = stored(found, "contexts")
    distinct = found.groupBy("gram", "context").agg(
        F.sum("n").alias("n"), F.first("tid").alias("tid"), F.first("lo").alias("lo"), F.first("hi").alias("hi")
    )
    distinct = stored(distinct, "distinct")
    of_gram = distinct.groupBy("gram").agg(F.count("*").alias("contexts"), F.min("n").alias("least"))
    of_gram = of_gram.where("contexts > 1 AND least = 1").select("gram", (F.col("contexts") > shard_contexts).alias("many"))
    wanted = distinct.join(of_gram, "gram").groupBy("tid").agg(
        F.collect_list(F.struct("gram", "context", "n", "many", "lo", "hi")).alias("wanted")
    )
    # one row for each distinct text, however many rows hold it
    packed = texts.mapInArrow(_pack, "tid long, packed binary").groupBy("tid").agg(F.first("packed").alias("packed"))
    packed = packed.join(wanted, "tid").select("packed", "wanted")
    kind = "gram long, context long, n long, many boolean, place int, bytes binary"
    cut = stored(packed.mapInArrow(_cut_out(length), kind), "cut")

    few = cut.where("NOT many").repartition(F.col("gram")).sortWithinPartitions("gram")
    partial = "gram long, context long, `from` int, `to` int"
    partly = few.mapInArrow(_in_shards(length, shard_bytes), partial)
    windows = cut.where("many").dropDuplicates(["gram", "context"]).mapInArrow(
        _windows(length), "gram long, context long, n long, window long, start int"
    )
    repeated = windows.groupBy("window", "gram").agg(F.count("*").alias("rows")).where("rows > 1").select("window", "gram")
    merged = windows.where("n = 1").join(repeated, ["window", "gram"]).groupBy("gram", "context").agg(
        F.min("start").alias("from"), (F.max("start") + length).alias("to")
    )
    whole = distinct.where("n > 1").select("gram", "context", F.lit(0).alias("from"), F.lit(None).cast("int").alias("to"))
    covered = found.drop("n").join(whole.unionByName(partly).unionByName(merged), ["gram", "context"])
    lo, hi = F.col("lo") + F.col("from"), F.coalesce(F.col("lo") + F.col("to"), F.col("hi"))
    return covered.groupBy("tid").agg(F.collect_set(F.struct(lo.alias("lo"), hi.alias("hi"))).alias("spans"))


def _short_words(words: int, length: int):
    """(tid, text) in; out each stretch of a text in which every word is one of `words` in a row that take fewer
    than `length` bytes: its words as CODE characters each, and their starts and ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            body = data.tobytes()
            out: list[list] = [[], [], [], []]
            for tid, lo, hi in zip(rows.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                inside = np.concatenate(([False], ~_SPACE[data[lo:hi]], [False]))
                edges = np.flatnonzero(inside[1:] != inside[:-1])
                starts, ends = edges[::2], edges[1::2]
                if len(starts) < words:
                    continue
                short = np.flatnonzero(ends[words - 1 :] - starts[: len(starts) - words + 1] < length)
                if not len(short):
                    continue
                step = np.zeros(len(starts) + 1, np.int64)
                step[short] += 1
                step[short + words] -= 1
                taken = np.concatenate(([False], np.cumsum(step[:-1]) > 0, [False]))
                edges = np.flatnonzero(taken[1:] != taken[:-1])
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    spans = zip((starts[a:b] + lo).tolist(), (ends[a:b] + lo).tolist(), strict=True)
                    code = base64.b64encode(b"".join(xxhash.xxh3_64_digest(body[x:y])[:6] for x, y in spans))
                    for column, value in zip(out, (tid, code.decode(), starts[a:b], ends[a:b]), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["tid", "code", "starts", "ends"]
            )

    return run


def repeated_words(docs: DataFrame, text: str, words: int, length: int, **shard: int) -> DataFrame:
    """(tid, spans) like `repeated_spans`, of strings of `words` words that take fewer than `length` bytes.

    A word is a run of other bytes than space and \\t to \\r; words are compared by 48-bit hashes, white space
    between them is not.
    """
    texts = docs.select(text_digest(text).alias("tid"), F.col(text).alias("text"))
    kind = "tid long, code string, starts array<int>, ends array<int>"
    short = stored(texts.mapInArrow(_short_words(words, length), kind), "short")
    spans = repeated_spans(short, "code", CODE * words, **shard).withColumnRenamed("tid", "cid")
    found = short.withColumn("cid", text_digest("code")).join(spans, "cid").selectExpr("tid", "starts", "ends", "inline(spans)")
    found = found.selectExpr("tid", "starts", "ends", f"int(ceil(lo / {CODE})) AS a", f"int(floor(hi / {CODE})) AS b")
    found = found.where(F.col("b") - F.col("a") >= words).selectExpr("tid", "struct(starts[a] AS lo, ends[b - 1] AS hi) AS span")
    return found.groupBy("tid").agg(F.collect_set("span").alias("spans"))


def _sampled_strings(words: int, string: int):
    """(tid, text) in; out (tid, string, at) of strings of `string` words, at least one of every `words` words in a row.

    Of the strings in each `words` words the one with the smallest hash is taken, the last of equal ones; equal words give equal choices.
    """
    reach = words - string + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            hashes, first = word_hashes(data, offsets, lower=False)
            up, down = powers(len(hashes) + 1)
            running = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(mix(hashes) * up[:-1], out=running[1:])
            starts = np.arange(max(0, len(hashes) - string + 1))
            found = mix((running[starts + string] - running[starts]) * down[starts])
            tids, out = rows.column(0).to_numpy(), ([], [], [])
            for tid, lo, hi in zip(tids.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                if hi - lo < words:
                    continue
                own = found[lo : hi - string + 1]
                around = np.lib.stride_tricks.sliding_window_view(own, reach)
                at = np.unique(np.arange(len(around)) + reach - 1 - around[:, ::-1].argmin(axis=1))
                for column, value in zip(out, (np.full(len(at), tid), own[at].astype(np.int64), at.astype(np.int32)), strict=True):
                    column.append(value)
            kinds = (np.int64, np.int64, np.int32)
            columns = [pa.array(np.concatenate(c) if c else np.zeros(0, k)) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["tid", "string", "at"])

    return run


def shared_strings(docs: DataFrame, text: str, words: int = 50, string: int = 32) -> DataFrame:
    """(tid, n_shared): for each distinct text, how many of its sampled strings of `string` words also stand elsewhere.

    A passage of `words` words that stands in two places, in whatever surroundings and however few bytes it takes, always has such a
    string; a shorter one may. Words are runs of other bytes than space and \t to \r; texts without such strings are left out.
    """
    texts = docs.select(text_digest(text).alias("tid"), F.col(text).alias("text"))
    found = texts.mapInArrow(_sampled_strings(words, string), "tid long, string long, at int")
    found = stored(found, "strings")
    often = found.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
    return found.join(often, "string").select("tid", "at").distinct().groupBy("tid").agg(F.count("*").alias("n_shared"))


def text_digest(text: str) -> Column:
    """Null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _merged(spans: pa.Scalar) -> list[tuple[int, int]]:
    if not spans.is_valid or not len(spans.values):
        return []
    lo, hi = (spans.values.field(x).to_numpy() for x in ("lo", "hi"))
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate(([True], lo[1:] > reach[:-1]))
    starts = np.flatnonzero(new)
    ends = np.concatenate((starts[1:] - 1, [len(lo) - 1]))
    return list(zip(lo[starts].tolist(), reach[ends].tolist(), strict=True))


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        rows: list[tuple] = []
        for at in range(batch.num_rows):
            body = press.decompress(batch.column(1)[at].as_py())
            spans = _merged(batch.column(2)[at])
            sha, done = hashlib.sha256(), 0
            for lo, hi in spans:
                sha.update(body[done:lo])
                done = hi
            sha.update(body[done:])
            rows.append((len(body), sum(hi - lo for lo, hi in spans), len(spans), sha.hexdigest()))
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        kinds = [pa.int64()] * 3 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), batch.column(3)],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared"],
        )


def repeated_bytes(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 400, shared: bool = False, **shard: int
) -> DataFrame:
    """Per row of `docs`: id, n_bytes, n_removed, n_spans, kept_sha256, and with `shared` n_shared.

    A text is its UTF-8 bytes; a byte is removed if it stands in a string of `length` bytes that also starts
    at any other place of any text, its own included. Strings are judged on the input. n_spans counts the
    maximal removed runs; kept_sha256 is of the bytes left, concatenated. n_shared counts strings of 32 words that also stand
    elsewhere (`shared_strings`): it is above 0 wherever a passage of fifty words is repeated, also one of fewer than `length`
    bytes, which loses nothing. Null counts as empty; a text shorter than `length` loses nothing. Repeated rows are copies of each other, ids are only carried, and
    other columns are not read. Spark jobs run when this is called.
    """
    spans = repeated_spans(docs, text, length, **shard)
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), text_digest(text).alias("tid"), F.col(text).alias("text"))
    rows = rows.mapInArrow(_pack, f"id {kind}, tid long, packed binary").join(spans, "tid", "left")
    rows = rows.join(shared_strings(docs, text), "tid", "left") if shared else rows.withColumn("n_shared", F.lit(0))
    out = rows.select("id", "packed", "spans", F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared")).mapInArrow(
        _report, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long"
    )
    return (out if shared else out.drop("n_shared")).withColumnRenamed("id", id)


def _whole_characters(body: bytes, spans: list[tuple[int, int]]) -> str:
    """`body` without `spans`; a character that is only partly inside a span stays."""
    out, done = [], 0
    for lo, hi in spans:
        while lo < hi and (body[lo] & 0xC0) == 0x80:
            lo += 1
        while hi > lo and hi < len(body) and (body[hi] & 0xC0) == 0x80:
            hi -= 1
        out.append(body[done:lo])
        done = hi
    out.append(body[done:])
    return b"".join(out).decode("utf-8", "replace")


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        packed, spans = (batch.column(batch.schema.get_field_index(c)) for c in ("packed", "spans"))
        texts = [
            _whole_characters(press.decompress(packed[i].as_py()), _merged(spans[i])) for i in range(batch.num_rows)
        ]
        kept = [i for i, name in enumerate(batch.schema.names) if name not in ("packed", "spans")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in kept), pa.array(texts, pa.string())],
            [*(batch.schema.names[i] for i in kept), "stripped"],
        )


def without_repeats(
    docs: DataFrame, text: str = "text", length: int = 400, words: int | None = None, **shard: int
) -> DataFrame:
    """`docs` with the repeated bytes taken out of `text`, as `repeated_bytes` judges them.

    With `words`, repeated strings of so many words are taken out too if they take fewer than `length` bytes.
    A character at the border of a removed run stays if any of its bytes does. A null text stays null. All
    columns and their order stay. Spark jobs run when this is called.
    """
    spans = repeated_spans(docs, text, length, **shard)
    if words is not None:
        spans = spans.unionByName(repeated_words(docs, text, words, length, **shard))
        spans = spans.groupBy("tid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("rest"),
        F.col(text).isNull().alias("missing"),
        text_digest(text).alias("tid"),
        F.col(text).alias("text"),
    )
    kind = rows.schema["rest"].dataType.simpleString()
    kind = f"rest {kind}, missing boolean"
    rows = rows.mapInArrow(_pack, f"{kind}, tid long, packed binary").join(spans, "tid", "left")
    rows = rows.select("rest", "missing", "packed", "spans").mapInArrow(_strip, f"{kind}, stripped string")
    whole = F.when(~F.col("missing"), F.col("stripped"))
    return rows.select(*[whole.alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
