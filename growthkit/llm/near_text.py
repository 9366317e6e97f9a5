"""Near-duplicate texts by SuperMinHash: signatures, banding, verification on full sets, union.

Texts with the same shingle set are one node from the start, so exact copies cost one row each.
Bands of equal signature ranks make buckets. Candidates are compared in two rounds:

1. every node with the smallest node of each of its buckets;
2. where a bucket still holds several components, its nodes in different components by their
   signatures, block against block inside tasks; then those with a candidate, and only those with their
   texts, by their sets. Only nodes and links leave a task, never pairs that are not linked.

Pairs in one component are not compared again, and pairs whose set sizes rule out a link never.
Every candidate is confirmed on the full shingle sets, recomputed from the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthkit.llm.arrow import slices, text_buffers
from growthkit.llm.components import components, stored
from growthkit.llm.hashing import shingles, words
from growthkit.llm.superminhash import bands, signatures

#: 42 bands of 6 of 252 slots miss a pair of similarity 0.8 with probability 3e-6.
BANDS, ROWS = 42, 6
#: Second round: a pair is confirmed if its signatures agree to within this of the threshold (over
#: four standard errors of 252 slots).
SLACK = 0.1
#: Members of a bucket that are compared in one place, and bytes of their sets that are held at once.
BLOCK, SET_BYTES = 1024, 1 << 26


def _sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    return shingles(*words(data, offsets), k)


def _sign(k: int, n_bands: int, n_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            sets = _sets(data, offsets, k)
            ranks = signatures(sets, n_bands * n_rows)
            hashes = bands(ranks, n_rows)
            marks = (ranks % np.uint64(251)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([h if len(s) else None for s, h in zip(sets, hashes, strict=True)], pa.list_(pa.int64())),
                    pa.array([m.tobytes() if len(s) else None for s, m in zip(sets, marks, strict=True)], pa.binary()),
                ],
                ["id", "n", "key", "bands", "marks"],
            )

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for rows, data, offsets in slices(batches, "text"):
        body = data.tobytes()
        packed = [press.compress(body[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(packed, pa.binary())], ["id", "packed"])


def _unpacked_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    press = zstandard.ZstdDecompressor()
    texts = [press.decompress(x) for x in column.to_pylist()]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in texts]))).astype(np.int64)
    return _sets(np.frombuffer(b"".join(texts), np.uint8), offsets, k)


def _linked(one: np.ndarray, two: np.ndarray, top: int, bottom: int) -> bool:
    if len(one) > len(two):
        one, two = two, one
    both = int((two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one).sum())
    return bottom * both >= top * (len(one) + len(two) - both)


def _confirm(k: int, top: int, bottom: int):
    """Rows (a, b, packed a, packed b) in, linked (a, b) out; neighbours in order of b share its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ours = _unpacked_sets(part.column(2), k)
                keep = []
                for i, packed in enumerate(part.column(3)):
                    packed = packed.as_py()
                    if packed != last:
                        last, last_set = packed, _unpacked_sets(pa.array([packed]), k)[0]
                    keep.append(_linked(ours[i], last_set, top, bottom))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], ["a", "b"])

    return run


class _Search:
    """One run: the signed texts and the steps that need them."""

    def __init__(self, docs, id, text, k, similarity, n_bands, n_rows) -> None:
        self.k, self.similarity = k, similarity
        docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
        self.kind = docs.schema["id"].dataType.simpleString()
        signed = docs.mapInArrow(_sign(k, n_bands, n_rows), f"id {self.kind}, n long, key binary, bands array<long>, marks binary")
        self.docs, self.signed = docs, stored(signed, "signed")

    def nodes(self) -> DataFrame:
        """(node, key, n, bands, marks), one row for each distinct set; the node is its smallest id."""
        found = self.signed.where("key IS NOT NULL AND id IS NOT NULL").groupBy("key").agg(
            F.min("id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("marks").alias("marks")
        )
        return stored(found, "nodes")

    def packed(self, nodes: DataFrame) -> DataFrame:
        """(node, packed): the compressed texts of `nodes`."""
        wanted = nodes.select(F.col("node").alias("id")).distinct()
        found = self.docs.mapInArrow(_pack, f"id {self.kind}, packed binary").join(wanted, "id")
        return stored(found.withColumnRenamed("id", "node").dropDuplicates(["node", "packed"]), "packed")

    def confirmed(self, pairs: DataFrame, packed: DataFrame) -> DataFrame:
        """The rows (a, b) of `pairs` whose sets are similar enough."""
        left = packed.select(F.col("node").alias("a"), F.col("packed").alias("packed_a"))
        right = packed.select(F.col("node").alias("b"), F.col("packed").alias("packed_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "packed_a", "packed_b")
        return stored(both.mapInArrow(_confirm(self.k, *self.similarity), f"a {self.kind}, b {self.kind}"), "links")


def _joined(edges: DataFrame, members: DataFrame) -> DataFrame:
    """`members` with the component of each node so far."""
    found = components(edges, "a", "b")
    return members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _apart(known: DataFrame) -> DataFrame:
    """The members of buckets that hold several components."""
    found = known.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return known.join(found.where("low < high").select("bucket"), "bucket")


def _alike(members: DataFrame, packed: DataFrame, k: int, similarity: tuple[int, int]) -> DataFrame:
    """Links (a, b) between members of one bucket but different components, enough to connect them.

    A bucket is cut into blocks of about BLOCK members, and each two blocks are compared in one place: first by
    signature, without texts; then those that have a candidate there by their sets.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK)
    dealt = members.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    group = F.xxhash64("bucket", F.least("block", "with"), F.greatest("block", "with"))
    side = F.when(F.col("block") == F.col("with"), 2).otherwise((F.col("block") > F.col("with")).cast("int"))
    dealt = dealt.select(group.alias("g"), side.alias("side"), "bucket", "node", "n", "component", "bands", "marks")
    kind = members.schema["node"].dataType.simpleString()
    facing = dealt.repartition(F.col("g")).sortWithinPartitions("g").mapInArrow(_facing(*similarity), dealt.schema)
    facing = stored(facing, "facing").join(packed, "node").select(*dealt.columns, "packed")
    facing = facing.repartition(F.col("g")).sortWithinPartitions("g")
    return facing.mapInArrow(_compare(k, *similarity), f"a {kind}, b {kind}")


class _Group:
    """The members of two blocks: sides 0 and 1 face each other, members of side 2 all others."""

    def __init__(self, group: pa.Table, top: int, bottom: int) -> None:
        self.side, self.n, self.bucket = (group.column(x).to_numpy() for x in ("side", "n", "bucket"))
        _, self.component = np.unique(group.column("component").to_numpy(zero_copy_only=False), return_inverse=True)
        self.marks = np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint8).reshape(len(self.n), -1)
        self.bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(len(self.n), -1)
        self.top, self.bottom, self.least = top, bottom, self.marks.shape[1] * (top / bottom - SLACK)
        self.faced = np.flatnonzero(self.side != 0)

    def candidates(self) -> Iterator[tuple[int, np.ndarray]]:
        """(member, members in other components that its signature may link it with)."""
        n, bands = self.n, self.bands
        for i in np.flatnonzero(self.side != 1).tolist():
            to = self.faced
            to = to[(self.component[to] != self.component[i]) & ((self.side[to] == 1) | (to > i))]
            to = to[self.bottom * np.minimum(n[to], n[i]) >= self.top * np.maximum(n[to], n[i])]
            to = to[(self.marks[to] == self.marks[i]).sum(axis=1) >= self.least]
            # a pair that meets in several buckets is confirmed in the first only
            yield i, to[bands[i][(bands[to] == bands[i]).argmax(axis=1)] == self.bucket[i]]


def _facing(top: int, bottom: int):
    """The members that have a candidate in their group, as they are."""

    def of_group(group: pa.Table) -> list[pa.RecordBatch]:
        found = np.zeros(group.num_rows, bool)
        for i, to in _Group(group, top, bottom).candidates():
            found[to] = True
            found[i] |= len(to) > 0
        return group.filter(pa.array(found)).to_batches()

    return _by_group(of_group)


def _compare(k: int, top: int, bottom: int):
    """Links (a, b) between the members of a group, confirmed on their sets."""

    def of_group(group: pa.Table) -> list[pa.RecordBatch]:
        members = _Group(group, top, bottom)
        component = members.component
        sets: dict[int, np.ndarray] = {}
        held = 0

        def of(i: int) -> np.ndarray:
            nonlocal held
            if i not in sets:
                if held > SET_BYTES:
                    sets.clear()
                    held = 0
                sets[i] = _unpacked_sets(group.column("packed").slice(i, 1).combine_chunks(), k)[0]
                held += sets[i].nbytes
            return sets[i]

        hits = []
        for i, to in members.candidates():
            for j in to.tolist():
                if component[i] != component[j] and _linked(of(i), of(j), top, bottom):
                    hits.append((i, j))
                    component[component == component[j]] = component[i]
        if not hits:
            return []
        nodes = group.column("node").combine_chunks()
        return [pa.RecordBatch.from_arrays([nodes.take(pa.array([x[i] for x in hits])) for i in (0, 1)], ["a", "b"])]

    return _by_group(of_group)


def _by_group(of_group):
    """`of_group` for the rows of each g, the first column, in whose order batches come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            g = batch.column(0).to_numpy()
            cuts = (np.flatnonzero(g[1:] != g[:-1]) + 1).tolist()
            if held and len(g) and held[0].column(0)[0].as_py() != g[0]:
                cuts.insert(0, 0)
            at = 0
            for cut in cuts:
                yield from of_group(pa.Table.from_batches([*held, batch.slice(at, cut - at)]))
                held, at = [], cut
            if at < batch.num_rows:
                held.append(batch.slice(at))
        if held:
            yield from of_group(pa.Table.from_batches(held))

    return run


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    k: int = 2,
    similarity: tuple[int, int] = (80, 100),
    n_bands: int = BANDS,
    n_rows: int = ROWS,
) -> DataFrame:
    """Per row of `docs`: id, n_shingles, component_id, kept.

    Words are runs of bytes other than space and \\t to \\r, with A to Z lower-cased. The set of a text is
    its distinct k-word shingles; with fewer words, the whole sequence as one. Texts are linked if
    denominator * intersection >= numerator * union (`similarity` is numerator, denominator).
    component_id is the smallest id reachable by links, itself included; kept = (id = component_id).

    Null or empty texts and texts without words have n_shingles 0 and are linked with nothing. Repeated rows
    give repeated results; rows that share an id but not the text count as texts of one document where that
    id is the smallest of its copies. A row without id is linked with nothing; its component_id is null and
    it is kept. Other columns of `docs` are not read. Spark jobs run when this is called.
    """
    search = _Search(docs, id, text, k, similarity, n_bands, n_rows)
    nodes = search.nodes()
    members = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    first = members.groupBy("bucket").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b < last")
    members = stored(members.join(first.select("bucket", "b"), "bucket"), "members")
    pairs = members.where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    packed = search.packed(members)
    edges = search.confirmed(pairs, packed)

    members = _apart(_joined(edges, members.select("bucket", "node", "n")))
    members = members.join(nodes.select("node", "bands", "marks").dropDuplicates(["node"]), "node")
    edges = edges.unionByName(stored(_alike(members, packed, k, similarity), "links"))

    found = components(edges, "a", "b").withColumnRenamed("component", "component_id")
    of_key = nodes.join(found, "node", "left").select("key", F.coalesce("component_id", "node").alias("component_id"))
    own = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    out = search.signed.select("id", "n", "key").join(of_key, "key", "left")
    component = F.when(F.col("id").isNotNull(), own)
    return out.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
