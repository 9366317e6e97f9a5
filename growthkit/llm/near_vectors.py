"""Vectors of equal label with a cosine from a threshold: an exact range join in a metric space.

On unit vectors a cosine c is the distance sqrt(2 - 2c). Each group (label and length) takes a few of its
vectors as pivots; a vector's home is the cell of its nearest pivot. A vector x can have a partner in the cell
of pivot q only if x lies within the radius of that cell: by the triangle inequality its distance to the
border between q and its own pivot p, (d(x,q)^2 - d(x,p)^2) / (2 d(p,q)), is at most the radius. x is copied to
those cells. Cells are joined independently, in blocks of home vectors that read the cell's vectors as a
stream. Equal vectors are one node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from growthkit.llm.arrow import arrow_type
from growthkit.llm.components import components, stored

#: Nodes of a group for each pivot, the most pivots of a group, and home vectors that one task joins at once.
PER_PIVOT, PIVOTS, BLOCK = 1024, 16, 1024


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, embedding) to (id, label, length, key, unit); unit is null for a vector that links with nothing."""
    for batch in batches:
        units, sizes, keys = [], [], []
        for value in batch.column(2):
            unit = None
            if value.is_valid and value.values is not None and not value.values.null_count:
                v = np.asarray(value.values.to_numpy(zero_copy_only=False), np.float64)
                norm = math.sqrt(float(v @ v)) if len(v) and np.isfinite(v).all() else 0.0
                if norm and not math.isfinite(norm) or norm and norm < 1e-150:
                    v = v / np.abs(v).max()
                    norm = math.sqrt(float(v @ v))
                if norm:
                    unit = (v / norm).tobytes()
            units.append(unit)
            sizes.append(len(unit) // 8 if unit else None)
            keys.append(xxhash.xxh3_128_digest(unit) if unit else None)
        columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(units, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "label", "length", "key", "unit"])


def _cells(radius: float):
    """Nodes with the pivots of their group in, one row for each cell that a node belongs to out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivots, between = None, None, None
        for batch in batches:
            at, cell, home = [], [], []
            for i in range(batch.num_rows):
                given = batch.column(4)[i].as_py()
                if given != last:
                    last = given
                    pivots = np.stack([np.frombuffer(p, np.float64) for p in given])
                    between = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
                x = np.frombuffer(batch.column(3)[i].as_py(), np.float64)
                square = 2 - 2 * (pivots @ x)
                own = int(square.argmin())
                near = np.flatnonzero(square - square[own] <= 2 * between[own] * radius + 1e-9)
                at += [i] * len(near)
                cell += near.tolist()
                home += (near == own).tolist()
            taken = pa.RecordBatch.from_arrays(batch.columns[:4], ["g", "node", "n", "unit"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cell, pa.int32()), pa.array(home, pa.bool_())],
                ["g", "node", "n", "unit", "cell", "home"],
            )

    return run


class _Block:
    """Home vectors of one block; `against` counts their links and keeps a spanning forest of them."""

    def __init__(self, nodes: np.ndarray, n: np.ndarray, units: np.ndarray, threshold: float) -> None:
        self.nodes, self.n, self.units, self.threshold = nodes, n, units, threshold
        self.links = n - 1
        self.part = np.arange(len(nodes))

    def against(self, nodes: np.ndarray, n: np.ndarray, units: np.ndarray) -> list[tuple]:
        hit = self.units @ units.T >= self.threshold
        hit &= self.nodes[:, None] != nodes[None, :]
        self.links = self.links + hit @ n
        edges = []
        for j in np.flatnonzero(hit.any(axis=0)).tolist():
            mine = np.flatnonzero(hit[:, j])
            parts, first = np.unique(self.part[mine], return_index=True)
            edges += [(self.nodes[i], nodes[j]) for i in mine[first].tolist()]
            if len(parts) > 1:
                self.part[np.isin(self.part, parts)] = parts[0]
        return edges


def _join(threshold: float, kind: pa.DataType):
    """Rows (block, side, node, n, unit) in order of block and side; ("links", node, n) and ("edge", a, b) out."""

    def arrays(batch: pa.RecordBatch) -> tuple:
        units = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.float64).reshape(batch.num_rows, -1)
        return batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(), units

    def rows(name: str, a: list, b: list, n: list) -> pa.RecordBatch:
        columns = [pa.array([name] * len(a)), pa.array(a, kind), pa.array(b, kind), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["what", "a", "b", "n"])

    def done(block: _Block) -> pa.RecordBatch:
        return rows("links", block.nodes.tolist(), [None] * len(block.nodes), block.links.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        homes: list[tuple] = []
        block: _Block | None = None
        current = None
        for batch in batches:
            key, side = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (side[1:] != side[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if b == a:
                    continue
                if key[a] != current:
                    if block:
                        yield done(block)
                    current, homes, block = key[a], [], None
                if side[a] == 0:
                    homes.append(arrays(batch.slice(a, b - a)))
                    continue
                if block is None:
                    block = _Block(*(np.concatenate(x) for x in zip(*homes, strict=True)), threshold)
                    homes = []
                for at in range(a, b, BLOCK):
                    edges = block.against(*arrays(batch.slice(at, min(BLOCK, b - at))))
                    if edges:
                        yield rows("edge", [x for x, _ in edges], [y for _, y in edges], [None] * len(edges))
        if block:
            yield done(block)

    return run


def near_vectors(
    vectors: DataFrame,
    id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = 0.98,
    pivots: int = PIVOTS,
    block: int = BLOCK,
) -> DataFrame:
    """Per row of `vectors`: id, n_links, component_id, kept.

    Two vectors are linked if their labels are equal and not null, their lengths agree, and their cosine in
    double precision is `threshold` or more. n_links counts the other rows linked directly; component_id is the
    smallest id reachable by links, itself included; kept = (id = component_id). A vector that is null, empty,
    zero, or holds a null or a number that is not finite is linked with nothing, and so is a row without id,
    whose component_id is null and which is kept. Rows with equal vectors are linked like others and compared
    once. Other columns are not read. Spark jobs run when this is called.
    """
    rows = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("embedding"))
    kind = rows.schema["id"].dataType
    of_label = rows.schema["label"].dataType.simpleString()
    rows = rows.mapInArrow(_units, f"id {kind.simpleString()}, label {of_label}, length long, key binary, unit binary")
    rows = stored(rows, "units")
    linked = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("key").isNotNull()
    nodes = rows.where(linked).groupBy("label", "length", "key").agg(
        F.min("id").alias("node"), F.count("*").alias("n"), F.first("unit").alias("unit")
    )
    nodes = stored(nodes.withColumn("g", F.xxhash64("label", "length")), "nodes")

    order = Window.partitionBy("label", "length").orderBy("key")
    some = nodes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pivots)
    sizes = nodes.groupBy("label", "length").agg(F.count("*").alias("size"))
    some = some.join(sizes, ["label", "length"]).where(F.col("place") <= F.ceil(F.col("size") / PER_PIVOT))
    chosen = some.groupBy("label", "length").agg(F.sort_array(F.collect_list("unit")).alias("pivots"))
    radius = math.sqrt(2 - 2 * threshold)
    name = kind.simpleString()
    cells = nodes.join(chosen, ["label", "length"]).select("g", "node", "n", "unit", "pivots")
    cells = cells.mapInArrow(_cells(radius), f"g long, node {name}, n long, unit binary, cell int, home boolean")
    cells = stored(cells.withColumn("g", F.xxhash64("g", "cell")).drop("cell"), "cells")

    homes = cells.where("home").groupBy("g").agg(F.ceil(F.count("*") / block).alias("blocks"))
    dealt = cells.join(homes, "g")
    own = dealt.where("home").withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).withColumn("side", F.lit(0))
    all_ = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = own.unionByName(all_.withColumn("side", F.lit(1)))
    dealt = dealt.select(F.xxhash64("g", "block").alias("key"), "side", "node", "n", "unit")
    dealt = dealt.repartition("key").sortWithinPartitions("key", "side")
    found = dealt.mapInArrow(_join(threshold, arrow_type(kind)), f"what string, a {name}, b {name}, n long")
    found = stored(found, "links")

    parts = components(found.where("what = 'edge'"), "a", "b").withColumnRenamed("node", "a")
    links = found.where("what = 'links'").select("a", "n").join(parts, "a", "left")
    of_key = nodes.select("label", "length", "key", F.col("node").alias("a")).join(
        links.select("a", F.col("n").alias("n_links"), F.coalesce("component", "a").alias("component_id")), "a"
    )
    out = rows.where(linked).drop("unit").join(of_key, ["label", "length", "key"]).select("id", "n_links", "component_id")
    alone = rows.where(~linked).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.unionByName(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("id").alias(id), "n_links", "component_id", kept.alias("kept"))
