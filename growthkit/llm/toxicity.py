"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts and unlabelled texts are learned from. With the share of toxic texts p, the risk of a
classifier is p * E+[loss as toxic] + max(0, Eu[loss as clean] - p * E+[loss as clean]): the second part is the
risk on clean texts, estimated from unlabelled ones, and is kept from falling below zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthkit.llm.arrow import slices
from growthkit.llm.components import stored
from growthkit.llm.folds import held_out, sampled_ids
from growthkit.llm.hashing import IS_SPACE, LOWER, spans, sums, word_bounds

#: Bits of a feature's number; characters of the word beginnings that are features beside the word.
BITS, PREFIXES = 22, (4, 5, 6)
#: Most texts of each kind that are learned from, and features that the classifier keeps.
SAMPLE, FEATURES = 6000, 4096
_PARTS = IS_SPACE.copy()
_PARTS[[b for b in range(128) if not chr(b).isalnum()]] = True


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, number of its text) of every word and word beginning; a text's features repeat."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = LOWER[data]
    starts, ends = word_bounds(data, offsets, _PARTS)
    running = sums(data)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    found, owners = [spans(running, starts, ends)], [owner]
    for i, k in enumerate(PREFIXES, 1):
        long = ends - starts >= k
        found.append(spans(running, starts[long], starts[long] + k) + np.uint64(i))
        owners.append(owner[long])
    mixed = np.concatenate(found) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


def _feature_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches, "text"):
        found, owner = features(data, offsets)
        key = np.unique(owner << BITS | found)
        lists = np.split((key & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(key >> BITS, np.arange(1, rows.num_rows)))
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(lists, pa.list_(pa.int32()))], ["toxic", "features"])


def telling(lists: DataFrame, n_positive: int, n_unlabelled: int) -> np.ndarray:
    """The features that stand clearly more often in positive than in unlabelled texts, at most FEATURES of them,
    by the strength of the difference. Counted by Spark; only these features come to the driver."""
    counts = lists.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        (F.count_if(F.col("toxic") == 1) / n_positive).alias("p"),
        ((F.count_if(F.col("toxic") != 1) + 1) / (n_unlabelled + 1)).alias("u"),
    )
    clear = counts.where(f"p > 2 * u AND p - u > 5 * sqrt(u / {n_positive})")  # five standard errors
    best = clear.orderBy(F.desc(F.expr("p * ln(p / u)")), "feature").limit(FEATURES).select("feature").collect()
    return np.sort(np.array([r[0] for r in best], np.int64))


def _only(kept: np.ndarray):
    """The features of each text that are in `kept`, as places in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.searchsorted(kept, x[np.isin(x, kept)]) for x in (v.values.to_numpy() for v in batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))], ["toxic", "features"]
            )

    return run


def _rows(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, feature) pairs and the number of texts."""
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(lists)), [len(x) for x in lists]), flat, len(lists)


def learn(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], features: int, prior: float, steps: int = 400
) -> tuple[np.ndarray, float]:
    """(weights, bias) of a logistic classifier by the non-negative risk, with Adam on all texts' features."""
    sets = [_rows(x) for x in (positive, unlabelled)]
    weights = np.zeros(features + 1)
    weights[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(weights), np.zeros_like(weights)

    def scores(i: int) -> np.ndarray:
        text, feature, n = sets[i]
        return np.bincount(text, weights[feature], minlength=n) + weights[-1]

    def gradient(i: int, of_score: np.ndarray) -> np.ndarray:
        text, feature, n = sets[i]
        out = np.bincount(feature, of_score[text], minlength=len(weights))
        out[-1] = of_score.sum()
        return out / n

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for step in range(1, steps + 1):
        p, u = scores(0), scores(1)
        clean = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        of_clean = gradient(1, sigmoid(u)) - prior * gradient(0, sigmoid(p))
        if clean >= 0:
            slope = prior * gradient(0, sigmoid(p) - 1) + of_clean
        else:  # step back until the estimate of the clean risk is positive again
            slope = -of_clean
        slope[:-1] += 1e-4 * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, weights, bias = shared.value
        number = np.full(1 << BITS, -1, np.int32)
        number[kept] = np.arange(len(kept), dtype=np.int32)
        for rows, data, offsets in slices(batches, "text"):
            found, owner = features(data, offsets)
            of = number[found]
            hit = of >= 0
            pairs = np.unique(owner[hit] * (len(kept) + 1) + of[hit])
            text, feature = np.divmod(pairs, len(kept) + 1)
            z = np.bincount(text, weights[feature], minlength=rows.num_rows) + bias
            with np.errstate(over="ignore"):
                score = 1 / (1 + np.exp(-z))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["id", "held_out", "score", "predicted"],
            )

    return run


def toxicity(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic", sample: int = SAMPLE
) -> DataFrame:
    """Per row of `docs`: id, held_out, score (0 to 1), predicted (1 from a score of 0.5).

    Learned from at most `sample` texts labelled toxic and `sample` unlabelled texts, none of them held out
    (crc32 of the id divisible by 5, or no id); the share of toxic texts is that of all labelled rows not held
    out. Scores see the whole text and nothing else. Null and empty texts get the score of a text without
    known words; without toxic labels all scores are 0. Equal texts get equal scores, repeated rows repeated
    results, null labels count as unlabelled; other columns are not read. Learning runs when this is called.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id).alias("id"), F.col(toxic).alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic")).where(~held_out("id"))
    rows = docs.select(F.col(id).alias("id"), held_out(id).alias("held_out"), F.col(text).alias("text"))
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    model = np.zeros(0, np.int64), np.zeros(0), -800.0
    if prior:
        kind = rows.where("NOT held_out").select("id").join(known, "id", "left")
        kind = kind.select("id", F.coalesce("toxic", F.lit(-1)).alias("toxic")).where("toxic <> 0")
        chosen = sampled_ids(kind.distinct(), "id", "toxic", sample)
        texts = rows.join(F.broadcast(chosen), "id").select("toxic", "text")  # at most 2 * sample ids
        lists = stored(texts.mapInArrow(_feature_lists, "toxic int, features array<int>"), "features")
        sizes = {r[0]: r[1] for r in lists.groupBy("toxic").count().collect()}
        if sizes.get(1) and sizes.get(-1):
            kept = telling(lists, sizes[1], sizes[-1])
            found = lists.mapInArrow(_only(kept), "toxic int, features array<int>").toPandas()
            given = [[np.asarray(x, np.int64) for x in found.features[found.toxic == y]] for y in (1, -1)]
            model = kept, *learn(*given, len(kept), min(max(prior, 1e-4), 0.9))
    shared = spark.sparkContext.broadcast(model)
    out = rows.mapInArrow(
        _score(shared), f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, score double, predicted int"
    )
    return out.withColumnRenamed("id", id)
