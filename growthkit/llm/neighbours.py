"""Quality by nearest-neighbour voting in a latent-semantic space.

Labelled texts become vectors of weighted terms, and their singular vectors span the latent space. The labelled
vectors in that space are broadcast; every text is compared with all of them by exact cosine products, block by
block, and the labels of its nearest neighbours vote with their similarity as weight.

Terms are hashed runs of character kinds (lower, upper, digit, each punctuation mark), words by their first
letters, and marks of repetition: a word like the one before, and three words in a row that stood before in the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthkit.llm.arrow import slices
from growthkit.llm.folds import held_out, sampled_ids
from growthkit.llm.hashing import BASE, LOWER, mix, spans, sums, word_bounds
from growthkit.llm.shared import Shared

#: Bits of a term's number, characters of the longest run of kinds, and letters of a word that count.
BITS, KINDS, LETTERS = 12, 4, 4
#: Most texts of each label that are learned from; they are also the neighbours.
SAMPLE = 2000
#: Dimensions of the latent space, neighbours that vote, and texts that are compared at once.
RANK, NEIGHBOURS, BLOCK = 48, 25, 512
#: Numbers of the terms that are not hashed: a repeated word, three repeated words, three new words, and an empty text.
TWICE, AGAIN, NEW, EMPTY = range(1 << BITS, (1 << BITS) + 4)
TERMS = EMPTY + 1

_KIND = np.arange(256, dtype=np.uint64)
for _first, _last in (("a", "z"), ("A", "Z"), ("0", "9")):
    _KIND[ord(_first) : ord(_last) + 1] = ord(_first)
_KIND[128:] = ord("a")


def _hashed(x: np.ndarray) -> np.ndarray:
    return (mix(x) >> np.uint64(64 - BITS)).astype(np.int64)


def _counted(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of `key`, all below `size`, and how often they stand there."""
    if size > 4 * len(key):  # many short texts
        return np.unique(key, return_counts=True)
    count = np.bincount(key, minlength=size)
    found = np.flatnonzero(count)
    return found, count[found]


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, weight) of the terms of each text, by text; a term may stand there once for each sort.

    The weight is the square root of the term's share among the terms of its sort in that text, for words like
    the one before their share among all words.
    """
    n = len(offsets) - 1
    empty = np.flatnonzero(np.diff(offsets) == 0)
    keys, weights = [empty * TERMS + EMPTY], [np.ones(len(empty))]

    def add(owner: np.ndarray, term: np.ndarray | int, total: np.ndarray | None = None) -> None:
        total = np.bincount(owner, minlength=n) if total is None else total
        found, count = _counted(owner * TERMS + term, n * TERMS)
        keys.append(found)
        weights.append(np.sqrt(count / total[found // TERMS]))

    if len(data):
        owner = np.repeat(np.arange(n), np.diff(offsets))
        kind = _KIND[data]
        run = np.zeros(len(data), np.uint64)
        for k in range(1, min(KINDS, len(data)) + 1):
            size = len(data) - k + 1
            run = run[:size] * np.uint64(257) + kind[k - 1 :]
            whole = owner[:size] == owner[k - 1 :]
            add(owner[:size][whole], _hashed(run[whole] * np.uint64(8) + np.uint64(k)))
        starts, ends = word_bounds(data, offsets)
        of = np.searchsorted(offsets, starts, side="right") - 1
        running = sums(LOWER[data])
        word = spans(running, starts, ends)
        add(of, _hashed(spans(running, starts, np.minimum(ends, starts + LETTERS))))
        same = np.append(False, (word[1:] == word[:-1]) & (of[1:] == of[:-1])) if len(word) else np.zeros(0, bool)
        add(of[same], TWICE, np.bincount(of, minlength=n))
        if len(word) > 2:
            three = mix((word[:-2] * BASE + word[1:-1]) * BASE + word[2:])
            here = of[:-2] == of[2:]
            three, of = mix(three[here] + of[:-2][here].astype(np.uint64)), of[:-2][here]
            _, first = np.unique(three, return_index=True)
            again = np.ones(len(three), bool)
            again[first] = False
            add(of, np.where(again, AGAIN, NEW))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    return key[order] // TERMS, key[order] % TERMS, weight[order]


def _term_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches, "text"):
        text, term, weight = terms(data, offsets)
        cuts = np.searchsorted(text, np.arange(1, rows.num_rows))
        lists = [
            pa.array([part.tobytes() for part in np.split(x.astype(kind), cuts)], pa.binary())
            for x, kind in ((term, np.int32), (weight, np.float32))
        ]
        yield pa.RecordBatch.from_arrays([rows.column(0), *lists], ["label", "terms", "weights"])


def _projected(text: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, axes: np.ndarray) -> np.ndarray:
    """Unit vectors of n texts in the space that `axes` spans; a text without known terms is the zero vector."""
    out = np.zeros((n, axes.shape[1]))
    if len(text):
        first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        out[text[first]] = np.add.reduceat(weight[:, None] * axes[term], first)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(size > 0, size, 1)


def latent(lists: list[tuple[np.ndarray, np.ndarray]], rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """(axes with the terms' weights, unit vectors) of texts given as (terms, weights).

    The axes are the leading right singular vectors of the weighted texts, found by block power iteration from fixed starts.
    """
    n = len(lists)
    text = np.repeat(np.arange(n), [len(t) for t, _ in lists])
    term = np.concatenate([t for t, _ in lists]).astype(np.int64)
    weight = np.concatenate([w for _, w in lists]).astype(np.float64)
    rarity = np.log((n + 1) / (np.bincount(term, minlength=TERMS) + 1)) + 1
    table = np.zeros((n, TERMS), np.float32)
    np.add.at(table, (text, term), weight * rarity[term])
    axes = np.random.default_rng(13).standard_normal((TERMS, min(rank + 8, n, TERMS))).astype(np.float32)
    for _ in range(6):
        axes, _ = np.linalg.qr(table.T @ (table @ axes))
    _, _, turn = np.linalg.svd(table @ axes, full_matrices=False)
    axes = (axes @ turn.T)[:, :rank]
    vectors = table @ axes
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return axes * rarity[:, None], vectors / np.where(size > 0, size, 1)


def votes(vectors: np.ndarray, known: np.ndarray, labels: np.ndarray, k: int = NEIGHBOURS, block: int = BLOCK) -> np.ndarray:
    """The similarity-weighted share of label 1 among the k nearest of `known` to each vector.

    All cosines are computed; equal ones are taken in the order of `known`, and only positive ones vote. A vector without a vote gets
    the share of label 1 among all.
    """
    out = np.full(len(vectors), float(labels.mean()))
    k = min(k, len(known))
    for at in range(0, len(vectors), block):
        cosine = vectors[at : at + block] @ known.T
        least = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
        above = cosine > least
        ties = cosine == least
        chosen = above | (ties & (np.cumsum(ties, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        weight = np.where(chosen, np.maximum(cosine, 0), 0)
        total = weight.sum(axis=1)
        voted = total > 0
        out[at : at + block][voted] = (weight @ labels)[voted] / total[voted]
    return np.clip(out, 0, 1)


def _score(shared: Shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rows, data, offsets in slices(batches, "text"):
            score = np.zeros(rows.num_rows)
            if model is not None:
                axes, known, labels = model
                score = votes(_projected(*terms(data, offsets), rows.num_rows, axes), known, labels, k)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["id", "held_out", "score", "predicted"],
            )

    return run


def neighbour_quality(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    sample: int = SAMPLE,
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """Per row of `docs`: id, held_out, score (0 to 1), predicted (1 from a score of 0.5).

    Learned from at most `sample` texts of each label, none of them held out (crc32 of the id modulo 3 is 1, or no
    id); they span the latent space and are the neighbours that vote. A score sees the whole text and nothing else. Null
    and empty texts count as one term of their own; without labels all scores are 0. Labels other than 0 and 1 and null
    ones are not read, of several labels of an id the largest counts; equal texts get equal scores, repeated rows repeated
    results, other columns are not read. Learning runs when this is called.

    The broadcast holds 2 * sample vectors and one row for each term, whatever the size of `docs`; texts are never
    shuffled, except those learned from.
    """
    spark = docs.sparkSession

    def out_of_fold(name: str):
        return held_out(name, 3, 1)

    known = labels.select(F.col(id).alias("id"), F.col(quality).cast("int").alias("label")).where("label IN (0, 1)")
    known = known.where(~out_of_fold("id")).groupBy("id").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(id).alias("id"), out_of_fold(id).alias("held_out"), F.col(text).alias("text"))
    usable = rows.where("NOT held_out").select("id").join(known, "id").distinct()
    chosen = sampled_ids(usable, "id", "label", sample)
    texts = rows.join(F.broadcast(chosen), "id").select("label", "id", "text")  # at most 2 * sample ids
    texts = texts.dropDuplicates(["id"]).select("label", "text")
    found = texts.mapInArrow(_term_lists, "label int, terms binary, weights binary").toPandas()
    model = None
    if len(found):
        found = sorted(zip(found.label.tolist(), found.terms, found.weights, strict=True))
        axes, vectors = latent([(np.frombuffer(t, np.int32), np.frombuffer(w, np.float32)) for _, t, w in found])
        model = axes.astype(np.float32), vectors.astype(np.float32), np.array([y for y, _, _ in found], np.float32)
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_score(Shared(spark, model), neighbours), f"id {kind}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id)
