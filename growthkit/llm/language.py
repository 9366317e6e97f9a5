"""Language by hierarchical discrimination: the family first, then one-versus-one machines within it.

All machines are linear support vector machines on the square roots of byte n-gram shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthkit.llm.arrow import slices
from growthkit.llm.folds import held_out, sampled_ids
from growthkit.llm.hashing import LOWER, mix
from growthkit.llm.shared import Shared

#: Bits of a feature's number, bytes of the n-grams, and most texts of a language that are learned from.
BITS, GRAMS, SAMPLE = 12, (2, 3, 4), 600
#: Texts whose feature rows, of 32 kB each, are in memory at once.
ROWS = 512
UNKNOWN = "und"

# Families of related languages by ISO 639-1 code; any other code is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "indic": "hi ur bn pa gu mr ne si",
    "iranian": "fa ku ps tg",
    "semitic": "ar he mt am",
    "turkic": "tr az kk ky uz tt tk",
    "uralic": "fi et hu",
    "malayic": "id ms jv su",
    "dravidian": "ta te kn ml",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTER = np.zeros(256, bool)
_LETTER[[b for b in range(256) if b >= 128 or chr(b).isalpha()]] = True


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().replace("_", "-").split("-")[0], lang)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of 2**BITS values for each text; letters are lower-cased, all else is one border."""
    n = len(offsets) - 1
    out = np.zeros(n << BITS)
    if len(data):
        body = np.where(_LETTER[data], LOWER[data], 32).astype(np.uint64)
        owner = np.repeat(np.arange(n), np.diff(offsets))
        for k in GRAMS:
            if len(body) < k:
                break
            gram = np.zeros(len(body) - k + 1, np.uint64)
            for i in range(k):
                gram = gram * np.uint64(257) + body[i : len(body) - k + 1 + i]
            inside = (owner[: len(gram)] == owner[k - 1 :]) & ~((body[: len(gram)] == 32) & (body[1 : len(gram) + 1] == 32))
            at = (mix(gram * np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64)
            out += np.bincount((owner[: len(gram)] << BITS | at)[inside], minlength=n << BITS)
    out = out.reshape(n, -1)
    return np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches, "text", 1 << 19, ROWS):
        found = [x.astype(np.float32).tobytes() for x in features(data, offsets)]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.binary())], ["lang", "features"])


def machine(x: np.ndarray, y: np.ndarray, steps: int = 150, penalty: float = 1e-5) -> np.ndarray:
    """Weights and bias of a linear support vector machine with squared hinge loss; y is +1 or -1.

    Both classes weigh the same. Accelerated gradient descent on all rows.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = ahead = np.zeros(x.shape[1], x.dtype)
    rate = 1 / (2 * 2.0 + penalty)  # rows have norm sqrt(2)
    for step in range(steps):
        short = np.maximum(0, 1 - y * (x @ ahead))
        slope = -2 * (x.T @ (share * y * short).astype(x.dtype)) + penalty * ahead
        new = ahead - rate * slope
        ahead = new + step / (step + 3) * (new - w)
        w = new
    return w


class Hierarchy:
    """Families against the rest, and within a family every language against every other."""

    def __init__(self, x: np.ndarray, lang: np.ndarray) -> None:
        self.langs = sorted(set(lang.tolist()))
        of = np.array([family(v) for v in lang])
        self.families = sorted(set(of.tolist()))
        self.top = [machine(x, np.where(of == f, 1.0, -1.0)) for f in self.families] if len(self.families) > 1 else []
        self.pairs = {}
        for f in self.families:
            for a, b in combinations([v for v in self.langs if family(v) == f], 2):
                both = (lang == a) | (lang == b)
                self.pairs[a, b] = machine(x[both], np.where(lang[both] == a, 1.0, -1.0))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, score) of each row; the score is the product of both decisions' logistic margins."""

        def margin(w: np.ndarray) -> np.ndarray:
            return x @ w[:-1] + w[-1]

        place = np.zeros(len(x), np.int64)
        score = np.ones(len(x))
        if self.top:
            margins = np.stack([margin(w) for w in self.top], axis=1)
            place = margins.argmax(axis=1)
            ordered = np.sort(margins, axis=1)
            score = 1 / (1 + np.exp(-2 * np.clip(ordered[:, -1] - ordered[:, -2], 0, 40)))
        out = np.empty(len(x), object)
        for i, f in enumerate(self.families):
            here = np.flatnonzero(place == i)
            members = [v for v in self.langs if family(v) == f]
            votes = np.zeros((len(here), len(members)))
            for (a, b), w in self.pairs.items():
                if a in members:
                    m = x[here] @ w[:-1] + w[-1]
                    votes[:, members.index(a)] += np.sign(m) + np.tanh(m) / len(members)
                    votes[:, members.index(b)] -= np.sign(m) + np.tanh(m) / len(members)
            best = votes.argmax(axis=1)
            out[here] = np.array(members, object)[best]
            if len(members) > 1:
                ordered = np.sort(votes, axis=1)
                score[here] *= 1 / (1 + np.exp(-2 * (ordered[:, -1] - ordered[:, -2])))
        return out, score


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text holds a letter; only texts without ASCII letters are decoded for it."""
    ascii = np.concatenate(([0], np.cumsum(_LETTER[data] & (data < 128))))
    out = ascii[offsets[1:]] > ascii[offsets[:-1]]
    for i in np.flatnonzero(~out).tolist():
        body = data[offsets[i] : offsets[i + 1]]
        if (body >= 128).any():
            out[i] = any(c.isalpha() for c in body.tobytes().decode("utf-8", "replace"))
    return out


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rows, data, offsets in slices(batches, "text", 1 << 19, ROWS):
            ok = has_letter(data, offsets)
            langs, scores = np.full(len(ok), UNKNOWN, object), np.zeros(len(ok))
            if model is not None and ok.any():
                found, score = model.predict(features(data, offsets)[ok])
                langs[ok], scores[ok] = found, score
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(langs.tolist(), pa.string()), pa.array(scores)],
                ["id", "held_out", "lang_pred", "score"],
            )

    return run


def languages(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE
) -> DataFrame:
    """Per row of `docs`: id, held_out, lang_pred, score (0 to 1).

    Learned from at most `sample` texts with letters for each value of `lang`, none of them held out (crc32 of the
    id divisible by 5, or no id). A prediction sees the whole text and nothing else; a null text, or one
    without a letter, is `und` with score 0, and so is every text if there is nothing to learn from. Equal texts
    get equal results, repeated rows repeated ones; other columns are not read. Learning runs when this is called.
    """
    rows = docs.select(
        F.col(id).alias("id"), held_out(id).alias("held_out"), F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    usable = rows.where(r"NOT held_out AND lang IS NOT NULL AND text RLIKE '\\p{L}'")
    chosen = sampled_ids(usable, "id", "lang", sample)  # at most `sample` ids for each language
    texts = usable.join(F.broadcast(chosen), ["id", "lang"]).select("lang", "text")
    found = texts.mapInArrow(_feature_rows, "lang string, features binary").toPandas()
    model = None
    if len(found):
        found = found.sort_values(["lang", "features"], kind="stable")
        x = np.frombuffer(b"".join(found.features), np.float32).reshape(len(found), -1)
        model = Hierarchy(x, found.lang.to_numpy())
    shared = Shared(docs.sparkSession, model)
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.select("id", "held_out", "text").mapInArrow(
        _predict(shared), f"id {kind}, held_out boolean, lang_pred string, score double"
    )
    return out.withColumnRenamed("id", id)
