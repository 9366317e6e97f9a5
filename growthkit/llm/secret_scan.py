"""Secrets in texts: fixed patterns, and strings whose tokens are short for their length.

Natural words take few tokens of a trained vocabulary; random strings break into many. A run of key
characters whose characters per token stay below a threshold is a secret, unless it is the digest or
identifier of something else.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthkit.llm.arrow import slices
from growthkit.llm.hashing import LOWER

#: Names of spans in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]+")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Characters of the shortest run that is tested, characters per token below which it is random, and the part of
#: that for a run of letters alone, which may be a word (on the test texts, invented words have 2.0 or more).
SHORTEST, PER_TOKEN, LETTERS_ALONE = 20, 2.0, 0.95
_ALPHABET = "abcdefghijklmnopqrstuvwxyz" * 2
#: Lengths of hexadecimal digests in common use (32 to 128 digits), which are not secrets by themselves.
DIGESTS = (32, 40, 48, 56, 64, 96, 128)
_UUID = re.compile("[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)
_KEY_BYTES = np.zeros(256, bool)
_KEY_BYTES[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True


def known(run: str) -> bool:
    """Whether a run is a digest, a UUID, a number, or letters in the order of the alphabet."""
    if _UUID.fullmatch(run) or (len(run) in DIGESTS and re.fullmatch("[0-9a-fA-F]+", run)):
        return True
    return run.lower() in _ALPHABET or not any(c.isalpha() for c in run)


def limit_of(run: str, per_token: float) -> float:
    """Characters per token below which a run is random: `per_token`, a little less for a run of letters alone."""
    return per_token if not run.isalpha() else per_token * LETTERS_ALONE


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and kind."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def random_spans(text: str, base: list, tokens, per_token: float) -> list[tuple[int, int, str]]:
    """Runs that no base span touches and whose characters per token lie below `per_token`."""
    out = []
    for m in _RUN.finditer(text):
        a, b = m.span()
        if b - a < SHORTEST or known(m.group()) or any(x < b and a < y for x, y, _ in base):
            continue
        if b - a < limit_of(m.group(), per_token) * tokens(m.group()):
            out.append((a, b, "random"))
    return out


def suspicious(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, whether it holds a keyword or a long run of key characters; no other text can hold a secret."""
    key = np.concatenate(([False], _KEY_BYTES[data], [False]))
    edges = np.flatnonzero(key[1:] != key[:-1])
    starts, ends = edges[::2], edges[1::2]
    places = [starts[ends - starts >= min(SHORTEST, 20)]]
    # a run may reach over the border of two texts; then both are looked at
    places.append(ends[ends - starts >= min(SHORTEST, 20)] - 1)
    body = LOWER[data].tobytes()
    for word in _WORDS:
        at = body.find(word)
        found = []
        while at >= 0:
            found.append(at)
            at = body.find(word, at + 1)
        places.append(np.array(found, np.int64))
    out = np.zeros(len(offsets) - 1, bool)
    runs = places[0]
    out[np.searchsorted(offsets, np.concatenate(places), side="right") - 1] = True
    # texts between the ends of a run that spans several texts
    for a, b in zip(runs.tolist(), places[1].tolist(), strict=True):
        lo, hi = np.searchsorted(offsets, [a, b], side="right") - 1
        out[lo : hi + 1] = True
    return out


def _spans(shared, per_token: float):
    """A function from a slice of texts to [(number of the text, text, base spans, all spans)]."""
    counter = []

    def tokens(run: str) -> int:
        if not counter:
            import tiktoken

            pattern, ranks = shared.value
            counter.append(tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))
        return len(counter[0].encode_ordinary(run))

    def run(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        for i in np.flatnonzero(suspicious(data, offsets)).tolist():
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
            base = base_spans(text)
            more = random_spans(text, base, tokens, per_token)
            if base or more:
                yield i, text, base, sorted([*base, *more], key=lambda x: (x[0], KINDS.index(x[2])))

    return run


def _listed(spans: list) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _report(shared, per_token: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _spans(shared, per_token)
        empty = hashlib.sha256(b"").hexdigest()
        for rows, data, offsets in slices(batches, "text"):
            n = rows.num_rows
            counts = {kind: [0] * n for kind in KINDS}
            digests, listed = [empty] * n, [""] * n
            for i, _, base, spans in find(data, offsets):
                for _, _, kind in spans:
                    counts[kind][i] += 1
                digests[i] = hashlib.sha256(_listed(base).encode()).hexdigest()
                listed[i] = _listed(spans)
            columns = [rows.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests), pa.array(listed)]
            names = ["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    out, done = [], 0
    for a, b, _ in spans:
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return "".join([*out, text[done:]])


def _redact(shared, per_token: float, mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _spans(shared, per_token)
        for rows, data, offsets in slices(batches, "text"):
            texts = rows.column(1).to_pylist()
            for i, text, _, spans in find(data, offsets):
                texts[i] = redacted(text, spans, mark)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.string())], ["rest", "text"])

    return run


def _vocabulary(docs: DataFrame, path: str, pattern: str):
    """The vocabulary file as a broadcast value; its size does not depend on the data."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return docs.sparkSession.sparkContext.broadcast((pattern, ranks))


def secrets(
    docs: DataFrame, vocabulary: str, pattern: str, id: str = "doc_id", text: str = "text", per_token: float = PER_TOKEN
) -> DataFrame:
    """Per row of `docs`: id, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    `spans` lists kind:start:end in code points, by start, comma-joined; base_sha256 is of that list without
    the random ones. `vocabulary` is a rank file and `pattern` its split pattern. Null and empty texts have no
    spans. Each row is judged alone, in whole: repeated rows give repeated results, ids may be null, and other
    columns are not read. Nothing is shuffled.
    """
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    shared = _vocabulary(docs, vocabulary, pattern)
    out = docs.mapInArrow(_report(shared, per_token), f"id {kind}, {counts}, base_sha256 string, spans string")
    return out.withColumnRenamed("id", id)


def without_secrets(
    docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", per_token: float = PER_TOKEN, mark: str = "[SECRET]"
) -> DataFrame:
    """`docs` with `mark` in the place of every span that `secrets` finds; touching finds get one mark each,
    overlapping ones one together. A null text stays null; all columns and their order stay."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    rows = docs.select(rest.alias("rest"), F.col(text).alias("text"))
    kind = rows.schema["rest"].dataType.simpleString()
    shared = _vocabulary(docs, vocabulary, pattern)
    rows = rows.mapInArrow(_redact(shared, per_token, mark), f"rest {kind}, text string")
    return rows.select(*[F.col("text").alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
