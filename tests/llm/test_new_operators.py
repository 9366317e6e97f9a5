"""Token alignment, conversation repair and neighbour voting against slow forms of the same definitions."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from growthkit.llm import alignment
from growthkit.llm.merge_path import common
from growthkit.llm.neighbours import TERMS, neighbour_quality, terms, votes
from growthkit.llm.repeats import repeated_bytes
from growthkit.llm.token_links import byte_vocabulary, links, piece_vocabulary, token_links
from growthkit.llm.turns import repaired

BYTES, PIECES = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
NOTHING = hashlib.sha256(b"").hexdigest()
SMALL = "/root/testdata/sf0.001"


def test_common_values_of_sorted_arrays():
    rnd = random.Random(1)
    for work in (1, 2, 5, 64):
        for _ in range(40):
            a = np.array(sorted(rnd.sample(range(60), rnd.randrange(30))), np.int64)
            b = np.array(sorted(rnd.sample(range(60), rnd.randrange(30))), np.int64)
            i, j = common(a, b, work)
            want = sorted(set(a.tolist()) & set(b.tolist()))
            assert a[i].tolist() == b[j].tolist() == want


def test_links_of_large_groups():
    a, b = np.array([1, 2, 2] * 40 + [5], np.int32), np.array([7, 8] * 50 + [9], np.int32)
    keys, counts = links(a, b, np.array([120, 1]), np.array([100, 1]), np.array([0, 3]), 10)
    want = Counter((0, x, y) for x in a[:120].tolist() for y in b[:100].tolist()) + Counter([(3, 5, 9)])
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == {(t * 10 + x) * 10 + y: n for (t, x, y), n in want.items()}


def slow_links(texts: dict) -> dict:
    """The contract, text by text with the libraries."""
    byte_level, pieces = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    byte_level.encode_special_tokens = True
    of_a, of_b = byte_vocabulary(BYTES)["bytes"], piece_vocabulary(PIECES)["bytes"]
    out, pairs = {}, {}
    for id, t in texts.items():
        out[id], pairs[id] = [0, 0, 0, 0, 0, 0, ""], Counter()
        a = byte_level.encode(f" {t}", add_special_tokens=False).ids if t else []
        b = pieces.encode(t) if t else []
        if not t or any(b"".join(of[i] for i in x) != f" {t}".encode() for of, x in ((of_a, a), (of_b, b))):
            continue
        ends = [np.cumsum([len(of[i]) for i in x]).tolist() for of, x in ((of_a, a), (of_b, b))]
        groups, before = [], 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            groups.append([[i for i, e in zip(x, es, strict=True) if before < e <= cut] for x, es in ((a, ends[0]), (b, ends[1]))])
            before = cut
        for x, y in groups:
            pairs[id].update((i, j) for i in x for j in y)
        listed = ";".join("|".join(",".join(map(str, x)) for x in g) for g in groups)
        out[id] = [len(a), len(b), len(groups), pairs[id].total(), 0, 0, hashlib.sha256(listed.encode()).hexdigest()]
    docs = Counter(p for own in pairs.values() for p in own)
    most = defaultdict(int)
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    for id, own in pairs.items():
        out[id][4] = sum(n for p, n in own.items() if docs[p] == most[p[0]])
        out[id][5] = sum(n * docs[p] for p, n in own.items())
    return {id: tuple(v) for id, v in out.items()}


def test_token_links(spark):
    rnd = random.Random(2)
    signs = "ab  ▁<>|é中🙂\n\t's12 　é​\x00ñ.!"
    texts = ["", None, " ", "plain words", "plain words", "<|endoftext|> <s> </s>", "a " * 900, " " * 700, "🙂" * 300, "x▁y"]
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randrange(25))) for _ in range(150)]
    texts += [r[0] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(40).collect()]
    rows = dict(enumerate(texts))
    df = spark.createDataFrame([(i, t, 1, "p") for i, t in rows.items()], "doc_id long, text string, pair int, block string")
    got = token_links(df.repartition(3), BYTES, PIECES).collect()
    assert {r[0]: (*r[1:5], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in got} == slow_links(rows)


def test_token_links_of_nothing_and_other_ids(spark):
    assert token_links(spark.createDataFrame([], "doc_id long, text string"), BYTES, PIECES).collect() == []
    df = spark.createDataFrame([(None, "one two"), (3, "one two")], "doc_id short, text string")
    got = token_links(df, BYTES, PIECES).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in got] == [None, 3] and got[0][1:] == got[1][1:] and got[0]["count_sum"] == 2 * got[0]["n_links"]


def slow_repair(codes: str, state: int = 0, ends: tuple = alignment.CLOSE) -> tuple:
    """The cheapest and then ASCII-least edits, by trying all from left to right."""
    due, to = {0: "us", 1: "u", 2: "a", 3: "u"}, {"s": 1, "u": 2, "a": 3}

    @lru_cache(None)
    def go(i: int, state: int, inserted: int) -> tuple:
        if i == len(codes):
            return ends[state], "", state
        code, out = codes[i], []

        def then(cost: int, edit: str, rest: tuple) -> None:
            out.append((rest[0] + cost, edit + rest[1], rest[2]))

        then(3, "D", go(i + 1, state, 0))
        for t in due[state]:
            if code != "d" and code.lower() == t:
                then(code.isupper(), "K", go(i + 1, to[t], 0))
            if t != "s" and code != "d":
                then(2 + code.isupper(), "R", go(i + 1, to[t], 0))
            if t != "s" and inserted < 3:
                then(2, "I", go(i, to[t], inserted + 1))
        return min(out)

    return go(0, state, 0)


def test_alignment_finds_the_cheapest_and_least_edits():
    rnd = random.Random(3)
    for k in range(600):
        codes = "".join(rnd.choice("suaxSUAXd" if k % 2 else "uuaaasUAd") for _ in range(rnd.randrange(1, 9)))
        state = rnd.randrange(4)
        ends = alignment.CLOSE if k % 3 else tuple(rnd.choice([0, 1, 2, 3, 5]) for _ in range(4))
        assert alignment.best(codes, state, ends) == slow_repair(codes, state, ends), (codes, state, ends)
        for to, cost in enumerate(alignment.costs(codes)[state]):
            only = tuple(0 if j == to else alignment.FAR for j in range(4))
            assert min(cost, alignment.FAR) == min(slow_repair(codes, state, only)[0], alignment.FAR)


def slow_conversations(rows: list[tuple]) -> dict:
    """The contract, conversation by conversation."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        found[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, turns in found.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        codes = ""
        for at, (_, role, text) in enumerate(turns):
            body = text.strip(" \t\n\x0b\x0c\r")
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            code = code if body and body[-1] in ".!?" else code.upper()
            codes += "b" if not body else "d" if any(t[1:] == (role, text) for t in turns[:at]) else code
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit, state = slow_repair(codes.replace("b", "d")) if turns else (0, "", 0)
        audit += ("", "II", "I", "")[state]
        length, lines, left = sum(e != "D" for e in audit), [], list(turns)
        for edit in audit:
            _, role, text = left.pop(0) if edit != "I" else (0, "", "")
            if edit != "D":
                due = "user" if (length - len(lines)) % 2 == 0 else "assistant"
                lines.append(f"{role if edit == 'K' else due}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = codes.count("b"), codes.count("d"), sum(c.isupper() for c in codes)
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def conversations() -> list[tuple]:
    rnd = random.Random(4)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "usher", "User"]
    texts = ["Yes.", "No!", "Why?", "so", " ", "", None, "a.\n", "b\t", ".", "é."]
    rows = [
        (conv, turn if rnd.random() < 0.93 else None, rnd.choice(roles[: rnd.choice((4, 10))]), f"{rnd.choice(texts) or ''}")
        for conv in range(250)
        for turn in range(rnd.randrange(1, 14))
    ]
    rows += [(None, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(6)]
    rows += [(900, None, None, None), (901, 5, "user", "hello."), (901, 5, "user", "hello."), (902, 2, "system", "only.")]
    return rows + [(903, t, "user", "same.") for t in range(30)]


@pytest.mark.parametrize("limit, segment", [(1024, 512), (4, 3), (2, 1)])
def test_repair_whole_and_in_segments(spark, limit, segment):
    rows = conversations()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, at int, codes string")
    got = repaired(df.repartition(4), limit=limit, segment=segment).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {r[0]: tuple(r)[1:] for r in got} == slow_conversations(rows)


def test_repair_without_rows(spark):
    schema = "conv_id string, turn int, role string, text string"
    assert repaired(spark.createDataFrame([], schema)).collect() == []
    dropped = next(i for i in range(1000) if zlib.crc32(f"c{i}:7".encode()) % 20 == 0)
    got = repaired(spark.createDataFrame([(f"c{dropped}", 7, "user", "x.")], schema)).collect()
    assert [tuple(r) for r in got] == [(f"c{dropped}", 0, 0, 0, 0, 0, 0, "", NOTHING)]


def test_repair_of_a_long_undamaged_conversation(spark):
    rows = [("c", t, "assistant" if t % 2 else "user", f"{t}.") for t in range(3000)]
    got = repaired(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"), damage=False).first()
    lines = "\n".join(f"{r[2]}:{r[3]}" for r in rows)
    assert got["audit"] == "K" * 3000 and got["cost"] == 0 and got["repaired_sha256"] == hashlib.sha256(lines.encode()).hexdigest()


def test_votes_are_those_of_all_pairs():
    rng = np.random.default_rng(5)
    known, vectors = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rng.standard_normal((60, 5)), rng.standard_normal((90, 5))))
    known[10:20] = known[0]
    vectors[3] = 0
    labels = (rng.random(60) < 0.4).astype(float)
    got = votes(vectors, known, labels, 7, block=16)
    for v, score in zip(vectors, got, strict=True):
        cosine = known @ v
        nearest = np.lexsort((np.arange(60), -np.round(cosine, 12)))[:7]
        weight = np.maximum(cosine[nearest], 0)
        want = (weight * labels[nearest]).sum() / weight.sum() if weight.sum() > 0 else labels.mean()
        assert abs(score - want) < 1e-9


def test_terms_do_not_depend_on_the_slice():
    texts = [b"", b"one one one", b"Ab 12!\n", "é ü".encode(), b"a b c a b c a b c", b" "]
    whole = terms(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts]))
    for i, t in enumerate(texts):
        _, term, weight = terms(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert term.tolist() == whole[1][whole[0] == i].tolist() and np.allclose(weight, whole[2][whole[0] == i])
        assert (term < TERMS).all()


def test_quality_of_rows_not_learned_from(spark):
    sf_dir = "/root/testdata/sf0.01"
    if not os.path.isdir(sf_dir):
        pytest.skip("test tables are not here")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = entry.queries()["op13_nearest_neighbours"](spark, sf_dir).join(labels, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("quality") == F.col("predicted")).cast("double"))).first()[0] > 0.95


def test_neighbours_on_edge_rows(spark):
    texts = ["", None, " ", "good plain words here", "BAD!! BAD!! BAD!!", "x" * 200000, "good plain words here"]
    df = spark.createDataFrame([(i, t, 5, 0.5) for i, t in enumerate(texts)] + [(None, "no id", 1, 0.1)], "doc_id long, text string, label int, score double")
    marks = [(3, 1), (4, 0), (6, None), (None, 1), (2, 7), (3, 0), (90, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in neighbour_quality(df, labels).collect()}
    assert len(got) == 8 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert got[3]["score"] == got[6]["score"] and got[None]["held_out"]
    assert [got[i]["held_out"] for i in range(7)] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(7)]
    assert {r["score"] for r in neighbour_quality(df, labels.where("false")).collect()} == {0.0}
    assert neighbour_quality(df.where("false"), labels).collect() == []


def test_shared_strings_find_every_repeated_passage(spark):
    """Every passage of fifty words in two places, however short its words; nothing where no 32 words are repeated."""
    rnd = random.Random(6)

    def prose(n: int, length: int) -> list[str]:
        return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(length, length + 4))) for _ in range(n)]

    passages = [prose(50, n) for n in (2, 4, 9)]
    texts = [" ".join(prose(rnd.randrange(200), 4) + passages[i % 3] + prose(rnd.randrange(200), 4)) for i in range(12)]
    texts += [" ".join(prose(300, 4)) for _ in range(8)]
    texts += [" ".join(passages[0][:31] + prose(60, 4)) for _ in range(4)] + [" ".join(passages[1] + ["x"] + passages[1]), "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["n_shared"] for r in repeated_bytes(df, shared=True).collect()}
    assert all(got[i] > 0 for i in range(12)) and got[24] > 1
    assert all(got[i] == 0 for i in [*range(12, 24), 25, 26])


def test_benchmark_passages_are_found(spark):
    """Documents of the test table that hold a benchmark passage of over fifty words which another one holds too."""
    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("test tables are not here")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").select("text").collect()]
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["n_shared"] for r in repeated_bytes(docs, shared=True).collect()}
    for item in (i for i in items if i and len(i.split()) > 50):
        holders = [d for d, t in texts.items() if item in t]
        if len(holders) > 1:
            assert all(got[d] > 0 for d in holders)
