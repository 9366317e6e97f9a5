"""Operators against slow forms of the same definition, on generated texts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from growthkit.llm import near_text, repeats
from growthkit.llm.bpe import Merges
from growthkit.llm.byte_bpe import fold_words, rank_file, token_report
from growthkit.llm.components import components
from growthkit.llm.near_vectors import near_vectors
from growthkit.llm.packing import Packer, packed
from growthkit.llm.page_text import boilerplate
from growthkit.llm.repeats import repeated_bytes, without_repeats
from growthkit.llm.secret_scan import base_spans, secrets
from growthkit.llm.superminhash import bands, signatures

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def connected(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    want = connected({x for e in edges for x in e if e[0] != e[1]}, edges)
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert got == want


def test_superminhash_is_unbiased_and_bands_agree():
    rng = np.random.default_rng(3)
    found = []
    for _ in range(80):
        u = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
        ranks = signatures([np.sort(u[:30]), np.sort(u[10:])], 252)
        found.append((ranks[0] == ranks[1]).mean())
    assert np.mean(found) == pytest.approx(0.5, abs=0.02)
    assert np.std(found) < (0.25 / 252) ** 0.5  # less than independent hashes would give
    same = signatures([u, u[::-1].copy()], 252)
    assert (bands(same, 6)[0] == bands(same, 6)[1]).all()


def variants(seed: int, families: int = 12) -> list[str]:
    """Texts in families of near copies at all distances, among them chains and many copies."""
    rnd = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    texts = []
    for f in range(families):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 8, 40, 120]))]
        for _ in range(rnd.choice([1, 4, 15])):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 12))):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            texts.append(rnd.choice([" ", "\n", "  "]).join(text).replace("w1", rnd.choice(["w1", "W1"])))
            base = text if rnd.random() < 0.4 else base
    return texts + ["", "one", "One", "one two", " "]


def shingle_set(text: str, k: int) -> frozenset:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


@pytest.mark.parametrize("k,block,held", [(2, 1024, 1 << 26), (5, 1024, 1 << 26), (2, 3, 0)])
def test_near_text(spark, monkeypatch, k, block, held):
    monkeypatch.setattr(near_text, "BLOCK", block)
    monkeypatch.setattr(near_text, "SET_BYTES", held)
    texts = variants(k)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    sets = {i: shingle_set(t, k) for i, t in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = connected(sets, links)
    got = near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=k).collect()
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def repeated_slow(texts: list[bytes], length: int) -> list[np.ndarray]:
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("shard", [{}, {"shard_contexts": 2, "shard_bytes": 500}], ids=["one", "many"])
def test_repeats(spark, shard):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    shared = [" ".join(word() for _ in range(30)) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rnd.randint(0, 25))) for _ in range(3)]
        parts.insert(1, rnd.choice(shared)[rnd.randint(0, 40) : rnd.randint(60, 140)])
        texts.append(" ".join(parts))
    texts += [texts[0], "a" * 200, "ab" * 150, "", "x" * 49, "x" * 50, "é" * 40, "\0" * 60 + texts[3]]
    raw = [t.encode() for t in texts]
    gone = repeated_slow(raw, 50)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in repeated_bytes(df, length=50, **shard).collect()}
    for i, (t, g) in enumerate(zip(raw, gone, strict=True)):
        runs = int((np.diff(np.concatenate(([0], g.astype(int)))) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~g].tobytes()
        assert got[i] == (len(t), int(g.sum()), runs, hashlib.sha256(kept).hexdigest()), i
    stripped = dict(without_repeats(df, length=50, **shard).collect())
    for i, (t, g) in enumerate(zip(raw, gone, strict=True)):
        assert stripped[i].encode().replace("é".encode(), b"") == np.frombuffer(t, np.uint8)[~g].tobytes().replace("é".encode(), b"").decode("utf-8", "ignore").encode() or "é" in texts[i]


def test_copies_of_a_text_are_cut_out_once(spark, monkeypatch):
    shared = "".join(f"s{i} " for i in range(30))
    text, variant = (shared + "".join(f"{c}{i} " for i in range(60)) for c in "ab")
    df = spark.createDataFrame([(i, variant if i == 0 else text) for i in range(200)], "doc_id long, text string").repartition(4)
    frames = {}
    kept = repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda d, label: frames.setdefault(label, kept(d, label)))
    got = {r["doc_id"]: r["n_removed"] for r in repeated_bytes(df, length=50).collect()}
    assert got == {i: len(shared) if i == 0 else len(text) for i in range(200)}
    cut = frames["cut"]
    assert 0 < cut.count() == cut.dropDuplicates(["gram", "context"]).count()


def test_merges_equal_the_library():
    ranks = rank_file(BYTES)
    library = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    left, right, merged = zip(
        *[(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks],
        strict=True,
    )
    first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    rnd = random.Random(2)
    words = [bytes(rnd.choice(b"abcdefgh") for _ in range(rnd.choice([1, 2, 5, 30, 1500]))) for _ in range(120)]
    offsets = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    ids, before = Merges(left, right, merged, merged).fold(first[np.frombuffer(b"".join(words), np.uint8)], offsets)
    for i, w in enumerate(words):
        assert ids[before[i] : before[i + 1]].tolist() == library.encode_ordinary(w.decode())


ODD = "abcXYZ éÉßİıſσΣς'́   \x1c\x85\n\t ..,;-_#$0129٣中文😀<|endoftext|>'s't're ẞ  ŉ×÷"


def odd_texts(seed: int) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 60))) for _ in range(800)] + ["a" * 2500, " " * 300 + "x"]


def test_byte_tokens(spark):
    library = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=rank_file(BYTES), special_tokens={})
    texts = odd_texts(4)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in token_report(df, BYTES, PATTERN).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_native_fold(spark):
    library = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=rank_file(BYTES), special_tokens={})
    words = ["", "a", " the", " words", "éé", "0000", " inevitably", "qqqq"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for r in fold_words(df, "w", BYTES).collect():
        assert r["ids"] == library.encode_ordinary(r["w"])


def test_packing(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    texts = odd_texts(6) + ["word " * n for n in (1, 2046, 2047, 2048, 5000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    pieces = packed(df, WORDS).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for p in sorted(rows, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and at & (at - 1) == 0


def test_level_minimises_the_sum_of_squares():
    rnd = random.Random(8)
    packer = Packer(32, 0)
    for i in range(300):
        size = rnd.randint(1, 31)
        options = {}
        for level in [0, *np.flatnonzero(packer.count[: 33 - size])]:
            after = packer.count.copy()
            after[level] -= level > 0
            after[level + size] += level + size < 32
            options[int(level)] = int((after[1:32] ** 2).sum())
        assert options[packer.level(size)] == min(options.values())
        packer.add(i, np.arange(size))
    packer.finish()
    assert sum(r[2] for r in packer.rows) == sum(r[2] for r in {(r[0], r[1]): r for r in packer.rows}.values())


def test_windows_stay_as_the_rule_filled_them():
    """Only what padding forces is cut: the emptiest open windows, whose tokens fill the gaps of the others."""
    rnd = random.Random(9)
    for sizes in ([33 + i % 7 for i in range(200)], [rnd.randint(1, 200) for _ in range(300)], [5], [64], [1, 62], [40, 40]):
        packer = Packer(64, 0)
        for i, n in enumerate(sizes):
            packer.add(i, np.arange(n))
        still = [list(w) for level in reversed(packer.open) for w in level]
        packer.finish()
        pieces = sorted((r[0], r[1], r[2]) for r in packer.rows)
        for i, n in enumerate(sizes):
            own = [(start, length) for id, start, length in pieces if id == i]
            assert [start for start, _ in own] == [sum(k for _, k in own[:j]) for j in range(len(own))]
            assert sum(k for _, k in own) == n
        fill = Counter()
        for r in packer.rows:
            assert r[6] == fill[r[5]]
            fill[r[5]] += r[2]
        assert all(f == 64 or f & (f - 1) == 0 for f in fill.values())
        assert sum(f != 64 for f in fill.values()) <= 6
        # the windows that were not taken apart still hold their pieces, whole
        spare = sum(sum(len(p[2]) for p in w) for w in still)
        gaps, kept = 0, 0
        for w in still:
            size = sum(len(p[2]) for p in w)
            spare, gaps = spare - size, gaps + 64 - size
            if gaps > spare:
                break
            kept += 1
        placed = {(r[0], r[1], r[2]): r[5] for r in packer.rows}
        for w in still[:kept]:
            assert len({placed[p[0], p[1], len(p[2])] for p in w}) == 1


@pytest.mark.parametrize("pivots,block", [(1, 1024), (4, 7)])
def test_near_vectors(spark, monkeypatch, pivots, block):
    from growthkit.llm import near_vectors as module

    monkeypatch.setattr(module, "PER_PIVOT", 20)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(260):
        v = centres[i % 12] + rng.normal(scale=rng.choice([0.0, 0.05, 0.15, 1.0]), size=16)
        rows.append((i, v.astype(np.float32).tolist(), int(i % 12 % 3)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = connected(range(260), zip(*np.nonzero(near), strict=True))
    got = near_vectors(df, pivots=pivots, block=block).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(near.sum(axis=1).tolist()))
    assert {r["vec_id"]: r["component_id"] for r in got} == want


def test_boilerplate():
    rnd = random.Random(4)
    line = [rnd.randrange(10**6) for _ in range(10)]
    pages = [[rnd.randrange(10**6) for _ in range(20)] for _ in range(5)]
    pages = [p[:i] + line + p[i:] for i, p in enumerate(pages)] + [line[:7], [], line * 2]
    for run, least in ((8, 3), (10, 6), (11, 2)):
        seen = defaultdict(set)
        for i, p in enumerate(pages):
            for a in range(len(p) - run + 1):
                seen[tuple(p[a : a + run])].add(i)
        got = boilerplate([np.array(p, np.int64) for p in pages], run, least)
        for p, g in zip(pages, got, strict=True):
            want = np.zeros(len(p), bool)
            for a in range(len(p) - run + 1):
                if len(seen[tuple(p[a : a + run])]) >= least:
                    want[a : a + run] = True
            assert (g == want).all()


def test_secret_spans(spark):
    key = "AKIA" + "Z7Q" * 6
    texts = [
        f"é Password: 'abc123' token=abc x {key} {'0af' * 8}",
        "secret: secret: abcdefgh API-KEY=zzzzzzz apikey = zzzzzzz",
        "ref 8f14e45fceea167a5a36dedd4bea2543 and 123e4567-e89b-12d3-a456-426614174000 and 4532015112830366",
        "use kX9vQ2mZ8rT4wB7nL3pJ6sD1 now",
        "supercalifragilisticexpialidocious internationalization",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in secrets(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN).collect()}
    for i, t in enumerate(texts):
        listed = ",".join(f"{k}:{a}:{b}" for a, b, k in base_spans(t))
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    assert (got[0]["n_assign"], got[0]["n_access"], got[0]["n_hex"]) == (1, 1, 1)
    assert got[0]["spans"].startswith("assign:2:19,access:33:")
    assert [got[i]["n_random"] for i in range(5)] == [0, 0, 0, 1, 0]
    assert got[1]["n_assign"] == 2


def test_letters_alone_may_be_secrets(spark):
    texts = ["use JBSWYDPEBLWKQZXCVBNMHTRE now", "kxqvzmwrtpbnlsjdfghyc", "abcdefghijklmnopqrstuvwxyz", "enpfauungeinachiesch word", "1" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN).collect()}
    assert got == {0: "random:4:28", 1: "random:0:21", 2: "", 3: "", 4: "hex:0:30"}


def slow_base_spans(text: str) -> str:
    """The fixed patterns, character by character, without regular expressions."""
    spans = []
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
    lower = "".join(c.lower() if c.isascii() else c for c in text)

    def runs(allowed: set, start: int) -> int:
        end = start
        while end < len(text) and text[end] in allowed:
            end += 1
        return end

    at = 0
    while at < len(text):
        word = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if lower.startswith(w, at)), None)
        found = None
        if word:
            p = at + len(word)
            for quote in (1, 0):
                q = p + 1 if quote and text[p : p + 1] in ("'", '"') and p < len(text) else p
                while text[q : q + 1] == " ":
                    q += 1
                if text[q : q + 1] in (":", "=") and q < len(text):
                    q += 1
                    while text[q : q + 1] == " ":
                        q += 1
                    for skip in (1, 0):
                        start = q + 1 if skip and q < len(text) and text[q] in "'\"" else q
                        if runs(value, start) > start:
                            found = start, runs(value, start)
                            break
                if found:
                    break
        if found:
            if found[1] - found[0] >= 6:
                spans.append((at, 0, f"assign:{at}:{found[1]}"))
            at = found[1]
        else:
            at += 1
    for kind, prefix, allowed, least in ((1, "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20), (2, "", set("0123456789abcdef"), 24)):
        at = 0
        while at < len(text):
            end = runs(allowed, at + len(prefix)) if text.startswith(prefix, at) else at
            if end > at + len(prefix):
                if end - at >= least:
                    spans.append((at, kind, f"{('', 'access', 'hex')[kind]}:{at}:{end}"))
                at = end
            else:
                at += 1
    return ",".join(x[2] for x in sorted(spans))


def test_fixed_secret_patterns_by_hand(spark):
    rnd = random.Random(11)
    signs = ["password", "PassWd", "secret", "Token", "api_key", "APIKEY", "apiKey", ":", "=", " ", "'", '"', "AKIA", "Z7", "abc123", "0af", "é", "."]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(60))) for _ in range(300)] + ["AKIA" + "Q" * 16, "f" * 24, "f" * 23]
    texts += [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if r[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["base_sha256"] for r in secrets(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN).collect()}
    assert got == {i: hashlib.sha256(slow_base_spans(t).encode()).hexdigest() for i, t in enumerate(texts)}
