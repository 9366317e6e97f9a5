"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from growthkit.llm.byte_bpe import decode, encode, token_report
from growthkit.llm.language import languages
from growthkit.llm.near_text import near_duplicates
from growthkit.llm.near_vectors import near_vectors
from growthkit.llm.packing import packed
from growthkit.llm.page_text import main_text
from growthkit.llm.quality import keep_good, quality_report
from growthkit.llm.repeats import repeated_bytes, without_repeats
from growthkit.llm.secret_scan import secrets, without_secrets
from growthkit.llm.toxicity import toxicity

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, tid int, words int, n int, kept int"


def long_text(n: int = 30000) -> str:
    return " ".join(f"w{i % 997}x{i}" for i in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["", None, " \n\t ", "one", "plain words in a row", "plain words in a row", long_text(), "ÄÖ ßé 中文 😀", "12 34 !!"]
    rows = [(i, t, "en" if i % 2 else None, None, None, "c", 1, 2, 3, 4) for i, t in enumerate(texts)]
    rows += [(None, "no id here at all", None, "s", 1, None, None, None, None, None), rows[4], rows[4]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 1), (3, 0, 0), (6, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "secrets": lambda d, l: secrets(d, BYTES, PATTERN),
    "toxicity": lambda d, l: toxicity(d, l),
    "languages": lambda d, l: languages(d),
    "quality": lambda d, l: quality_report(d),
    "repeats": lambda d, l: repeated_bytes(d),
    "tokens": lambda d, l: token_report(d, BYTES, PATTERN),
    "near_text": lambda d, l: near_duplicates(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_document(docs, labels, name):
    got = OPERATORS[name](docs, labels).select("doc_id").collect()
    assert sorted((r[0] is None, r[0] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in docs.select("doc_id").collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(nothing, labels, name):
    assert OPERATORS[name](nothing, labels).count() == 0


def test_empty_packing_pages_and_vectors(spark, nothing):
    assert packed(nothing, WORDS).count() == 0
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_near_text_without_words(docs):
    got = {r["doc_id"]: r for r in near_duplicates(docs).dropDuplicates(["doc_id"]).collect()}
    assert [got[i]["n_shingles"] for i in (0, 1, 2, 3)] == [0, 0, 0, 1]
    assert all(got[i]["component_id"] == i and got[i]["kept"] for i in (0, 1, 2, 3))
    assert (got[5]["component_id"], got[5]["kept"]) == (4, False)
    assert got[None]["component_id"] is None and got[None]["kept"]


def test_secret_defaults(docs):
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    got = secrets(docs, BYTES, PATTERN).where("doc_id < 3").collect()
    assert all((r["base_sha256"], r["spans"], r["n_assign"]) == (empty, "", 0) for r in got)


def test_null_text_stays_null(docs):
    for df in (without_secrets(docs, BYTES, PATTERN), without_repeats(docs)):
        assert df.columns == docs.columns
        assert [r["text"] for r in df.where("doc_id IN (0, 1)").orderBy("doc_id").collect()] == ["", None]
    assert keep_good(docs).columns == docs.columns


def test_language_without_letters(docs):
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in languages(docs).collect()}
    assert all(got[i] == ("und", 0.0) for i in (0, 1, 2, 8))
    assert got[3][0] == "en"


def test_nothing_to_learn_from(docs, labels):
    got = languages(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [r[0] for r in got] == ["und"]
    clean = labels.withColumn("toxic", F.lit(0))
    assert toxicity(docs, clean).agg(F.max("score")).first()[0] == 0.0


def test_encode_and_decode(docs):
    ids = encode(docs, BYTES, PATTERN)
    back = decode(ids, BYTES).withColumnRenamed("bytes", "back")
    both = back.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).join(docs.dropDuplicates(["doc_id"]), "doc_id")
    assert both.where("back <> encode(coalesce(text, ''), 'utf-8')").count() == 0


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (3, [1.0, 0.0], 2, "x"), (4, [1.0, 0.0], None, "x"), (5, None, 1, "x"),
        (6, [0.0, 0.0], 1, "x"), (7, [1.0, None], 1, "x"), (8, [nan, 1.0], 1, "x"), (9, [inf, 1.0], 1, "x"), (10, [], 1, "x"),
        (11, [1.0], 1, "x"), (None, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"), (12, [1e-30, 0.0], 1, "x"),
    ]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int, unit string")
    got = sorted(tuple(r) for r in near_vectors(df).where("vec_id IS NOT NULL").collect())
    linked = [r for r in got if r[1]]
    assert [(r[0], r[1], r[2]) for r in linked] == [(1, 3, 1), (1, 3, 1), (2, 3, 1), (12, 3, 1)]
    assert all(r[2] == r[0] and r[3] for r in got if not r[1])
    alone = near_vectors(df).where("vec_id IS NULL").first()
    assert (alone["n_links"], alone["component_id"], alone["kept"]) == (0, None, True)


def test_page_edges(spark):
    html = {
        1: None,
        2: "",
        3: "just text &amp; more",
        4: "<article><h1>T</h1><p>a<b>b</b> c<br>d<script>var t='</p>';</script></p><nav>x</nav></article><footer>f</footer>",
        5: "<main><p>m</main><p>after",
        7: "<div id='sidebar'>s</div><div class='post-content'><header><h1>H</h1></header>x&nbsp;y<form>q</form></div><p>out",
        6: "<body><div class='comment-list'><p>c</div><article class='post'>p&eacute;<aside>no</aside></article>",
    }
    rows = [(i, None if i == 3 else f"http://h/{i}", h, 7) for i, h in html.items()] + [(4, "http://h/4", html[4], 7)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    text = {r["page_id"]: (r["text"], r["n_chars"]) for r in got}
    assert len(got) == 8
    assert text == {1: ("", 0), 2: ("", 0), 3: ("just text & more", 16), 4: ("T ab c d", 8), 5: ("m", 1), 6: ("pé", 2), 7: ("H x y", 5)}


def test_pieces_of_edge_texts(docs):
    got = packed(docs, WORDS)
    assert got.where("doc_id = 1").select("length", "doc_tokens").first() == (1, 1)
    per = got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"), F.count("*").alias("p"))
    assert per.where("doc_id = 4 AND n = 3 * all").count() == 1  # the row stands three times


def test_boilerplate_of_pages_without_article(spark):
    menu = "home news about shop jobs press help contact login"
    rows = [(i, f"https://h.example/{i}", f"<div><p>{menu}</p><p>{i} stories tell what happened on day {i}</p></div>") for i in range(40)]
    rows += [(100, "https://other.example/", f"<p>{menu}</p>"), (101, "https://h.example/x", f"<article><p>{menu}</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for shard in (512, 10):
        got = {r["page_id"]: r["text"] for r in main_text(df, shard=shard).collect()}
        assert all(got[i] == f"{i} stories tell what happened on day {i}" for i in range(40))
        assert got[100] == got[101] == menu


def test_boilerplate_is_counted_over_all_shards_of_a_host(spark):
    notice = "this notice stands on only three pages of the large host"
    rows = [(i, f"https://h.example/{i}", f"<p>{' '.join(f'w{i}x{k}' for k in range(9))}</p>") for i in range(60)]
    rows = [(i, u, h + f"<p>{notice}</p>" if i in (3, 30, 50) else h) for i, u, h in rows]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for shard in (512, 2):
        got = {r["page_id"]: (r["text"], r["n_boilerplate"]) for r in main_text(df, shard=shard).collect()}
        assert got == {i: (" ".join(f"w{i}x{k}" for k in range(9)), 11 * (i in (3, 30, 50))) for i in range(60)}


def test_boilerplate_of_marked_pages_is_counted(spark):
    menu = "home news about shop jobs press help contact login"
    rows = [(i, f"https://h.example/{i}", f"<nav>{menu}</nav><article>story {i}</article>") for i in range(4)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: (r["text"], r["n_boilerplate"]) for r in got} == {i: (f"story {i}", 9) for i in range(4)}


HARD_PAGES = {
    "<![foo[ x > <article>a b</article>": "a b",
    "<![ x": "",
    "<!doctype html [<!ENTITY x 'y'>]><article>z</article>": "z",
    "<article>a <![CDATA[ b ]]> c <!-- d --> e &amp; f</article>": "a c e & f",
    "<article>x &#xD800; &#99999999; y<!b": "x \ufffd \ufffd y",
    '<div class="content-area no-sidebar"><article>one two</article></div>': "one two",
    '<div class="sidebar widget"><main>one two</main></div>': "one two",
    '<article class="post hentry comments-open">one</article>': "one",
    '<article>a<div class="notice">b</div><p id="related-work">c</p></article>': "a c",
    '<article>main</article><div id="comments"><article class="comment">c1</article></div>': "main",
    '<div id="comments"><article>lone</article></div>': "lone",
    "<article>a<aside>b</aside><nav><p>c</p></nav>d</article>": "a d",
    "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>": "deep",
}


def test_markup_of_any_kind(spark):
    rows = [(i, f"http://h{i}.example/", html) for i, html in enumerate(HARD_PAGES)]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == dict(enumerate(HARD_PAGES.values()))


@pytest.mark.parametrize("shard", [512, 4])
def test_blocks_like_boilerplate_go_where_the_host_repeats_them(spark, shard):
    """A block of an article that is named like an advert, or is all links, goes if the host repeats it; prose never does."""
    advert = " ".join(f"buy{i}" for i in range(12))
    links = " ".join(f"<a href='#'>topic{i} more</a>" for i in range(8))
    prose = " ".join(f"copied{i}" for i in range(30))
    rows = [
        (i, "http://h.example/p", f"<article><p>own{i} text</p><div class='promo-box'>{advert}</div><p>{prose}</p><ul>{links}</ul></article>")
        for i in range(12)
    ]
    rows.append((99, "http://other.example/p", rows[0][2]))
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), shard=shard).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    for i in range(12):
        assert texts[i] == f"own{i} text {prose}"
    assert advert in texts[99] and "topic3 more" in texts[99]


def test_text_of_the_test_pages_is_their_article(spark):
    """Accuracy of the registered query: every page's text, against its article with all tags taken out."""
    import html as references
    import re

    import __spark_entry__ as entry

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in entry.queries()["op2_host_suffix_array"](spark, "/root/testdata/sf0.01").collect()}
    for r in pages.collect():
        inside = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        inside = re.sub("<[^>]*>", " ", re.sub("</?b>", "", inside))
        assert got[r["page_id"]] == " ".join(references.unescape(inside).split())


def test_ids_of_other_types(spark):
    """Ids may be of any type that Spark and Arrow share."""
    for kind in ("short", "decimal(20,0)", "string", "int"):
        rows = spark.createDataFrame([(1, "one two", [1.0, 0.5]), (2, "one two", [1.0, 0.5])], "i int, text string, embedding array<double>")
        rows = rows.select(F.col("i").cast(kind).alias("doc_id"), "text", "embedding", F.lit(1).alias("label"))
        assert packed(rows, WORDS).schema["doc_id"].dataType == rows.schema["doc_id"].dataType
        assert {str(r["doc_id"]) for r in packed(rows, WORDS).collect()} == {"1", "2"}
        assert [r["n_links"] for r in near_vectors(rows, id="doc_id").collect()] == [1, 1]


def test_many_tiny_texts(spark):
    """Rows are bounded by bytes of text; many texts of a few bytes must not take memory for each."""
    df = spark.range(10000).select(F.col("id").alias("doc_id"), F.concat(F.lit("to be "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    got = languages(df.coalesce(1)).groupBy("lang_pred").count().collect()
    assert [tuple(r) for r in got] == [("en", 10000)]
