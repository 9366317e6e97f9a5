"""The registered queries: columns of their contracts, one row for each row of their table, and the SQL form."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")

COLUMNS = {
    "op1_token_efficiency": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op2_host_suffix_array": "page_id url text n_chars",
    "op3_positive_unlabelled": "doc_id held_out score predicted",
    "op4_hierarchical_svm": "doc_id held_out lang_pred score",
    "op5_threshold_table": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op6_suffix_array": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op7_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op8_sum_of_squares": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op9_superminhash": "doc_id n_shingles component_id kept",
    "op10_pivot_range_join": "vec_id n_links component_id kept",
    "op11_merge_path": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    "op12_wagner_fischer": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op13_nearest_neighbours": "doc_id held_out score predicted",
}


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    got = entry.queries()[name](spark, DATA)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    of = {"op2_host_suffix_array": ("pages", "page_id"), "op10_pivot_range_join": ("embeddings", "vec_id")}
    of["op12_wagner_fischer"] = ("conversations", "conv_id")
    source, key = of.get(name, ("documents", "doc_id"))
    rows = got.select(key).distinct() if name == "op8_sum_of_squares" else got.select(key)
    given = table(spark, source).select(key)
    given = given.distinct() if name == "op12_wagner_fischer" else given
    assert sorted(r[0] for r in rows.collect()) == sorted(r[0] for r in given.collect())


def test_quality_equals_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    got = entry.queries()["op5_threshold_table"](spark, DATA)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    cursor = con.execute(entry.oracle_sql()["op5_threshold_table"])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(cursor.fetchall()) == sorted(tuple(r) for r in got.select(*names).collect())


def test_models_hold_on_rows_they_did_not_learn_from(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = entry.queries()["op4_hierarchical_svm"](spark, sf_dir).where("held_out").join(langs, "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = entry.queries()["op3_positive_unlabelled"](spark, sf_dir).where("held_out").join(labels, "doc_id")
    mean = dict(scored.groupBy("toxic").agg(F.avg("score")).collect())
    assert mean[1] > 0.6 > 0.5 > mean[0]


def test_stages(spark):
    docs = table(spark, "documents")
    kept = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        if name != "packing":
            assert out.columns == kept
            assert out.where("n_chars <> length(text)").count() == 0
            assert out.count() <= docs.count()
        docs = corpus_pipeline.stored(out, name)
    assert docs.columns == COLUMNS["op8_sum_of_squares"].split()
    assert corpus_pipeline.run(spark, DATA).agg(F.sum("length")).first() == docs.agg(F.sum("length")).first()


def test_stages_take_effect(spark):
    clean = " ".join(f"the word{i} of and{i}" for i in range(40))
    near = clean.replace("word7 ", "other ")
    shared = " ".join(f"of{i} shared{i} the" for i in range(40))
    rows = [
        (1, clean),
        (2, clean),
        (3, near),
        (4, "too short"),
        (5, " ".join(f"the left{i} of" for i in range(60)) + " " + shared),
        (6, shared + " " + " ".join(f"and right{i} the" for i in range(60)) + " password=hunter2hunter2 the end"),
        (None, " ".join(f"the lone{i} of" for i in range(60))),
        (6, shared + " " + " ".join(f"and right{i} the" for i in range(60)) + " password=hunter2hunter2 the end"),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], table(spark, "documents").schema)
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, DATA)
    assert sorted(str(r[0]) for r in good.select("doc_id").collect()) == sorted("1 2 3 5 6 6 None".split())
    single = stages["near_duplicate"](spark, good, DATA)
    assert sorted(str(r[0]) for r in single.select("doc_id").collect()) == sorted("1 5 6 None".split())
    text = dict(stages["repeats"](spark, single, DATA).select("doc_id", "text").collect())
    assert "shared20" not in text[5] + text[6] and "left59" in text[5] and "right0" in text[6] and text[1] == clean
    hidden = dict(stages["secret"](spark, single, DATA).select("doc_id", "text").collect())
    assert "hunter2" not in hidden[6] and "[SECRET] the end" in hidden[6] and hidden[1] == clean


def test_repeats_of_short_words(spark):
    def letters(seed: int, n: int) -> str:
        return " ".join(chr(97 + (seed + i * i * i + i // 7) % 26) for i in range(n))

    passage, few = letters(3, 51), " ".join(f"f{i % 7}{i}" for i in range(45))
    assert len(passage) == 101 and len(few) < 250
    own = [" ".join(f"document{d}word{i}" for i in range(30)) for d in range(4)]
    texts = [f"{own[0]} {passage} {own[1]}", f"{own[2]}\n{passage}", f"{own[3]} {few}", f"{few} {own[1][::-1]}"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], table(spark, "documents").schema)
    got = dict(corpus_pipeline.repeats(spark, docs, DATA).select("doc_id", "text").collect())
    assert got == {0: f"{own[0]}  {own[1]}", 1: f"{own[2]}\n", 2: texts[2], 3: texts[3]}
