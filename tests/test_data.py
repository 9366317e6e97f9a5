"""Sources, quality reports, preprocessing and marts on tiny tables with awkward rows."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthkit.operators import explore, marts, prepare, quality, unit_econ
from growthkit.session import scratch_path
from growthkit.sources import tables
from growthkit.sources.tables import load_tables, read_csv, write_slice

GAMES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("sales", T.DoubleType()),
        T.StructField("user_score", T.StringType()),
    ]
)


@pytest.fixture
def games(spark, tmp_path):
    path = tmp_path / "games.csv"
    path.write_text(
        "name,platform,year,sales,user_score\n"
        "Maze,PC,2001,1.5,8.1\n"
        "Maze,PC,2001,1.5,8.1\n"
        "Ring,PS,,0.2,tbd\n"
        "Odd,PC,later,0.3,7\n"
        "Short,PC\n"
        '"Comma, The",PS,2003,2,\n'
    )
    return read_csv(spark, str(path), GAMES)


class TestSources:
    def test_bad_csv_rows_are_kept_and_countable(self, games):
        assert games.count() == 6
        bad = [r["name"] for r in games.select("name", "_corrupt").where("_corrupt IS NOT NULL").collect()]
        assert sorted(bad) == ["Odd", "Short"]
        odd = games.where("name = 'Odd'").first()
        assert odd["year"] is None and odd["sales"] == 0.3 and odd["_corrupt"] == "Odd,PC,later,0.3,7"
        assert games.agg(F.count("_corrupt")).first()[0] == 2

    def test_slice_round_trip(self, spark, games, tmp_path, rows):
        part = prepare.slice_(games, F.col("platform") == "PC", ["name", "platform", "sales"])
        path = str(tmp_path / "out")
        write_slice(part, path, "platform")
        back = spark.read.parquet(path).select("name", "platform", "sales")
        assert rows(back) == rows(part)
        with pytest.raises(Exception, match="(?i)exist"):
            write_slice(part, path)

    def test_views(self, spark, tmp_path):
        spark.range(3).write.parquet(str(tmp_path / "numbers.parquet"))
        tables = load_tables(spark, str(tmp_path), ["numbers"], views=True)
        assert tables["numbers"].count() == spark.sql("SELECT count(*) FROM numbers").first()[0] == 3

    def test_scratch_follows_the_session(self, spark):
        shared = spark.conf.get("spark.checkpoint.dir")
        one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
        assert one.startswith(shared) and two.startswith(shared) and one != two


class TestQuality:
    @pytest.mark.parametrize("exact", [True, False])
    def test_profile(self, spark, rows, exact):
        df = spark.createDataFrame([(1, "a"), (2, None), (2, "a"), (None, None)], "x int, y string")
        got = rows(quality.profile(df, exact=exact).select("col", "n", "nulls", "n_distinct"))
        assert got == [("x", 4, 1, 2), ("y", 4, 2, 1)]

    def test_null_breaks_a_rule(self, spark):
        df = spark.createDataFrame([(1.0,), (-1.0,), (None,), (5.0,)], "amount double")
        got = quality.check_rules(df, {"positive": F.col("amount") > 0}).first()
        assert tuple(got) == ("positive", 2, 0.5)

    def test_rules_on_no_rows(self, spark):
        df = spark.createDataFrame([], "amount double")
        assert tuple(quality.check_rules(df, {"positive": F.col("amount") > 0}).first()) == ("positive", 0, None)

    def test_duplicates_count_null_keys(self, spark):
        df = spark.createDataFrame([(1,), (1,), (None,), (None,), (3,)], "k int")
        assert tuple(quality.duplicates(df, "k").first()) == (5, 3, 2)
        assert tuple(quality.duplicates(df.limit(0), "k").first()) == (0, 0, 0)

    def test_orphans(self, spark, rows):
        child = spark.createDataFrame([(1, 10), (2, 99), (3, None), (4, 99)], "id int, parent int")
        parent = spark.createDataFrame([(10,), (None,)], "id int")
        assert [r[0] for r in rows(quality.orphans(child, parent, {"parent": "id"}))] == [2, 3, 4]
        assert tuple(quality.orphan_report(child, parent, {"parent": "id"}).first()) == (2, 3)


class TestPrepare:
    def test_coerce(self, spark):
        df = spark.createDataFrame([("8.1",), (" 7 ",), ("tbd",), (None,)], "score string")
        got = [tuple(r) for r in prepare.coerce(df, {"score": "double"}).collect()]
        assert got == [(8.1, False), (7.0, False), (None, True), (None, False)]

    def test_coerce_dates(self, spark):
        df = spark.createDataFrame([("2024-02-30",), ("2024-02-29",)], "d string")
        got = [tuple(r) for r in prepare.coerce(df, {"d": "date"}).collect()]
        assert got == [(None, True), (dt.date(2024, 2, 29), False)]

    def test_normalize(self, spark):
        df = spark.createDataFrame([("  RPG ",), ("Ёлка   Ель",), (None,)], "t string")
        got = [r[0] for r in prepare.normalize(df, "t", {"ё": "е"}).collect()]
        assert got == ["rpg", "елка ель", None]

    def test_fill(self, spark, rows):
        data = [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, 9.0), (None, None)]
        df = spark.createDataFrame(data, "g string, x double")
        by_median = [r[1] for r in rows(prepare.fill_missing(df, "x", by="g"))]
        assert sorted(by_median, key=str) == sorted([1.0, 3.0, 2.0, None, 9.0, 9.0], key=str)
        overall = prepare.fill_missing(df, "x", stat="mean").where("g = 'b'").first()["x"]
        assert overall == pytest.approx(13 / 3)
        assert prepare.fill_missing(df, {"x": 0.0}).where("x = 0").count() == 3
        with pytest.raises(ValueError):
            prepare.fill_missing(df, "x", stat="mode")

    def test_fill_with_one_huge_group_of_copies(self, spark):
        df = spark.createDataFrame([("a", None)] * 500 + [("a", 4.0)], "g string, x double").repartition(4)
        filled = prepare.fill_missing(df, "x", by="g")
        assert filled.count() == 501 and filled.where("x = 4").count() == 501

    def test_dedupe(self, spark, rows):
        df = spark.createDataFrame([(1, 5, "x"), (1, 3, "y"), (2, 1, "z"), (None, 2, "n"), (None, 1, "m")], "k int, o int, v string")
        assert [r[2] for r in rows(prepare.dedupe(df, "k", "o"))] == ["m", "y", "z"]
        assert [r[2] for r in rows(prepare.dedupe(df, "k", F.col("o").desc()))] == ["n", "x", "z"]

    def test_band_edges(self, spark):
        df = spark.createDataFrame([(0.0,), (10.0,), (10.1,), (20.0,), (21.0,), (None,)], "x double")
        got = [r[0] for r in prepare.band(df, "x", [10, 20], ["low", "mid", "top"], name="b").select("b").collect()]
        assert got == ["low", "low", "mid", "mid", "top", "None"]
        auto = [r[0] for r in prepare.band(df, "x", [10, 20]).select("x_band").collect()]
        assert auto == ["<=10", "<=10", "(10, 20]", "(10, 20]", ">20", "None"]
        with pytest.raises(ValueError):
            prepare.band(df, "x", [1], ["only"])
        with pytest.raises(ValueError, match="rise"):
            prepare.band(df, "x", [20, 10], ["a", "b", "c"])
        nan = df.select(F.lit(float("nan")).alias("x")).limit(1)
        assert prepare.band(nan, "x", [10]).first()["x_band"] == "None"

    def test_fence(self, spark):
        df = spark.range(101).select(F.col("id").cast("double").alias("x"), F.lit("g").alias("g"))
        df = df.unionByName(spark.createDataFrame([(None, "g")], "x double, g string"))
        assert prepare.fence(df, "x", 0.05, 0.95).count() == 91
        assert prepare.fence(df, "x", 0.05, 0.95, by="g").count() == 91

    def test_drop_missing(self, spark):
        df = spark.createDataFrame([(1, None), (2, 3), (None, 4)], "a int, b int")
        assert prepare.drop_missing(df, "a").count() == 2
        assert prepare.drop_missing(df, ["a", "b"]).count() == 1

    def test_enrich(self, spark, rows):
        venues = spark.createDataFrame([(1, "cafe"), (2, "bar")], "id int, kind string")
        prices = spark.createDataFrame([(1, 500.0), (9, 100.0)], "id int, avg_check double")
        assert rows(prepare.enrich(venues, prices, "id")) == [(1, "cafe", 500.0), (2, "bar", None)]
        twice = prices.unionByName(spark.createDataFrame([(1, 700.0)], "id int, avg_check double"))
        with pytest.raises(Exception, match="not a key"):
            prepare.enrich(venues, twice, "id").collect()
        unknown = prices.unionByName(spark.createDataFrame([(None, 7.0), (None, 8.0)], "id int, avg_check double"))
        assert prepare.enrich(venues, unknown, "id").count() == 2
        assert prepare.enrich(venues, twice, "id", check=False).count() == 3

    def test_flag_exists(self, spark, rows):
        players = spark.createDataFrame([(1,), (2,), (3,)], "id int")
        buys = spark.createDataFrame([(1,), (1,), (7,)], "id int")
        assert rows(prepare.flag_exists(players, buys, "id", "payer")) == [(1, True), (2, False), (3, False)]


class TestMart:
    def test_totals_differ_from_unknown(self, spark):
        df = spark.createDataFrame([("a", "x", 1), (None, "x", 2), ("a", "y", 3)], "p string, q string, v int")
        cube = marts.mart(df, ["p", "q"], {"v": F.sum("v")})
        assert cube.columns == ["p", "q", "v", "g_p", "g_q"]
        total = cube.where("g_p = 1 AND g_q = 1").collect()
        unknown = cube.where("p IS NULL AND g_p = 0 AND g_q = 1").collect()
        assert ([r["v"] for r in total], [r["v"] for r in unknown]) == ([6], [2])
        assert marts.mart(df, ["p", "q"], {"v": F.sum("v")}, [["p"], []]).count() == 3


class TestCsvFiles:
    SCHEMA = "a int, b string"

    def read(self, spark, tmp_path, text, **options):
        from pyspark.sql.types import _parse_datatype_string

        path = tmp_path / "t.csv"
        path.write_bytes(text)
        return read_csv(spark, str(path), _parse_datatype_string(self.SCHEMA), **options)

    def test_columns_are_found_by_name(self, spark, rows, tmp_path):
        assert rows(self.read(spark, tmp_path, b"b,a\nx,1\ny,2\n")) == [(1, "x", None), (2, "y", None)]

    def test_other_header_is_an_error(self, spark, tmp_path):
        for header in (b"a,c\n1,x\n", b"a\n1\n", b"a,b,c\n1,x,2\n"):
            with pytest.raises(ValueError, match="header"):
                self.read(spark, tmp_path, header)

    def test_line_breaks_in_quotes(self, spark, rows, tmp_path):
        got = rows(self.read(spark, tmp_path, b'a,b\n1,"x\ny"\n2,z\n', multiline=True))
        assert got == [(1, "x\ny", None), (2, "z", None)]

    def test_encoding(self, spark, rows, tmp_path):
        got = rows(self.read(spark, tmp_path, "a,b\n1,café\n".encode("latin-1"), encoding="ISO-8859-1"))
        assert got == [(1, "café", None)]


def test_profile_takes_both_zeros_as_one_value(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert quality.profile(df).first()["n_distinct"] == 2


def test_slices_are_written_in_few_files(spark, tmp_path):
    df = spark.range(4000).select("id", (F.col("id") % 20).alias("g")).repartition(8)
    write_slice(df, str(tmp_path / "slice"), "g")
    files = list((tmp_path / "slice").rglob("*.parquet"))
    assert len(files) == 20
    assert spark.read.parquet(str(tmp_path / "slice")).count() == 4000


def test_medians_of_several_columns_share_one_pass(spark, rows):
    df = spark.createDataFrame([("g", 1.0, None), ("g", None, 4), ("g", 3.0, 8), (None, None, 5)], "k string, x double, y int")
    assert rows(prepare.fill_missing(df, ["x", "y"], "k")) == [(None, None, 5.0), ("g", 1.0, 6.0), ("g", 2.0, 4.0), ("g", 3.0, 8.0)]


class TestLargeResults:
    """Forms for results that no one task may hold, against the plain ones."""

    @pytest.mark.parametrize("tie", [["id"], ["name", "id"], []])
    def test_top_k_of_half_a_table(self, spark, tie):
        value = "CASE WHEN id % 3 = 0 THEN 5D WHEN id % 11 = 0 THEN double('NaN') WHEN id % 13 = 0 THEN NULL ELSE pmod(hash(id), 997) / 7 END"
        df = spark.range(3000).selectExpr("id", f"{value} AS v", "concat('n', id % 100) AS name", "id AS rank_of")
        got = explore.top_k(df, "v", 1500, tie=tie, one_task=10).collect()
        assert sorted(r["rank"] for r in got) == list(range(1, 1501))
        want = explore.top_k(df, "v", 1500, tie=tie).collect()

        def known(v):
            return None if v is None or v != v else v

        if tie:
            assert {(r["id"], r["rank"]) for r in got} == {(r["id"], r["rank"]) for r in want}
        assert {(r["rank"], known(r["v"])) for r in got} == {(r["rank"], known(r["v"])) for r in want}

    def test_top_k_of_unknown_values_only(self, spark):
        df = spark.range(100).selectExpr("id", "CAST(NULL AS DOUBLE) AS v")
        assert {(r["id"], r["rank"]) for r in explore.top_k(df, "v", 40, tie="id", one_task=10).collect()} == {(i, i + 1) for i in range(40)}
        assert explore.top_k(df.where("false"), "v", 40, tie="id", one_task=10).collect() == []

    def test_unknown_numbers_come_last(self, spark):
        df = spark.createDataFrame([(1, float("nan")), (2, 3.0), (3, None), (4, float("inf"))], "id int, v double")
        assert [r["id"] for r in explore.top_k(df, "v", 4, tie="id").orderBy("rank").collect()] == [4, 2, 1, 3]
        shares = {r["id"]: r["share"] for r in explore.market_share(df.where("id < 4"), "id", "v").collect()}
        assert shares == {1: None, 2: 1.0, 3: None}

    def test_mart_from_the_finest_grain_equals_plain_aggregates(self, spark):
        df = spark.range(500).selectExpr("CASE WHEN id % 7 > 0 THEN id % 5 END AS a", "id % 3 AS b", "CASE WHEN id % 4 > 0 THEN id END AS v")
        named = {"n": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")}
        plain = {"n": F.count("v"), "s": F.sum("v"), "lo": F.min("v"), "hi": F.max("v"), "m": F.avg("v")}
        for sets in (None, [["a", "b"], ["b"], []], [["b"]]):
            got, want = (marts.mart(df, ["a", "b"], m, sets) for m in (named, plain))
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert [marts.mart(df.where("false"), ["a"], m).collect() for m in (named, plain)] == [[], []]

    def test_mart_multiplies_aggregated_rows_only(self, spark):
        df = spark.range(500).selectExpr("id % 5 AS a", "id % 3 AS b", "id AS v")
        text = marts.mart(df, ["a", "b"], {"s": ("sum", "v")})._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" in text.split("Expand")[1]

    def test_stored_profiles_add_up(self, spark):
        df = spark.range(20000).selectExpr("id", "id % 50 AS few", "CASE WHEN id % 2 = 0 THEN id / 3 END AS half", "date_add(DATE'2024-01-01', CAST(id % 365 AS INT)) AS day")
        days = [quality.profile_sketches(df.where(f"id % 4 = {i}")) for i in range(4)]
        merged = quality.profile_of(days[0].union(days[1]).union(days[2]).union(days[3]))
        got = {r["col"]: r for r in merged.collect()}
        want = {r["col"]: r for r in quality.profile(df, exact=True).collect()}
        for col, r in want.items():
            assert (got[col]["n"], got[col]["nulls"]) == (r["n"], r["nulls"])
            assert got[col]["n_distinct"] == pytest.approx(r["n_distinct"], rel=0.08)
        text = quality.profile(df)._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in text.split("Exchange")[-1] and "hll_sketch_agg" in text

    def test_fill_keeps_types(self, spark):
        df = spark.createDataFrame([("a", 2**60 + 1, 1.5), ("a", 2**60 + 4, None), ("a", None, 2.5)], "g string, x long, y double")
        for stat in ("median", "mean"):
            out = prepare.fill_missing(df, ["x", "y"], "g", stat)
            assert out.schema == df.schema
            assert sorted(r["x"] for r in out.collect()) == [2**60 + 1, 2**60 + 3, 2**60 + 4]
            assert sorted(r["y"] for r in out.collect()) == [1.5, 2.0, 2.5]
        with pytest.raises(ValueError):
            prepare.fill_missing(df, {"x": 1.5})

    def test_bucketed_events_meet_first_days_where_they_lie(self, spark):
        events = spark.range(4000).selectExpr("id % 40 AS user", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, CAST(id % 60 AS INT)) AS ts")
        start = events.groupBy("user").agg(F.min("ts").alias("first"))
        name = f"events_{uuid.uuid4().hex}"
        stored = tables.write_bucketed(events, name, "user", 4, "ts")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            young = unit_econ.within_age(stored, start, "user", "ts", "first", 28)
            text = young._jdf.queryExecution().executedPlan().toString()
            assert text.count(f"{name}[") + text.count(f"{name} ") >= 1 and text.split(name)[0].count("Exchange") == 0
            assert young.count() == unit_econ.within_age(events, start, "user", "ts", "first", 28).count()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.sql(f"DROP TABLE {name}")
