"""Every registered query against its SQL form on the given tables."""

from __future__ import annotations

import datetime as dt
import math
import os

import pytest

import __spark_entry__ as entry
from growthkit.plans import catalog

duckdb = pytest.importorskip("duckdb")

DATA = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents labels".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = in_order(tuple(r[c] for c in columns) for r in df.collect())
    cursor = con.execute(entry.oracle_sql()[name])
    found = [c[0] for c in cursor.description]
    assert sorted(found) == columns
    want = in_order(tuple(r[found.index(c)] for c in columns) for r in cursor.fetchall())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert all(same(x, y) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs_without_sql(spark, name):
    assert entry.queries()[name](spark, DATA).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["period", "platform", "users"]


class TestGoldenValues:
    """Values of the blueprint's table of fixtures."""

    def test_mau(self, spark):
        got = {r["platform"]: r["users"] for r in entry.queries()["pm_mau"](spark, DATA).collect()}
        assert got == {"AUTOMOBILE": 26, "BUILDING": 35, "FURNITURE": 28, "HOUSEHOLD": 34, "MACHINERY": 27}

    def test_funnel(self, spark):
        got = entry.queries()["pm_funnel"](spark, DATA).orderBy("step_no").collect()
        assert [r["n"] for r in got] == [1617, 345, 56]

    def test_retention(self, spark):
        df = entry.queries()["pm_retention"](spark, DATA)
        first = df.where("cohort = DATE '1995-01-01' AND age BETWEEN 1 AND 4").orderBy("age").collect()
        assert [(r["size"], r["active"]) for r in first] == [(177, 14), (177, 28), (177, 20), (177, 26)]

    def test_payback(self, spark):
        got = {r["channel"]: r["payback_age"] for r in entry.queries()["ue_payback"](spark, DATA).collect()}
        assert got == {"AFRICA": 1, "ASIA": 2, "AMERICA": 3, "EUROPE": 6, "MIDDLE EAST": None}

    def test_decompose(self, spark):
        got = {r["factor"]: r["effect"] for r in entry.queries()["pm_decompose"](spark, DATA).collect()}
        assert got["revenue"] == 2713954.85
        assert sum(v for k, v in got.items() if k != "revenue") == pytest.approx(got["revenue"], abs=0.02)

    def test_sessions(self, spark):
        got = entry.queries()["pm_sessions"](spark, DATA)
        assert got.count() == 5725
        assert got.agg({"n_events": "avg"}).first()[0] == pytest.approx(1.746725, abs=1e-6)

    def test_rfm(self, spark):
        cells = entry.queries()["seg_rfm_summary"](spark, DATA)
        assert cells.count() == 94
        assert cells.where("r = 1 AND f = 1 AND m = 1").first()["customers"] == 93

    def test_welch_and_ztest(self, spark):
        welch = entry.queries()["ab_welch"](spark, DATA).first()
        assert (welch["t"], round(welch["df"], 2)) == (-0.520285, 1497.94)
        assert entry.queries()["ab_ztest"](spark, DATA).first()["z"] == -0.468373

    def test_srm(self, spark):
        assert entry.queries()["ab_srm_pair"](spark, DATA).first()["chi2"] == 0.026667

    def test_activity_bands(self, spark):
        df = entry.queries()["re_activity"](spark, DATA).groupBy("band").agg({"n": "sum"})
        got = dict(df.collect())
        assert (got["up to 30"], got["31-90"]) == (1774, 2846)

    def test_ltv(self, spark):
        df = entry.queries()["ue_ltv_curve"](spark, DATA).where("age = 27")
        assert {r["channel"]: r["ltv"] for r in df.collect()} == {
            "AFRICA": 585.2548,
            "AMERICA": 583.5915,
            "ASIA": 636.2558,
            "EUROPE": 568.3038,
            "MIDDLE EAST": 601.6926,
        }

    def test_first_day(self, spark):
        day = dt.date(2024, 1, 1)
        arpau = entry.queries()["pm_arpau"](spark, DATA).where(f"period = DATE '{day}'").first()
        arppu = entry.queries()["ue_arppu"](spark, DATA).where(f"period = DATE '{day}'").first()
        assert (arpau["arpau"], arppu["arppu"]) == (26.8037, 64.1375)
