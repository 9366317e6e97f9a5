"""Probability functions against printed tables."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from growthkit.functions import stats


def test_normal():
    assert 2 * stats.normal_sf(1.959963984540054) == pytest.approx(0.05, abs=1e-12)
    assert stats.normal_sf(0) == 0.5


@pytest.mark.parametrize(
    ("p", "df", "value"),
    # Quantiles of Student's t from printed tables.
    [
        (0.975, 1, 12.7062),
        (0.975, 2, 4.3027),
        (0.975, 5, 2.5706),
        (0.975, 10, 2.2281),
        (0.975, 30, 2.0423),
        (0.95, 10, 1.8125),
        (0.995, 120, 2.6174),
        (0.9995, 4, 8.6103),
    ],
)
def test_t_table(p, df, value):
    assert stats.t_quantile(p, df) == pytest.approx(value, abs=5e-5)
    assert stats.t_sf(value, df) == pytest.approx(1 - p, abs=1e-5)
    assert stats.t_quantile(1 - p, df) == pytest.approx(-value, abs=5e-5)


def test_t_limits():
    assert stats.t_sf(1.959963984540054, 1e9) == pytest.approx(0.025, abs=1e-8)
    for t in (-3.0, 0.5, 2.0, 6.0):
        assert stats.t_sf(t, 100001) == pytest.approx(stats.t_sf(t, 99999), rel=1e-6)
    assert stats.t_quantile(0.975, 1e10) == pytest.approx(1.959963984540054, abs=1e-9)
    assert stats.t_sf(0, 7) == 0.5
    assert 0 < stats.t_sf(50, 30) < 1e-25
    assert stats.t_sf(1, 1) == pytest.approx(0.25, abs=1e-12)


@pytest.mark.parametrize(
    ("x", "df", "p"),
    # Critical points of chi-square from printed tables.
    [(3.8415, 1, 0.05), (5.9915, 2, 0.05), (9.4877, 4, 0.05), (18.307, 10, 0.05), (6.6349, 1, 0.01), (0.7107, 4, 0.95)],
)
def test_chi2_table(x, df, p):
    assert stats.chi2_sf(x, df) == pytest.approx(p, abs=1e-5)


def test_chi2_of_one_degree_is_the_normal():
    assert stats.chi2_sf(1.959963984540054**2, 1) == pytest.approx(0.05, abs=1e-12)


def test_alternatives():
    assert stats.two_way(stats.normal_sf, 1.0, "two-sided") == pytest.approx(2 * stats.normal_sf(1.0))
    assert stats.two_way(stats.normal_sf, 1.0, "less") == pytest.approx(1 - stats.normal_sf(1.0))
    with pytest.raises(ValueError):
        stats.check_alternative("bigger")


def test_functions_travel_without_the_package(tmp_path):
    path = tmp_path / "fn"
    path.write_bytes(cloudpickle.dumps(stats.t_sf))
    load = "import pickle, sys; f = pickle.load(open(sys.argv[1], 'rb')); print(f(2.0, 10.0))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", load, path], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert float(out.stdout) == stats.t_sf(2.0, 10.0)


def test_student_t_is_continuous_where_the_formula_changes():
    for t in (0.1, 1.96, 4.0):
        assert stats.t_sf(t, 1e5) == pytest.approx(stats.t_sf(t, 1e5 + 1e-3), rel=1e-8)
