"""Golden micro-fixture: every operator against hand-checked values."""

import datetime as dt
import math

import pytest

from navspark import (
    latest_nav,
    monthly_nav,
    performance_metrics,
    pivot_nav,
    returns,
    rolling_metrics,
    scheme_summary,
)
from navspark.schemas import NAV_SCHEMA
from tests.conftest import d


def approx(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)


def by_name(df):
    return {r["scheme_name"]: r for r in df.collect()}


def test_performance_metrics(golden):
    m = by_name(performance_metrics(golden))
    exp = {
        #      n  first latest days total fluct annual
        "A": (3, 10.0, 12.0, 31, 20.0, 20.0, 755.6483483403),
        "B": (1, 5.0, 5.0, 0, 0.0, 0.0, 0.0),
        "C": (2, 0.0, 4.0, 1, None, None, None),
        "D": (1, 4.0, 4.0, 0, 0.0, 0.0, 0.0),
    }
    for k, (n, f, l, days, tot, fl, ann) in exp.items():
        r = m[k]
        assert r["total_observations"] == n
        assert r["first_nav"] == f and r["latest_nav"] == l
        assert r["period_days"] == days
        assert approx(r["total_return_pct"], tot)
        assert approx(r["max_fluctuation_pct"], fl)
        assert approx(r["annualized_return_pct"], ann, 1e-9)
    assert approx(m["A"]["nav_volatility"], 1.0)
    assert m["B"]["nav_volatility"] is None
    assert approx(m["C"]["nav_volatility"], 2.8284271247)
    assert performance_metrics(golden).columns == [
        "scheme_name", "scheme_code", "total_observations", "start_date", "end_date", "first_nav",
        "latest_nav", "min_nav", "max_nav", "avg_nav", "nav_volatility", "total_return_pct",
        "period_days", "max_fluctuation_pct", "annualized_return_pct",
    ]


def test_scheme_summary(golden):
    m = by_name(scheme_summary(golden))
    exp = {
        "A": (3, 10.0, 12.0, 31, 20.0, 755.6483483403),
        "B": (1, 5.0, None, 2, None, None),
        "C": (2, 0.0, 4.0, 1, None, None),
        "D": (1, 4.0, 4.0, 0, 0.0, None),
    }
    for k, (n, f, l, days, tot, ann) in exp.items():
        r = m[k]
        assert (r["total_observations"], r["first_nav"], r["latest_nav"], r["period_days"]) == (n, f, l, days)
        assert approx(r["total_return_pct"], tot)
        assert approx(r["annualized_return_pct"], ann)
    assert "max_fluctuation_pct" not in scheme_summary(golden).columns


@pytest.mark.parametrize("split", ["never", "always"])
def test_returns(golden, split):
    rows = returns(golden, [1], split=split, block_rows=2).collect()
    got = {(r["scheme_name"], r["date"]): r["return_1d"] for r in rows}
    assert got[("A", d("2024-01-01"))] is None
    assert approx(got[("A", d("2024-01-02"))], 10.0)
    assert approx(got[("A", d("2024-02-01"))], 9.0909090909, 1e-9)
    assert got[("B", d("2024-01-03"))] is None
    assert got[("C", d("2024-01-04"))] is None  # zero base
    assert got[("D", d("2024-01-04"))] is None
    assert len(rows) == 8


@pytest.mark.parametrize("split", ["never", "always"])
def test_rolling_two_rows(golden, split):
    rows = rolling_metrics(golden, 2, split=split, block_rows=2).collect()
    got = {(r["scheme_name"], r["date"]): r for r in rows}
    avg = {
        ("A", "2024-01-01"): 10.0, ("A", "2024-01-02"): 10.5, ("A", "2024-02-01"): 11.5,
        ("B", "2024-01-01"): 5.0, ("B", "2024-01-03"): 5.0,
        ("C", "2024-01-03"): 0.0, ("C", "2024-01-04"): 2.0, ("D", "2024-01-04"): 4.0,
    }
    std = {
        ("A", "2024-01-01"): None, ("A", "2024-01-02"): 0.7071067812, ("A", "2024-02-01"): 0.7071067812,
        ("B", "2024-01-01"): None, ("B", "2024-01-03"): None,
        ("C", "2024-01-03"): None, ("C", "2024-01-04"): 2.8284271247, ("D", "2024-01-04"): None,
    }
    for (n, day), v in avg.items():
        assert approx(got[(n, d(day))]["rolling_avg_nav"], v)
        assert approx(got[(n, d(day))]["rolling_volatility"], std[(n, day)], 1e-9)


def test_latest_nav(golden):
    m = {r["scheme_code"]: r for r in latest_nav(golden).collect()}
    assert m["1"]["date"] == d("2024-02-01") and m["1"]["nav"] == 12.0
    assert m["2"]["date"] == d("2024-01-03") and m["2"]["nav"] is None
    assert all(r["rn"] == 1 for r in m.values())
    assert latest_nav(golden).columns == ["scheme_name", "scheme_code", "date", "nav", "rn"]


def test_monthly_nav(golden):
    rows = {(r["scheme_name"], r["year"], r["month"]): r for r in monthly_nav(golden).collect()}
    a1 = rows[("A", 2024, 1)]
    assert (a1["month_start_nav"], a1["month_end_nav"], a1["trading_days"]) == (10.0, 11.0, 2)
    a2 = rows[("A", 2024, 2)]
    assert (a2["month_start_nav"], a2["month_end_nav"], a2["trading_days"]) == (12.0, 12.0, 1)
    b1 = rows[("B", 2024, 1)]
    assert (b1["month_start_nav"], b1["month_end_nav"], b1["trading_days"]) == (5.0, None, 2)


def test_pivot(golden):
    p = pivot_nav(golden)
    assert p.columns == ["date", "A", "B", "C", "D"]
    got = {r["date"].isoformat(): tuple(r)[1:] for r in p.collect()}
    assert got == {
        "2024-01-01": (10.0, 5.0, None, None),
        "2024-01-02": (11.0, None, None, None),
        "2024-01-03": (None, None, 0.0, None),
        "2024-01-04": (None, None, 4.0, 4.0),
        "2024-02-01": (12.0, None, None, None),
    }


def test_pivot_width_guard(golden):
    conf = golden.sparkSession.conf
    conf.set("spark.sql.pivotMaxValues", "3")
    try:
        with pytest.raises(ValueError):
            pivot_nav(golden)
        assert pivot_nav(golden, values=["A", "B", "C", "D"]).columns == ["date", "A", "B", "C", "D"]
    finally:
        conf.unset("spark.sql.pivotMaxValues")


def test_pivot_keeps_unnamed_rows_and_wide_tables(spark):
    day = dt.date(2024, 1, 1)
    rows = [(day, 1.0, "1", None), (day, 2.0, "2", "null"), (day, 3.0, "3", "A")]
    p = pivot_nav(spark.createDataFrame(rows, NAV_SCHEMA))
    assert p.columns == ["date", "null", "A", "null"] and tuple(p.first())[1:] == (1.0, 3.0, 2.0)
    many = spark.createDataFrame([(day, float(i), str(i), f"S{i:04}") for i in range(1001)], NAV_SCHEMA)
    assert len(pivot_nav(many).columns) == 1002


def test_undated_rows_count(spark):
    day = dt.date(2024, 1, 1)
    rows = [(None, 9.0, "1", "A"), (day, 1.0, "1", "A"), (day, 3.0, "1", "A"), (None, 5.0, "2", "U")]
    nav = spark.createDataFrame(rows, NAV_SCHEMA)
    for f in (performance_metrics, scheme_summary):
        got = {r.scheme_name: r for r in f(nav).collect()}
        a, u = got["A"], got["U"]
        assert (a.total_observations, a.min_nav, a.max_nav, a.first_nav, a.latest_nav) == (3, 1.0, 9.0, 1.0, 3.0)
        assert (u.total_observations, u.avg_nav, u.first_nav, u.start_date) == (1, 5.0, None, None)
    got = {(r.scheme_name, r.year): tuple(r)[3:] for r in monthly_nav(nav).collect()}
    assert got == {("A", 2024): (1.0, 3.0, 2), ("A", None): (None, None, 1), ("U", None): (None, None, 1)}


def test_null_on_an_end_date(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [(d1, None, "1", "A"), (d1, 4.0, "1", "A"), (d2, None, "1", "A"), (d2, 7.0, "1", "A"), (d2, 6.0, "1", "A")]
    r = scheme_summary(spark.createDataFrame(rows, NAV_SCHEMA)).first()
    assert (r.first_nav, r.latest_nav) == (None, 7.0)
