"""Staged replacement, replaced years, buckets and counts of stored outputs."""

import datetime as dt
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from navspark import read_nav_table, returns, rolling_metrics, write_nav, write_table
from navspark.plans.pipeline import run_pipeline
from navspark.schemas import NAV_SCHEMA
from navspark.sources.sinks import read_nav_bucketed, replace_folder, restore_folder, write_nav_bucketed
from tests.test_ingest import land
from tests.test_pipeline import land_from_tables
from tests.test_plans import final_plan

BASE = dt.date(2020, 1, 1)


def nav_rows(days, schemes=("A", "B"), shift=0.0):
    return [(BASE + dt.timedelta(days=i), float(i % 50 + 1) + shift, s.lower(), s) for i in range(days) for s in schemes]


def rows_of(df):
    return sorted(map(str, df.collect()))


def failing(df):
    return df.withColumn("nav", F.when(F.col("date") > "2020-01-02", F.raise_error(F.lit("broken")).cast("double")).otherwise(F.col("nav")))


def siblings(path):
    return [n for n in os.listdir(os.path.dirname(path)) if n.startswith("_")]


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    path, other = str(tmp_path / "t"), str(tmp_path / "n")
    nav = spark.createDataFrame(nav_rows(10), NAV_SCHEMA)
    write_table(nav, path)
    write_nav(nav, other)
    with pytest.raises(Exception, match="broken"):
        write_table(failing(nav), path)
    with pytest.raises(Exception, match="broken"):
        write_nav(failing(nav), other)
    assert rows_of(spark.read.parquet(path)) == rows_of(nav) == rows_of(read_nav_table(spark, other))
    assert siblings(path) == []


def test_a_table_is_replaced_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5).toDF("x"), path)
    write_table(spark.read.parquet(path).withColumn("y", F.col("x") * 2), path)
    assert sorted(r["y"] for r in spark.read.parquet(path).collect()) == [0, 2, 4, 6, 8]
    write_table(spark.range(1).selectExpr("id AS x", "id AS y"), path, mode="append")
    assert spark.read.parquet(path).count() == 6 and siblings(path) == []


def test_an_interrupted_swap_is_put_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    os.rename(path, str(tmp_path / "_t.old-1"))  # the driver died between the two renames
    assert restore_folder(spark, path) and spark.read.parquet(path).count() == 3
    assert not restore_folder(spark, path) and not restore_folder(spark, str(tmp_path / "u"))
    replace_folder(spark, path, lambda p: spark.range(4).write.parquet(p))
    assert spark.read.parquet(path).count() == 4


def test_one_year_is_replaced(spark, tmp_path):
    path = str(tmp_path / "nav")
    write_nav(spark.createDataFrame(nav_rows(800), NAV_SCHEMA), path)
    before = {y: {f: os.stat(os.path.join(path, y, f)).st_mtime_ns for f in os.listdir(os.path.join(path, y))} for y in os.listdir(path) if "=" in y}
    again = [r for r in nav_rows(800, shift=0.5) if r[0].year == 2021]
    write_nav(spark.createDataFrame(again, NAV_SCHEMA), path, mode="years")
    expected = [r for r in nav_rows(800) if r[0].year != 2021] + again
    assert rows_of(read_nav_table(spark, path).select(*NAV_SCHEMA.names)) == rows_of(spark.createDataFrame(expected, NAV_SCHEMA))
    for y, files in before.items():
        now = {f: os.stat(os.path.join(path, y, f)).st_mtime_ns for f in os.listdir(os.path.join(path, y))}
        assert (now == files) == (y != "year=2021")
    with pytest.raises(Exception, match="broken"):
        write_nav(failing(spark.createDataFrame(again, NAV_SCHEMA)), path, mode="years")
    assert read_nav_table(spark, path).count() == len(expected)


def test_buckets_need_no_shuffle(spark, tmp_path):
    nav = spark.createDataFrame(nav_rows(120, "ABCDEFG"), NAV_SCHEMA)
    write_nav_bucketed(nav, "nav_in_buckets", str(tmp_path / "b"), 4)
    try:
        stored = read_nav_bucketed(spark, "nav_in_buckets")
        for f in (lambda x: returns(x, [1, 7]), lambda x: rolling_metrics(x, 20), lambda x: rolling_metrics(x, 60)):
            p = final_plan(f(stored))
            assert "Exchange" not in p and "Bucketed: true" in p
            assert rows_of(f(stored)) == rows_of(f(nav))
        # A hot key: read as files, split by the operators' own plan.
        files = read_nav_bucketed(spark, "nav_in_buckets", hot_rows=100)
        assert "Bucketed: true" not in final_plan(returns(files, [1, 7], hot_rows=100, block_rows=50))
        assert rows_of(returns(files, [1, 7], hot_rows=100, block_rows=50)) == rows_of(returns(nav, [1, 7]))
    finally:
        spark.sql("DROP TABLE nav_in_buckets")


def test_counts_are_observed_while_writing(spark, tmp_path):
    nav = spark.createDataFrame([*nav_rows(4), (None, None, "c", "C"), (BASE, None, "c", "C")], NAV_SCHEMA)
    seen = Observation()
    write_nav(nav, str(tmp_path / "n"), observation=seen)
    assert seen.get == {"rows": 10, "unparsed_dates": 1, "unparsed_navs": 2}


def test_pipeline_counts_without_jobs(spark, tmp_path):
    root = str(tmp_path)
    land_from_tables(spark, root)
    land(os.path.join(root, "payloads"), "2", {"data": [{"date": "bad", "nav": "N.A."}, {"date": "01-02-1996", "nav": "x"}]}, "odd.json")
    tracker = spark.sparkContext.statusTracker()

    def run(group, out, counts):
        spark.sparkContext.setJobGroup(group, "")
        res = run_pipeline(
            spark, os.path.join(root, "schemes.json"), os.path.join(root, "payloads"), os.path.join(root, out),
            mapping={"2": "Two", "17": "Seventeen"}, start="01-01-1996", rolling_rows=20, tier_counts=counts,
        )
        jobs = len(tracker.getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup("", "")
        return res, jobs

    counts = {}
    _, plain_jobs = run("uncounted", "a", None)
    res, counted_jobs = run("counted", "b", counts)
    assert counted_jobs == plain_jobs
    nav = counts.pop("raw/nav")
    assert nav["rows"] == res["nav"].count()
    assert nav["unparsed_dates"] == 1 and nav["unparsed_navs"] == 2 and nav["parsed_rows"] > nav["rows"]
    assert {k: v["rows"] for k, v in counts.items()} == {
        k: spark.read.parquet(os.path.join(root, "b", k)).count() for k in counts
    } and len(counts) == 9
