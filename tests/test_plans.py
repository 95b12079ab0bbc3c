"""Physical-plan checks: the plans are the ones we want, not just correct."""

import re

import pytest

import __spark_entry__ as E
from navspark import (
    attach_names,
    latest_nav,
    monthly_nav,
    nav_range,
    performance_metrics,
    returns,
    rolling_metrics,
    scheme_summary,
    write_nav,
)
from navspark.sources.sinks import read_nav_table
from navspark.sources.tables import nav_by_brand
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return plan(df)


@pytest.fixture(scope="module")
def stored_nav(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nav") / "nav")
    write_nav(nav_by_brand(spark, SF_SMALL), path)
    return read_nav_table(spark, path)


def test_nav_write_is_rebalanced(stored_nav):
    from navspark.sources.sinks import nav_layout

    p = plan(nav_layout(stored_nav))
    assert "REBALANCE_PARTITIONS_BY_COL" in p
    assert "RangePartitioning" not in p


def test_all_lags_share_one_exchange(stored_nav):
    p = plan(returns(stored_nav, [1, 7, 30], split="never"))
    assert len(re.findall(r"Exchange hashpartitioning\(scheme_name", p)) == 1
    assert p.count("Window [") == 1


def test_long_rolling_frame_is_blocked(stored_nav):
    # n=252: no sliding 252-row frame, and the block windows add no shuffle.
    blocked = plan(rolling_metrics(stored_nav, 252, split="never"))
    sliding = "RowFrame, -251, currentrow"
    assert sliding not in blocked
    assert len(re.findall(r"Exchange hashpartitioning\(scheme_name", blocked)) == 1
    assert sliding in plan(rolling_metrics(stored_nav, 252, split="never", method="frame"))


def test_latest_is_partial_top1(stored_nav):
    p = plan(latest_nav(stored_nav))
    assert "WindowGroupLimit" in p
    # a partial limit runs before the shuffle
    assert p.index("Exchange") < p.rindex("WindowGroupLimit")


def test_endpoints_are_one_hash_pass(spark, stored_nav):
    # One scan, one shuffle of group rows, no sort, no join, no job at call.
    tracker = spark.sparkContext.statusTracker()
    for f in (performance_metrics, scheme_summary, monthly_nav):
        spark.sparkContext.setJobGroup(f"call-{f.__name__}", "")
        df = f(stored_nav)
        assert not tracker.getJobIdsForGroup(f"call-{f.__name__}"), f.__name__
        p = final_plan(df)
        assert "SortAggregate" not in p and "Sort [" not in p and "Join" not in p, f.__name__
        assert p.count("FileScan") == 1 and p.count("Exchange") == 1 and "partial_min_by" in p, f.__name__
    spark.sparkContext.setJobGroup("", "")


def test_source_queries_read_files(spark):
    assert "FileScan json" in plan(E.q_nav_from_json(spark, SF_SMALL))
    assert "FileScan json" in plan(E.q_nav_multi(spark, SF_SMALL))
    assert "FileScan json" in plan(E.q_scan_schemes(spark, SF_SMALL))
    assert "FileScan text" in plan(E.q_scheme_payload(spark, SF_SMALL))


def test_hot_key_plan_leaves_nothing_cached(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    E.q_returns_hot_key(spark, SF_SMALL).write.format("noop").mode("overwrite").save()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_map_columns(stored_nav):
    from pyspark.sql import functions as F

    nav = stored_nav.withColumn("m", F.create_map(F.lit("a"), "nav"))
    assert returns(nav, [1]).count() == nav.count()
    with pytest.raises(ValueError, match="map"):
        returns(nav, [1], split="always")


def test_range_filter_reaches_scan(stored_nav):
    p = plan(nav_range(stored_nav, "01-01-1996", "31-12-1996"))
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,1996-01-01)" in p
    assert "PartitionFilters" in p


def test_adapter_prunes_columns(spark):
    p = plan(E.q_performance_metrics(spark, SF_SMALL))
    li = re.search(r"FileScan parquet [^\n]*lineitem[^\n]*ReadSchema: (struct<[^>]*>)", p)
    assert li, p
    assert set(re.findall(r"(\w+):", li.group(1))) == {"l_partkey", "l_extendedprice", "l_shipdate"}


def test_mapping_broadcast_is_size_checked(stored_nav):
    m = {"1": "One", "2": "Two"}
    assert "BroadcastHashJoin" in final_plan(attach_names(stored_nav, m))
    stored_nav.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = final_plan(attach_names(stored_nav, m, max_broadcast_bytes=1))
        assert "BroadcastHashJoin" not in big and "SortMergeJoin" in big
    finally:
        stored_nav.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_python_in_any_query(spark):
    for name, q in E.core_queries().items():
        p = plan(q(spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
            assert node not in p, (name, node)


def test_ansi_modes_agree(spark, golden):
    def run():
        return (
            sorted(map(str, performance_metrics(golden).collect()))
            + sorted(map(str, returns(golden, [1], split="never").collect()))
            + sorted(map(str, rolling_metrics(golden, 3, split="never", method="blocks").collect()))
            + sorted(map(str, rolling_metrics(golden, 2, split="always", block_rows=2, method="blocks").collect()))
        )

    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "true")
        a = run()
        spark.conf.set("spark.sql.ansi.enabled", "false")
        b = run()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert a == b


def test_row_order_does_not_matter(spark, golden):
    a = sorted(map(str, returns(golden, [1], split="never").collect()))
    b = sorted(map(str, returns(golden.repartition(5).orderBy("nav"), [1], split="never").collect()))
    assert a == b
