"""The hot-key block plan must give exactly the plain window's result."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from navspark import returns, rolling_metrics
from pyspark.sql import functions as F

from navspark.plans import sequence
from navspark.plans.sequence import _with_halos, ranged_heads, tag
from navspark.schemas import NAV_SCHEMA
from navspark.sources.tables import nav_by_part

BASE = dt.date(2020, 1, 1)


def make_rows(seed, n_rows, n_keys, n_days, dup_rate, null_rate):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n_rows):
        # key 0 is hot: about half the rows
        k = 0 if rnd.random() < 0.5 else rnd.randrange(n_keys)
        name = None if k == n_keys - 1 and n_keys > 2 else f"S{k}"
        day = None if rnd.random() < null_rate else BASE + dt.timedelta(days=rnd.randrange(n_days))
        nav = None if rnd.random() < null_rate else float(rnd.randrange(1, 40))
        row = (day, nav, f"c{k}", name)
        rows.append(row)
        if rnd.random() < dup_rate:
            rows.extend([row] * rnd.randrange(1, 6))
    return rows


def canon(df, digits=9):
    out = []
    for r in df.collect():
        out.append(tuple(
            (round(v, digits) if isinstance(v, float) else v) for v in r
        ))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


cases = st.tuples(
    st.integers(0, 10_000),           # seed
    st.integers(5, 160),              # rows
    st.integers(1, 5),                # keys
    st.integers(1, 40),               # days
    st.sampled_from([0.0, 0.3]),      # duplicate rate
    st.sampled_from([0.0, 0.1]),      # null rate
    st.integers(1, 9),                # block rows
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(cases, st.sampled_from([1, 2, 7]))
def test_split_equals_plain(spark, case, w):
    seed, n, k, days, dup, nul, block = case
    df = spark.createDataFrame(make_rows(seed, n, k, days, dup, nul), NAV_SCHEMA)
    periods = [1, 3, 5]
    plain = canon(returns(df, periods, split="never"))
    assert canon(returns(df, periods, split="always", block_rows=block)) == plain
    assert canon(returns(df, periods, split="auto", hot_rows=n // 3, block_rows=block)) == plain
    plain_r = canon(rolling_metrics(df, w, key="scheme_code", split="never"))
    assert canon(rolling_metrics(df, w, key="scheme_code", split="always", block_rows=block)) == plain_r
    assert canon(
        rolling_metrics(df, w, key="scheme_code", split="auto", hot_rows=n // 4, block_rows=block)
    ) == plain_r


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(cases, st.integers(1, 12))
def test_rolling_blocks_equal_frame(spark, case, w):
    seed, n, k, days, dup, nul, block = case
    df = spark.createDataFrame(make_rows(seed, n, k, days, dup, nul), NAV_SCHEMA)
    frame = canon(rolling_metrics(df, w, split="never", method="frame"))
    assert canon(rolling_metrics(df, w, split="never", method="blocks")) == frame
    assert canon(rolling_metrics(df, w, split="always", block_rows=block, method="blocks")) == frame


def test_blocks_are_bounded(spark):
    # One hot key: 3000 rows over 300 days, then three heavy days of 1000
    # distinct NAVs each, a day of 900 rows sharing one NAV (distinct codes,
    # so not copies) and 400 runs of 3 copies. No block holds much more than
    # block_rows heads, and the halos are exactly the rows looked back to.
    rows = [(BASE + dt.timedelta(days=i // 10), float(i), "hot", "H") for i in range(3000)]
    for d in range(3):
        rows += [(BASE + dt.timedelta(days=400 + d), float(1000 - i), "hot", "H") for i in range(1000)]
    rows += [(BASE + dt.timedelta(days=500), 7.0, f"c{i}", "H") for i in range(900)]
    rows += [(BASE + dt.timedelta(days=600), float(i), "hot", "H") for i in range(400) for _ in range(3)]
    df = spark.createDataFrame(rows, NAV_SCHEMA)
    keys, halo = ["scheme_name"], 25
    heads, blocks = ranged_heads(tag(df), df.columns, keys, halo, 200, len(rows))
    sizes = [r["_c"] for r in blocks.collect()]
    assert sum(sizes) == len(rows) and sum(r["_sw"] for r in blocks.collect()) == len(rows)
    assert len(sizes) >= 0.8 * len(rows) / 200 and max(sizes) <= 2 * 200
    with_halo = _with_halos(heads, blocks, keys, halo).groupBy("_t", "_halo").count().collect()
    halos = {r["_t"]: r["count"] for r in with_halo if r["_halo"]}
    first = min(r["_t"] for r in with_halo)
    assert first not in halos and all(halos[r["_t"]] == halo for r in with_halo if r["_t"] != first)
    # Ranges are contiguous stretches of the sequence.
    spans = heads.groupBy("_t").agg(F.min("date").alias("a"), F.max("date").alias("b")).orderBy("_t").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(spans, spans[1:]))


def test_blocks_smaller_than_the_halo(spark):
    # Several keys end in one range and begin in another, so some blocks are
    # shorter than the look-back and need rows of more than one block before.
    rows = [(BASE + dt.timedelta(days=i), float(i * i % 17), f"c{k}", f"S{k}") for k in range(3) for i in range(90)]
    df = spark.createDataFrame(rows, NAV_SCHEMA)
    assert canon(returns(df, [1, 40], split="always", block_rows=1)) == canon(returns(df, [1, 40], split="never"))
    _, blocks = ranged_heads(tag(df), df.columns, ["scheme_name"], 40, 41, 30 * len(rows))
    assert max(len(r["_from"]) for r in blocks.collect()) > 1


def test_copies_collapse(spark):
    # 5000 copies of one row on one day: a run of halo + 1 heads, not 5000.
    rows = [(BASE, 5.0, "c", "H")] * 5000 + [(BASE + dt.timedelta(days=1), 6.0, "c", "H")]
    df = spark.createDataFrame(rows, NAV_SCHEMA)
    heads, blocks = ranged_heads(tag(df), df.columns, ["scheme_name"], 3, 10, 5001)
    assert heads.count() == 4 + 1 and sum(r["_sw"] for r in blocks.collect()) == 5001
    out = returns(df, [1, 2], split="always", block_rows=10).collect()
    assert len(out) == 5001
    last = [r for r in out if r["date"] == BASE + dt.timedelta(days=1)][0]
    assert last["return_1d"] == 20.0 and last["return_2d"] == 20.0


@pytest.mark.parametrize("split", ["never", "always", "auto"])
def test_undated_rows_kept(spark, split):
    rows = [(None, 3.0, "c", "S"), (BASE, 1.0, "c", "S"), (BASE + dt.timedelta(days=1), 2.0, "c", "S")]
    out = returns(spark.createDataFrame(rows, NAV_SCHEMA), [1], split=split, block_rows=1).collect()
    assert len(out) == 3
    got = {r["date"]: r["return_1d"] for r in out}
    assert got[None] is None and got[BASE] is None and got[BASE + dt.timedelta(days=1)] == 100.0


def test_nan_navs_order_last_on_every_path(spark):
    # NaN sorts after every number (Spark's order): quantile buckets,
    # sequence order and merged block statistics must all agree.
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        nav = rnd.choice([float("nan"), None, float(rnd.randrange(1, 9)), float(rnd.randrange(1, 9))])
        rows.append((BASE + dt.timedelta(days=rnd.randrange(6)), nav, f"c{rnd.randrange(50)}", "H"))
    df = spark.createDataFrame(rows, NAV_SCHEMA)

    def text(x):
        return [str(r) for r in canon(x)]

    assert text(returns(df, [1, 2], split="always", block_rows=8)) == text(returns(df, [1, 2], split="never"))
    frame = text(rolling_metrics(df, 5, split="never", method="frame"))
    assert text(rolling_metrics(df, 5, split="never", method="blocks")) == frame
    assert text(rolling_metrics(df, 5, split="always", block_rows=8, method="blocks")) == frame


@pytest.mark.parametrize("seed", [0, 1])
def test_heavy_day_of_few_runs(spark, seed):
    # A heavy day made of 3 runs of 2000 copies under a long halo: few runs,
    # many heads. Its buckets must stay contiguous whatever the sample holds.
    navs = [float(10 + seed), float(20 + seed), float(30 + seed)]
    rows = [(BASE + dt.timedelta(days=5), v, "c", "H") for v in navs for _ in range(2000)]
    rows += [(BASE + dt.timedelta(days=d), float(d), "c", "H") for d in range(10) if d != 5]
    df = spark.createDataFrame(rows, NAV_SCHEMA)
    plain = canon(rolling_metrics(df, 2000, split="never"))
    assert canon(rolling_metrics(df, 2000, split="always", block_rows=2000)) == plain


def test_heavy_day_is_cut_like_any_other(spark):
    # All rows on one day, most of them with one NAV: still equal ranges.
    n, block = 6_000, 100
    nav = spark.range(n).selectExpr(
        "DATE'2020-01-01' AS date", "CAST(IF(id % 3 = 0, hash(id), 7) AS DOUBLE) AS nav", "CAST(id AS STRING) AS scheme_code", "'S' AS scheme_name"
    )
    _, blocks = ranged_heads(tag(nav), nav.columns, ["scheme_name"], 3, block, n)
    sizes = [r["_c"] for r in blocks.collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * block
    assert canon(returns(nav, [1, 3], split="always", block_rows=block)) == canon(returns(nav, [1, 3], split="never"))


def test_split_is_bit_equal_without_copies(spark):
    nav = spark.createDataFrame(
        [(BASE + dt.timedelta(days=i % 700), random.Random(i).random() * 100, "c", "S") for i in range(3_000)], NAV_SCHEMA
    )
    a, b = (sorted(map(tuple, rolling_metrics(nav, 40, split=s, block_rows=200).collect())) for s in ("never", "always"))
    assert a == b


def test_many_blocks_share_few_ranges(spark, monkeypatch):
    # 90 blocks are asked for: their sample and their tasks are those of 4
    # ranges, each cut into pieces of exactly the block's rows and a rest.
    monkeypatch.setattr(sequence, "FEW_RANGES", 4, raising=False)
    rows = [(BASE + dt.timedelta(days=i // 3), float(i * i % 97), f"c{i}", f"S{k}") for k in range(3) for i in range(300)]
    df = spark.createDataFrame(rows, NAV_SCHEMA)
    heads, blocks = ranged_heads(tag(df), df.columns, ["scheme_name"], 7, 10, len(rows))
    assert heads.rdd.getNumPartitions() == 4
    pieces = [r["n"] for r in heads.groupBy("_t").agg(F.count("*").alias("n")).collect()]
    assert sum(pieces) == len(rows) and max(pieces) == 10 and sum(n < 10 for n in pieces) <= 4
    # One key after the other, and in a key one stretch of days after the other.
    spans = heads.groupBy("_t").agg(F.min(F.struct("scheme_name", "date", "nav")).alias("a"), F.max(F.struct("scheme_name", "date", "nav")).alias("b"))
    spans = spans.orderBy("_t").collect()
    assert all(tuple(x["b"]) <= tuple(y["a"]) for x, y in zip(spans, spans[1:]))
    starts = {}
    for r in blocks.orderBy("scheme_name", "_t").collect():
        assert r["_s"] == starts.get(r["scheme_name"], 0)
        starts[r["scheme_name"]] = r["_s"] + r["_c"]
    assert starts == {"S0": 300, "S1": 300, "S2": 300}


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    # Ranges hold RANGE_ROWS rows, not all rows of a large table.
    monkeypatch.setattr(sequence, "FEW_RANGES", 1, raising=False)
    monkeypatch.setattr(sequence, "RANGE_ROWS", 50, raising=False)
    df = spark.createDataFrame([(BASE + dt.timedelta(days=i), float(i), "c", "S") for i in range(300)], NAV_SCHEMA)
    heads, _ = ranged_heads(tag(df), df.columns, ["scheme_name"], 3, 10, 300)
    assert heads.rdd.getNumPartitions() == 6


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(cases, st.sampled_from([1, 2, 7]))
def test_shared_ranges_equal_plain(spark, case, w):
    seed, n, k, days, dup, nul, block = case
    df = spark.createDataFrame(make_rows(seed, n, k, days, dup, nul), NAV_SCHEMA)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(sequence, "FEW_RANGES", 2, raising=False)
        assert canon(returns(df, [1, 5], split="always", block_rows=block)) == canon(returns(df, [1, 5], split="never"))
        plain = canon(rolling_metrics(df, w, split="never"))
        assert canon(rolling_metrics(df, w, split="auto", hot_rows=n // 4, block_rows=block, method="blocks")) == plain


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    # 45,000 prices of 300 parts under 5 names, one part without a name.
    at = str(tmp_path_factory.mktemp("tables"))
    spark.range(300).selectExpr(
        "id AS p_partkey", "IF(id = 7, NULL, concat('name ', id % 5)) AS p_name", "concat('Brand#', 11 + id % 3) AS p_brand"
    ).write.parquet(f"{at}/part.parquet")
    spark.range(45_000).selectExpr(
        "id % 300 AS l_partkey",
        "CAST(date_add(DATE'1995-01-01', CAST(id DIV 300 AS INT)) AS TIMESTAMP) AS l_shipdate",
        "CAST(pmod(hash(id), 9000) + 1 AS DOUBLE) AS l_extendedprice",
    ).write.parquet(f"{at}/lineitem.parquet")
    return at


@pytest.mark.parametrize(
    "name", ["rolling_metrics_by_name_split", "returns_by_name_split", "rolling_metrics_hot_key", "returns_hot_key"]
)
def test_split_queries_sample_few_ranges(spark, monkeypatch, tables, name):
    # A query's blocks are small: the ranges that the driver samples and the
    # tasks that report to it must not be as many.
    monkeypatch.setattr(sequence, "FEW_RANGES", 2, raising=False)
    seen, inner = [], sequence.ranged_heads

    def watched(*args):
        heads, blocks = inner(*args)
        seen.append((heads.rdd.getNumPartitions(), blocks.select("_t").distinct().count()))
        return heads, blocks

    monkeypatch.setattr(sequence, "ranged_heads", watched)
    got = canon(E.core_queries()[name](spark, tables), 4)
    assert len(seen) == 1 and seen[0][0] == 2 and seen[0][1] >= 3
    nav = (E._nav_hot if name.endswith("hot_key") else nav_by_part)(spark, tables)
    if name.startswith("returns"):
        periods = E.SHORT_PERIODS if name.endswith("split") else (1, 7, 30)
        plain = E._round(returns(nav, periods, split="never"), [f"return_{p}d" for p in periods])
    else:
        n = E.ROLL_TINY if name.endswith("split") else E.ROLL_LONG
        plain = E._round(rolling_metrics(nav, n, split="never"), ["rolling_avg_nav", "rolling_volatility"])
    assert len(got) == 45_000 and got == canon(plain, 4)
