"""

Every query reads the shared test tables (``lineitem`` and ``part``) through
the NAV adapters of :mod:`navspark.sources.tables` and runs the library
operator over the whole table. Each has an independent DuckDB SQL form over
the same parquet files. Computed floating-point columns that are sums, means,
standard deviations or powers are rounded in BOTH forms with the same
half-up rule (``round4``) so that last-bit differences between two engines'
summation orders do not count; minima, maxima and stored values stay raw.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navspark.functions.exprs import round4
from navspark.operators.catalog import search_schemes
from navspark.operators.combine import attach_names, nav_multi, nav_union
from navspark.operators.metrics import performance_metrics, scheme_summary
from navspark.operators.periodic import latest_nav, monthly_nav
from navspark.operators.pivot import pivot_nav
from navspark.operators.selection import nav_range, top_nav
from navspark.operators.windows import returns, rolling_metrics
from navspark.sources.catalogue import read_schemes
from navspark.plans.pipeline import run_pipeline
from navspark.sources.payload import read_nav, rejected_payloads, scheme_payload
from navspark.sources.sinks import read_nav_table, write_nav
from navspark.sources.tables import (
    land_documents,
    landed_catalogue,
    landed_payloads,
    landing_folder,
    nav_by_brand,
    nav_by_part,
    payload_documents,
    scheme_catalogue,
    table,
)

# The text operators and the corpus pipeline are optional: without their
# modules everything else still works. Any other import error is a fault.
LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE_SQL: dict[str, str] = {}
try:
    import corpus_pipeline
    from navspark.llm import queries as llm_queries
except ModuleNotFoundError as e:
    if not (e.name or "").startswith(("navspark.llm", "corpus_pipeline")):
        raise
else:
    LLM_QUERIES = llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    LLM_ORACLE_SQL = llm_queries.ORACLE_SQL | (
        {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    )

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the registered queries (shared by the Spark and SQL forms).
SEARCH_KEYWORD = "RED"
SEARCH_TYPE_KEYWORD = ("Widget", "eco")
RANGE = ("01-01-1997", "30-06-1998")
MULTI_RANGE = ("01-01-1996", "31-12-2000")
ROLL_LONG, ROLL_SHORT, ROLL_TINY = 252, 32, 7
SHORT_PERIODS = (1, 3)
HOT_KEY_ROWS, HOT_KEY_BLOCK = 10_000, 5_000


def _round(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: round4(c) for c in cols})


# --------------------------------------------------------------------------- Spark side


def q_performance_metrics(spark, sf):
    return _round(
        performance_metrics(nav_by_brand(spark, sf)),
        ["avg_nav", "nav_volatility", "total_return_pct", "max_fluctuation_pct", "annualized_return_pct"],
    )


def q_performance_metrics_by_part(spark, sf):
    return _round(
        performance_metrics(nav_by_part(spark, sf)),
        ["avg_nav", "nav_volatility", "total_return_pct", "max_fluctuation_pct", "annualized_return_pct"],
    )


def q_scheme_summary(spark, sf):
    return _round(
        scheme_summary(nav_by_brand(spark, sf)),
        ["avg_nav", "nav_volatility", "total_return_pct", "annualized_return_pct"],
    )


def _returns(spark, sf, **kw):
    return _round(returns(nav_by_brand(spark, sf), **kw), ["return_1d", "return_7d", "return_30d"])


def q_returns(spark, sf):
    return _returns(spark, sf)


def q_returns_split(spark, sf):
    # Same result through the hot-key block plan: every scheme is treated as hot.
    return _returns(spark, sf, split="always", block_rows=1_000)


def q_returns_by_code(spark, sf):
    return _round(
        returns(nav_by_part(spark, sf), key="scheme_code"), ["return_1d", "return_7d", "return_30d"]
    )


def q_returns_by_name(spark, sf):
    # Name-keyed over the part table: several codes share a name and a date,
    # so the NAV decides the order within a day.
    return _round(returns(nav_by_part(spark, sf)), ["return_1d", "return_7d", "return_30d"])


def q_returns_by_name_split(spark, sf):
    # The same order through the hot-key plan: ranges end within days and names.
    return _round(
        returns(nav_by_part(spark, sf), SHORT_PERIODS, split="always", block_rows=2_000),
        [f"return_{p}d" for p in SHORT_PERIODS],
    )


def _rolling(spark, sf, n, nav=nav_by_brand, **kw):
    return _round(rolling_metrics(nav(spark, sf), n, **kw), ["rolling_avg_nav", "rolling_volatility"])


def q_rolling_metrics(spark, sf):
    return _rolling(spark, sf, ROLL_LONG)


def q_rolling_metrics_32(spark, sf):
    return _rolling(spark, sf, ROLL_SHORT)


def q_rolling_metrics_split(spark, sf):
    return _rolling(spark, sf, ROLL_SHORT, split="always", block_rows=1_000)


def q_rolling_metrics_long_split(spark, sf):
    # Long frame (prefix/suffix blocks) inside the hot-key plan.
    return _rolling(spark, sf, ROLL_LONG, split="always", block_rows=1_000)


def q_rolling_metrics_by_name(spark, sf):
    return _rolling(spark, sf, ROLL_LONG, nav_by_part)


def q_rolling_metrics_by_name_split(spark, sf):
    return _rolling(spark, sf, ROLL_TINY, nav_by_part, split="always", block_rows=2_000, method="blocks")


def _nav_hot(spark, sf):
    # Skewed by construction from the real tables: a third of the parts are
    # renamed to one scheme, "HOT", so one key holds a third of all rows
    # beside many ordinary keys. No row is dropped.
    nav = nav_by_part(spark, sf)
    return nav.withColumn(
        "scheme_name",
        F.when(F.col("scheme_code").cast("long") % 3 == 0, F.lit("HOT")).otherwise(F.col("scheme_name")),
    )


def q_returns_hot_key(spark, sf):
    # split="auto": one counting pass finds HOT; only it takes the split plan.
    return _round(
        returns(_nav_hot(spark, sf), hot_rows=HOT_KEY_ROWS, block_rows=HOT_KEY_BLOCK),
        ["return_1d", "return_7d", "return_30d"],
    )


def q_rolling_metrics_hot_key(spark, sf):
    return _rolling(spark, sf, ROLL_LONG, _nav_hot, hot_rows=HOT_KEY_ROWS, block_rows=HOT_KEY_BLOCK)


def q_latest_nav(spark, sf):
    return latest_nav(nav_by_brand(spark, sf))


def q_latest_nav_by_part(spark, sf):
    return latest_nav(nav_by_part(spark, sf))


def q_monthly_nav(spark, sf):
    return monthly_nav(nav_by_brand(spark, sf))


def q_monthly_nav_by_name(spark, sf):
    # Many codes share a name here, so a month holds several rows per date.
    return monthly_nav(nav_by_part(spark, sf))


def q_pivot_nav(spark, sf):
    return pivot_nav(nav_by_brand(spark, sf))


def q_search_schemes(spark, sf):
    return search_schemes(scheme_catalogue(spark, sf), SEARCH_KEYWORD)


def q_search_schemes_type(spark, sf):
    kw, ty = SEARCH_TYPE_KEYWORD
    return search_schemes(scheme_catalogue(spark, sf), kw, ty)


def q_nav_range(spark, sf):
    return nav_range(nav_by_brand(spark, sf), *RANGE)


def q_nav_from_json(spark, sf):
    # Landed payload files of every brand, read, typed and named.
    raw = read_nav(spark, landed_payloads(nav_by_brand(spark, sf)))
    names = table(spark, sf, "part").select(
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).alias("scheme_code"),
        F.col("p_brand").alias("scheme_name"),
    )
    return attach_names(raw, names, "left")


def q_nav_from_json_split(spark, sf):
    # One document per brand, read by as many tasks as it has file splits.
    root = landed_payloads(nav_by_brand(spark, sf), period=None)
    names = table(spark, sf, "part").select(
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).alias("scheme_code"),
        F.col("p_brand").alias("scheme_name"),
    )
    return attach_names(read_nav(spark, root, split_documents=True), names, "left")


def q_scan_schemes_split(spark, sf):
    # The catalogue as large documents, each read by many tasks.
    root = landed_catalogue(scheme_catalogue(spark, sf), per_document=1_000_000)
    return read_schemes(spark, root, split_documents=True)


def _half_truncated(spark, sf):
    # Documents of every brand; those of even codes lose their end.
    docs = payload_documents(nav_by_brand(spark, sf), period="yyyy")
    cut = F.expr("left(value, length(value) - 5)")
    even = F.col("scheme_code").cast("int") % 2 == 0
    return land_documents(docs.withColumn("value", F.when(even, cut).otherwise(F.col("value"))))


def q_rejected_payloads(spark, sf):
    # Landed documents that cannot be read, per scheme and year.
    found = rejected_payloads(spark, _half_truncated(spark, sf))
    day = F.try_to_date(F.regexp_extract("payload", '"date":"([0-9-]+)"', 1), "dd-MM-yyyy")
    return found.groupBy("scheme_code", F.date_format(day, "yyyy").alias("period")).agg(F.count("*").alias("n"))


def q_nav_beside_rejects(spark, sf):
    # What is read beside them.
    return read_nav(spark, _half_truncated(spark, sf), split_documents=True)


def q_nav_table(spark, sf):
    # The stored NAV table, partitioned by year, read back between two dates.
    path = landing_folder(spark, "nav")
    write_nav(nav_by_brand(spark, sf), path)
    return read_nav_table(spark, path, *RANGE)


def _tiers(spark, sf):
    return run_pipeline(
        spark,
        landed_catalogue(scheme_catalogue(spark, sf)),
        landed_payloads(nav_by_brand(spark, sf)),
        landing_folder(spark, "tiers"),
        mapping=_brand_names(spark, sf),
        keyword=SEARCH_KEYWORD,
        scheme_type=None,
    )


def q_pipeline_performance(spark, sf):
    # Landed files through every tier; the metrics tier, reread.
    return _round(
        _tiers(spark, sf)["performance"],
        ["avg_nav", "nav_volatility", "total_return_pct", "max_fluctuation_pct", "annualized_return_pct"],
    )


def _brand_names(spark, sf):
    # code -> fund-name mapping frame for every brand in ``part``.
    return table(spark, sf, "part").select(
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).alias("scheme_code"),
        F.concat(F.lit("Fund "), F.col("p_brand")).alias("scheme_name"),
    )


def q_nav_multi(spark, sf):
    # The multi-scheme fetch over landed files: named through a mapping frame,
    # bounded to the requested dates.
    root = landed_payloads(nav_by_brand(spark, sf))
    return nav_multi(spark, root, _brand_names(spark, sf), *MULTI_RANGE, with_fetch_time=False)


def q_nav_union(spark, sf):
    # A named frame (per brand) and an unnamed one (per part, name dropped).
    return nav_union([nav_by_brand(spark, sf), nav_by_part(spark, sf).drop("scheme_name")])


def q_top_nav(spark, sf):
    return top_nav(nav_by_brand(spark, sf), 10)


def q_scan_schemes(spark, sf):
    # Landed catalogue documents of all parts.
    return read_schemes(spark, landed_catalogue(scheme_catalogue(spark, sf)))


def q_scheme_payload(spark, sf):
    # Raw landed documents of every scheme, their points summarised per month.
    docs = scheme_payload(spark, landed_payloads(nav_by_brand(spark, sf)), None)
    dates = F.transform(
        F.from_json("payload", "data ARRAY<STRUCT<date:STRING,nav:STRING>>")["data"],
        lambda p: F.to_date(p["date"], "dd-MM-yyyy"),
    )
    points = docs.select("scheme_code", F.explode(dates).alias("date"))
    return points.groupBy("scheme_code", F.date_format("date", "yyyy-MM").alias("period")).agg(
        F.count("*").alias("n_points"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


# --------------------------------------------------------------------------- SQL side


def _r(x: str) -> str:
    return f"CAST(floor(({x}) * 10000 + 0.50001) AS DOUBLE) / 10000"


NAV_BRAND = """nav AS (
  SELECT CAST(l_shipdate AS DATE) AS date, min(l_extendedprice) AS nav,
         replace(p_brand, 'Brand#', '') AS scheme_code, p_brand AS scheme_name
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_brand, CAST(l_shipdate AS DATE))"""

NAV_PART = """nav AS (
  SELECT CAST(l_shipdate AS DATE) AS date, min(l_extendedprice) AS nav,
         CAST(p_partkey AS VARCHAR) AS scheme_code, p_name AS scheme_name
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_partkey, p_name, CAST(l_shipdate AS DATE))"""


def _metrics_sql(nav_cte: str) -> str:
    return f"""
WITH {nav_cte},
s AS (
  SELECT scheme_name, scheme_code, count(*) AS total_observations,
         min(date) AS start_date, max(date) AS end_date,
         arg_min_null(nav, (date, nav)) AS first_nav, arg_max_null(nav, (date, nav)) AS latest_nav,
         min(nav) AS min_nav, max(nav) AS max_nav, avg(nav) AS avg_nav, stddev_samp(nav) AS nav_volatility
  FROM nav WHERE nav IS NOT NULL
  GROUP BY scheme_name, scheme_code),
p AS (
  SELECT *, (latest_nav - first_nav) / nullif(first_nav, 0) * 100 AS total_return_pct,
         CAST(end_date - start_date AS INTEGER) AS period_days,
         (max_nav - min_nav) / nullif(min_nav, 0) * 100 AS max_fluctuation_pct
  FROM s)
SELECT scheme_name, scheme_code, total_observations, start_date, end_date, first_nav, latest_nav,
       min_nav, max_nav, {_r('avg_nav')} AS avg_nav, {_r('nav_volatility')} AS nav_volatility,
       {_r('total_return_pct')} AS total_return_pct, period_days,
       {_r('max_fluctuation_pct')} AS max_fluctuation_pct,
       {_r("CASE WHEN period_days > 0 THEN pow(latest_nav / nullif(first_nav, 0), 365.0::DOUBLE / period_days) - 1 ELSE 0 END * 100")} AS annualized_return_pct
FROM p"""


SUMMARY_SQL = f"""
WITH {NAV_BRAND},
s AS (
  SELECT scheme_name, scheme_code, count(nav) AS total_observations,
         min(date) AS start_date, max(date) AS end_date,
         arg_min_null(nav, (date, nav)) AS first_nav, arg_max_null(nav, (date, nav)) AS latest_nav,
         min(nav) AS min_nav, max(nav) AS max_nav, avg(nav) AS avg_nav, stddev_samp(nav) AS nav_volatility
  FROM nav WHERE date IS NOT NULL GROUP BY scheme_name, scheme_code),
p AS (SELECT *, CAST(end_date - start_date AS INTEGER) AS period_days FROM s)
SELECT scheme_name, scheme_code, total_observations, start_date, end_date, first_nav, latest_nav,
       min_nav, max_nav, {_r('avg_nav')} AS avg_nav, {_r('nav_volatility')} AS nav_volatility,
       {_r('(latest_nav - first_nav) / nullif(first_nav, 0) * 100')} AS total_return_pct, period_days,
       {_r('(pow(latest_nav / nullif(first_nav, 0), 365.0::DOUBLE / nullif(period_days, 0)) - 1) * 100')} AS annualized_return_pct
FROM p"""


def _ret(p: str, key: str) -> str:
    lag = f"lag(nav, {p}) OVER (PARTITION BY {key} ORDER BY date, nav NULLS FIRST)"
    return f"{_r(f'(nav - {lag}) / nullif({lag}, 0) * 100')} AS return_{p}d"


def _returns_sql(nav_cte: str, key: str, periods=(1, 7, 30)) -> str:
    return f"""
WITH {nav_cte}
SELECT date, nav, scheme_code, scheme_name, {', '.join(_ret(str(p), key) for p in periods)}
FROM nav"""


def _rolling_sql(n: int, nav_cte: str = NAV_BRAND) -> str:
    w = f"OVER (PARTITION BY scheme_name ORDER BY date, nav NULLS FIRST ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"""
WITH {nav_cte}
SELECT date, nav, scheme_code, scheme_name,
       {_r(f'avg(nav) {w}')} AS rolling_avg_nav,
       min(nav) {w} AS rolling_min_nav,
       max(nav) {w} AS rolling_max_nav,
       {_r(f'stddev_samp(nav) {w}')} AS rolling_volatility
FROM nav"""


def _latest_sql(nav_cte: str) -> str:
    return f"""
WITH {nav_cte}
SELECT scheme_name, scheme_code, date, nav,
       CAST(row_number() OVER (PARTITION BY scheme_code ORDER BY date DESC, nav DESC NULLS LAST, scheme_name) AS INTEGER) AS rn
FROM nav WHERE date IS NOT NULL
QUALIFY rn = 1"""


def _monthly_sql(nav_cte: str) -> str:
    return f"""
WITH {nav_cte}
SELECT scheme_name, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       arg_min_null(nav, (date, nav)) AS month_start_nav,
       arg_max_null(nav, (date, nav)) AS month_end_nav,
       count(*) AS trading_days
FROM nav WHERE date IS NOT NULL
GROUP BY scheme_name, year(date), month(date)"""


NAV_HOT = """nav AS (
  SELECT CAST(l_shipdate AS DATE) AS date, min(l_extendedprice) AS nav,
         CAST(p_partkey AS VARCHAR) AS scheme_code,
         CASE WHEN p_partkey % 3 = 0 THEN 'HOT' ELSE p_name END AS scheme_name
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_partkey, p_name, CAST(l_shipdate AS DATE))"""

_BRANDS = [f"Brand#{n}" for n in range(1, 26)]
PIVOT_SQL = f"""
WITH {NAV_BRAND}
SELECT date, {', '.join(f"min(nav) FILTER (WHERE scheme_name = '{x}') AS \"{x}\"" for x in _BRANDS)}
FROM nav GROUP BY date"""

NAV_BRAND_SQL = f"""
WITH {NAV_BRAND}
SELECT date, nav, scheme_code, scheme_name FROM nav"""

CATALOGUE_SQL = """SELECT CAST(p_partkey AS VARCHAR) AS schemeCode, p_name AS schemeName, p_type AS schemeType FROM part"""


def _iso(d: str) -> str:
    dd, mm, yy = d.split("-")
    return f"DATE '{yy}-{mm}-{dd}'"


# --------------------------------------------------------------------------- contract


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: per-scheme performance metrics over the sf0.001 tables."""
    return q_performance_metrics(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return core_queries() | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return core_oracle_sql() | LLM_ORACLE_SQL


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "performance_metrics": q_performance_metrics,
        "performance_metrics_by_part": q_performance_metrics_by_part,
        "scheme_summary": q_scheme_summary,
        "returns": q_returns,
        "returns_split": q_returns_split,
        "returns_by_code": q_returns_by_code,
        "returns_by_name": q_returns_by_name,
        "returns_by_name_split": q_returns_by_name_split,
        "rolling_metrics": q_rolling_metrics,
        "rolling_metrics_32": q_rolling_metrics_32,
        "rolling_metrics_split": q_rolling_metrics_split,
        "rolling_metrics_long_split": q_rolling_metrics_long_split,
        "rolling_metrics_by_name": q_rolling_metrics_by_name,
        "rolling_metrics_by_name_split": q_rolling_metrics_by_name_split,
        "returns_hot_key": q_returns_hot_key,
        "rolling_metrics_hot_key": q_rolling_metrics_hot_key,
        "latest_nav": q_latest_nav,
        "latest_nav_by_part": q_latest_nav_by_part,
        "monthly_nav": q_monthly_nav,
        "monthly_nav_by_name": q_monthly_nav_by_name,
        "pivot_nav": q_pivot_nav,
        "search_schemes": q_search_schemes,
        "search_schemes_type": q_search_schemes_type,
        "nav_range": q_nav_range,
        "nav_from_json": q_nav_from_json,
        "nav_from_json_split": q_nav_from_json_split,
        "nav_multi": q_nav_multi,
        "rejected_payloads": q_rejected_payloads,
        "nav_beside_rejects": q_nav_beside_rejects,
        "nav_table": q_nav_table,
        "pipeline_performance": q_pipeline_performance,
        "nav_union": q_nav_union,
        "top_nav": q_top_nav,
        "scan_schemes": q_scan_schemes,
        "scan_schemes_split": q_scan_schemes_split,
        "scheme_payload": q_scheme_payload,
    }


def core_oracle_sql() -> dict[str, str]:
    kw, ty = SEARCH_TYPE_KEYWORD
    return {
        "performance_metrics": _metrics_sql(NAV_BRAND),
        "performance_metrics_by_part": _metrics_sql(NAV_PART),
        "scheme_summary": SUMMARY_SQL,
        "returns": _returns_sql(NAV_BRAND, "scheme_name"),
        "returns_split": _returns_sql(NAV_BRAND, "scheme_name"),
        "returns_by_code": _returns_sql(NAV_PART, "scheme_code"),
        "returns_by_name": _returns_sql(NAV_PART, "scheme_name"),
        "returns_by_name_split": _returns_sql(NAV_PART, "scheme_name", SHORT_PERIODS),
        "rolling_metrics": _rolling_sql(ROLL_LONG),
        "rolling_metrics_32": _rolling_sql(ROLL_SHORT),
        "rolling_metrics_split": _rolling_sql(ROLL_SHORT),
        "rolling_metrics_long_split": _rolling_sql(ROLL_LONG),
        "rolling_metrics_by_name": _rolling_sql(ROLL_LONG, NAV_PART),
        "rolling_metrics_by_name_split": _rolling_sql(ROLL_TINY, NAV_PART),
        "returns_hot_key": _returns_sql(NAV_HOT, "scheme_name"),
        "rolling_metrics_hot_key": _rolling_sql(ROLL_LONG, NAV_HOT),
        "latest_nav": _latest_sql(NAV_BRAND),
        "latest_nav_by_part": _latest_sql(NAV_PART),
        "monthly_nav": _monthly_sql(NAV_BRAND),
        "monthly_nav_by_name": _monthly_sql(NAV_PART),
        "pivot_nav": PIVOT_SQL,
        "search_schemes": f"""
SELECT * FROM ({CATALOGUE_SQL}) c WHERE lower(schemeName) LIKE lower('%{SEARCH_KEYWORD}%')""",
        "search_schemes_type": f"""
SELECT * FROM ({CATALOGUE_SQL}) c
WHERE lower(schemeName) LIKE lower('%{kw}%') AND lower(schemeType) LIKE lower('%{ty}%')""",
        "nav_range": f"""
WITH {NAV_BRAND}
SELECT * FROM nav WHERE date >= {_iso(RANGE[0])} AND date <= {_iso(RANGE[1])}""",
        "nav_from_json": NAV_BRAND_SQL,
        "nav_from_json_split": NAV_BRAND_SQL,
        "nav_multi": f"""
WITH {NAV_BRAND},
m AS (SELECT replace(p_brand, 'Brand#', '') AS scheme_code, min('Fund ' || p_brand) AS scheme_name FROM part GROUP BY 1)
SELECT n.date, n.nav, n.scheme_code, m.scheme_name
FROM nav n JOIN m ON n.scheme_code = m.scheme_code
WHERE n.date >= {_iso(MULTI_RANGE[0])} AND n.date <= {_iso(MULTI_RANGE[1])}""",
        "rejected_payloads": f"""
WITH {NAV_BRAND}
SELECT scheme_code, strftime(date, '%Y') AS period, CAST(1 AS BIGINT) AS n
FROM nav WHERE CAST(scheme_code AS INTEGER) % 2 = 0 GROUP BY scheme_code, strftime(date, '%Y')""",
        "nav_beside_rejects": f"""
WITH {NAV_BRAND}
SELECT date, nav, scheme_code, CAST(NULL AS VARCHAR) AS scheme_name FROM nav WHERE CAST(scheme_code AS INTEGER) % 2 = 1""",
        "nav_table": f"""
WITH {NAV_BRAND}
SELECT date, nav, scheme_code, scheme_name FROM nav WHERE date >= {_iso(RANGE[0])} AND date <= {_iso(RANGE[1])}""",
        "pipeline_performance": _metrics_sql(NAV_BRAND.replace("p_brand AS scheme_name", "'Fund ' || p_brand AS scheme_name")),
        "nav_union": f"""
WITH {NAV_BRAND}, {NAV_PART.replace("nav AS (", "navp AS (", 1)}
SELECT date, nav, scheme_code, scheme_name FROM nav
UNION ALL
SELECT date, nav, scheme_code, CAST(NULL AS VARCHAR) AS scheme_name FROM navp""",
        "top_nav": f"""
WITH {NAV_BRAND}
SELECT date, nav, scheme_code, scheme_name FROM nav ORDER BY date, scheme_code, nav, scheme_name LIMIT 10""",
        "scan_schemes": CATALOGUE_SQL,
        "scan_schemes_split": CATALOGUE_SQL,
        "scheme_payload": f"""
WITH {NAV_BRAND}
SELECT scheme_code, strftime(date, '%Y-%m') AS period, count(*) AS n_points,
       min(date) AS first_date, max(date) AS last_date
FROM nav
GROUP BY scheme_code, strftime(date, '%Y-%m')""",
    }
