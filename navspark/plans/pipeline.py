"""End-to-end pipeline: landed catalogue + payloads -> tiered parquet outputs.

Tiers under ``out``::

    raw/schemes          catalogue
    raw/search           catalogue rows matching the keyword (and type)
    raw/nav              named NAV of the selected schemes + fetch_timestamp, by year
    processed/pivoted    one row per date, one column per scheme
    processed/returns    NAV + k-row returns
    processed/rolling    NAV + trailing-row statistics
    analysis/performance per-scheme metrics
    analysis/summary     per-scheme summary
    analysis/latest      newest NAV per scheme
    analysis/monthly     monthly first/last NAV and row count

The NAV table is written once and every later output is built from the
written copy, so the ingest is never recomputed and the lineage of the
analytics starts at a stored table (a lost executor re-reads parquet, not the
landed JSON). ``out`` must be shared storage on a cluster.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession

from navspark.operators.catalog import search_schemes
from navspark.operators.combine import nav_multi
from navspark.operators.metrics import performance_metrics, scheme_summary
from navspark.operators.periodic import latest_nav, monthly_nav
from navspark.operators.pivot import pivot_nav
from navspark.operators.windows import returns, rolling_metrics
from navspark.plans.sequence import key_counts
from navspark.sources.catalogue import read_schemes
from navspark.sources.popular import popular_schemes_mapping
from navspark.sources.sinks import read_nav_table, write_nav, write_table


def first_schemes(mapping: Mapping[str, str], n: int) -> dict[str, str]:
    """The first ``n`` entries of a mapping, in its order."""
    return dict(list(mapping.items())[: int(n)])


def run_pipeline(
    spark: SparkSession,
    catalogue_path: str,
    payload_root: str,
    out: str,
    mapping: Mapping[str, str] | DataFrame | None = None,
    keyword: str = "Axis",
    scheme_type: str | None = "Equity",
    start=None,
    end=None,
    n_schemes: int | None = None,
    return_periods=(1, 7, 30),
    rolling_rows: int = 252,
    tier_counts: dict[str, dict[str, int]] | None = None,
) -> dict[str, DataFrame]:
    """Run all tiers and return their reread tables by name.

    Every scheme of ``mapping`` (the popular schemes if None) and every date
    is taken unless ``start``, ``end`` or ``n_schemes`` (the first so many
    entries of a dict) ask for less. The wide table comes last, so too many
    schemes for a pivot cost none of the other results. Small results are
    written in order: pivot by date, latest by name and code, monthly by
    name, year and month.

    ``tier_counts`` is filled with the row counts of every output by its path
    under ``out``, and for ``raw/nav`` also with ``parsed_rows``,
    ``unparsed_dates`` and ``unparsed_navs`` of the landed points before dates
    and names select any. They are observed while the tiers are written: no
    job counts them.
    """
    out = out.rstrip("/")
    p = {
        k: f"{out}/{k}"
        for k in (
            "raw/schemes", "raw/search", "raw/nav", "processed/pivoted", "processed/returns",
            "processed/rolling", "analysis/performance", "analysis/summary", "analysis/latest",
            "analysis/monthly",
        )
    }

    seen: dict[str, list[Observation]] = {}

    def watch(tier: str) -> Observation | None:
        if tier_counts is None:
            return None
        seen.setdefault(tier, []).append(Observation())
        return seen[tier][-1]

    def store(df: DataFrame, tier: str) -> None:
        write_table(df, p[tier], observation=watch(tier))

    schemes = read_schemes(spark, catalogue_path)
    store(schemes, "raw/schemes")
    schemes = spark.read.parquet(p["raw/schemes"])
    store(search_schemes(schemes, keyword, scheme_type), "raw/search")

    if mapping is None:
        mapping = popular_schemes_mapping()
    if n_schemes is not None and not isinstance(mapping, DataFrame):
        mapping = first_schemes(mapping, n_schemes)
    raw = nav_multi(spark, payload_root, mapping, start, end, observation=watch("raw/nav"))
    write_nav(raw, p["raw/nav"], observation=watch("raw/nav"))
    nav = read_nav_table(spark, p["raw/nav"])

    counts = key_counts(nav, ["scheme_name"])
    store(returns(nav, return_periods, counts=counts), "processed/returns")
    store(rolling_metrics(nav, rolling_rows, counts=counts), "processed/rolling")
    store(performance_metrics(nav), "analysis/performance")
    store(scheme_summary(nav), "analysis/summary")
    store(latest_nav(nav).orderBy("scheme_name", "scheme_code"), "analysis/latest")
    store(monthly_nav(nav).orderBy("scheme_name", "year", "month"), "analysis/monthly")
    store(pivot_nav(nav).orderBy("date"), "processed/pivoted")

    for tier, observed in seen.items():
        counts = [dict(o.get) for o in observed]
        if tier == "raw/nav":
            points, written = counts
            counts = [{"rows": written["rows"], "parsed_rows": points["rows"]} | {k: v for k, v in points.items() if k != "rows"}]
        tier_counts[tier] = counts[0]

    res = {k.split("/")[1]: spark.read.parquet(v) for k, v in p.items() if k != "raw/nav"}
    res["nav"] = nav
    return res
