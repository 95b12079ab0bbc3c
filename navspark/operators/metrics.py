"""Per-scheme performance metrics and summaries.

Both are hash aggregations with a partial step in each scan task, so a scheme
holding a third of all rows costs no more than any other. The first and latest
NAV stand in the same aggregation (:func:`navspark.plans.endpoints.with_endpoints`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navspark.functions.exprs import annualised_pct, change_pct
from navspark.plans.endpoints import with_endpoints

GROUP = ("scheme_name", "scheme_code")


def _stats(nav: DataFrame, group: Sequence[str], count_col) -> DataFrame:
    stats = [
        count_col.alias("total_observations"),
        F.min("nav").alias("min_nav"),
        F.max("nav").alias("max_nav"),
        F.avg("nav").alias("avg_nav"),
        F.stddev_samp("nav").alias("nav_volatility"),
    ]
    return with_endpoints(nav, group, stats, "first_nav", "latest_nav").select(
        *group,
        "total_observations",
        "start_date",
        "end_date",
        "first_nav",
        "latest_nav",
        "min_nav",
        "max_nav",
        "avg_nav",
        "nav_volatility",
    )


def performance_metrics(nav: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Metrics over the non-NULL NAVs of each (name, code).

    ``total_observations`` counts those rows; returns use the first and latest
    NAV by date; ``annualized_return_pct`` is 0 when the period has no days.
    Division by a zero NAV gives NULL, never an error or infinity. Undated
    rows count and enter the value statistics but are never endpoints.
    """
    s = _stats(nav.where(F.col("nav").isNotNull()), group, F.count(F.lit(1)))
    days = F.datediff("end_date", "start_date")
    return (
        s.withColumn("total_return_pct", change_pct("latest_nav", "first_nav"))
        .withColumn("period_days", days)
        .withColumn("max_fluctuation_pct", change_pct("max_nav", "min_nav"))
        .withColumn(
            "annualized_return_pct",
            F.when(
                F.col("period_days") > 0,
                annualised_pct("latest_nav", "first_nav", "period_days"),
            ).otherwise(F.lit(0.0)),
        )
    )


def scheme_summary(nav: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Summary over all rows of each (name, code).

    Unlike :func:`performance_metrics`, NULL NAVs stay in: they are not
    counted, but their dates bound the period and a NULL on the last date
    makes ``latest_nav`` NULL. A zero-day period gives a NULL annualised
    return (no guard). Undated rows enter the counts and value statistics.
    """
    s = _stats(nav, group, F.count("nav"))
    return (
        s.withColumn("total_return_pct", change_pct("latest_nav", "first_nav"))
        .withColumn("period_days", F.datediff("end_date", "start_date"))
        .withColumn(
            "annualized_return_pct",
            annualised_pct("latest_nav", "first_nav", "period_days"),
        )
    )
