"""Latest NAV per scheme and the monthly roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from navspark.plans.endpoints import with_endpoints


def latest_nav(nav: DataFrame, key: str = "scheme_code") -> DataFrame:
    """The newest row of each ``key``: ``scheme_name, scheme_code, date, nav, rn``
    (``rn`` is always 1). Ties on the date go to the larger NAV, then to the
    smaller name and code.

    ``row_number() ... = 1`` is planned with WindowGroupLimit: a partial
    top-1 runs in every scan task before the shuffle, so each task sends at
    most one row per key and a hot key cannot swamp the final task.
    """
    w = Window.partitionBy(key).orderBy(F.col("date").desc(), F.col("nav").desc(), "scheme_name", "scheme_code")
    return (
        nav.where(F.col("date").isNotNull())
        .select("scheme_name", "scheme_code", "date", "nav", F.row_number().over(w).alias("rn"))
        .where(F.col("rn") == 1)
    )


def monthly_nav(nav: DataFrame, key: str = "scheme_name") -> DataFrame:
    """Per ``key``, year and month: first and last NAV of the month by date
    and the number of rows (``trading_days``, NULL NAVs included). Undated
    rows form one group per key with NULL year, month and NAVs.

    Hash aggregations with partial steps; output is at most one row per key
    and calendar month.
    """
    months = nav.select(
        key, F.year("date").alias("year"), F.month("date").alias("month"), "date", "nav"
    )
    count = F.count(F.lit(1)).alias("trading_days")
    return with_endpoints(
        months, [key, "year", "month"], [count], "month_start_nav", "month_end_nav"
    ).select(key, "year", "month", "month_start_nav", "month_end_nav", "trading_days")
