"""Long -> wide NAV (one row per date, one column per scheme)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_COLUMN = "null"


def pivot_values(nav: DataFrame, name_col: str = "scheme_name") -> list[str | None]:
    """Sorted distinct names (NULL first, if any), the pivot's columns.

    Their number is bounded as in Spark's own pivot, by
    ``spark.sql.pivotMaxValues``: more names are an error, never a silently
    truncated pivot, and the setting raises the bound.
    """
    most = int(nav.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    vals = [r[0] for r in nav.select(name_col).distinct().limit(most + 1).collect()]
    if len(vals) > most:
        raise ValueError(
            f"pivot would have more than {most} columns; pass values= or raise spark.sql.pivotMaxValues"
        )
    return sorted(vals, key=lambda v: (v is not None, v or ""))


def pivot_nav(
    nav: DataFrame, values: Sequence[str | None] | None = None, name_col: str = "scheme_name"
) -> DataFrame:
    """``date`` plus one DOUBLE column per scheme name holding that day's NAV.

    Every date of the input appears (cells without data are NULL). Rows
    without a name fill the column ``null``. A cell is the day's NAV; if a
    scheme has several rows on one day the smallest is taken, so the result
    never depends on row order. ``values`` names the columns to build, any
    number of them. Spark plans two aggregation levels (per date and name,
    then a pivot per date), both with partial aggregation before their shuffles.
    """
    names = pivot_values(nav, name_col) if values is None else list(values)
    daily = nav.groupBy("date", name_col).agg(F.min("nav").alias("nav"))
    if None not in names:
        return daily.groupBy("date").pivot(name_col, names).agg(F.min("nav"))
    # Names travel with a prefix, so that NULL cannot meet a scheme called "null".
    marked = daily.withColumn("_name", F.coalesce(F.concat(F.lit("n:"), F.col(name_col)), F.lit("-")))
    wide = marked.groupBy("date").pivot("_name", [f"n:{v}" if v is not None else "-" for v in names]).agg(F.min("nav"))
    return wide.toDF("date", *[NULL_COLUMN if v is None else v for v in names])
