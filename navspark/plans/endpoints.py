"""First and last value of each group by date, in one hash aggregation.

``min_by(nav, struct(date, nav))`` has a struct in its buffer, which a hash
aggregation cannot hold: Spark would sort every task's whole input first. So
day and value become one exact integer that sorts as the pair does
(:func:`navspark.functions.exprs.dated_order`). With it ``min_by`` and
``max_by`` have buffers of fixed width, stand beside the other statistics in
the same aggregation and leave each scan task as one row per group: one scan,
one small shuffle, no join, no sort and no job before the caller's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.functions.exprs import dated_order


def with_endpoints(
    nav: DataFrame, group: Sequence[str], stats: Sequence[Column], first: str, last: str
) -> DataFrame:
    """``group``, ``start_date``, ``end_date``, ``stats`` and the NAVs ``first`` and ``last``.

    Ties on the first date give the smallest NAV (NULL before all others),
    on the last date the largest (NULL only if the date has no other).
    Undated rows count in ``stats`` but are never endpoints: a group without
    dates has NULL endpoints.
    """
    order = dated_order("date", "nav")
    return nav.groupBy(*group).agg(
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        *stats,
        F.min_by("nav", order).alias(first),
        F.max_by("nav", order).alias(last),
    )
