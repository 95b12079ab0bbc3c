"""Row selection: date ranges and first-n reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import MapType, VariantType

from navspark.sources.payload import filter_dates


def nav_range(nav: DataFrame, start=None, end=None) -> DataFrame:
    """Rows with ``start <= date <= end`` (both inclusive, both optional;
    'dd-mm-yyyy' text or dates). As soon as one bound is given, rows with a
    NULL date drop out. The predicate is a plain comparison on ``date``, so it
    reaches the parquet scan (PushedFilters) and prunes row groups."""
    return filter_dates(nav, start, end)


def top_nav(nav: DataFrame, n: int = 10, order: Sequence[str] = ("date", "scheme_code")) -> DataFrame:
    """First ``n`` rows in ``order``, then by the remaining columns (so ties
    have one result): a top-k report (the limit is the feature). Planned as TakeOrderedAndProject: each task keeps its own n
    best rows and only those reach the final merge, never a global sort."""
    rest = [
        f.name for f in nav.schema.fields if f.name not in order and not isinstance(f.dataType, (MapType, VariantType))
    ]
    return nav.orderBy(*order, *rest).limit(int(n))
