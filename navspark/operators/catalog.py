"""Catalogue search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _contains_ci(col: str, text: str) -> Column:
    # LOWER(col) LIKE LOWER('%' || text || '%'): the text is a bound literal,
    # never spliced into SQL, so quotes in it are plain characters. '%' and
    # '_' inside it still act as LIKE wildcards.
    pattern = F.lower(F.concat(F.lit("%"), F.lit(text), F.lit("%")))
    return F.like(F.lower(F.col(col)), pattern)


def search_schemes(
    catalogue: DataFrame,
    keyword: str,
    scheme_type: str | None = None,
    name_col: str = "schemeName",
    type_col: str = "schemeType",
) -> DataFrame:
    """Catalogue rows whose name contains ``keyword`` (case-insensitive) and,
    if given, whose type contains ``scheme_type``. A NULL name or type never
    matches. A filter only: it runs inside the scan stage, no shuffle."""
    cond = _contains_ci(name_col, keyword)
    if scheme_type:
        cond = cond & _contains_ci(type_col, scheme_type)
    return catalogue.where(cond)
