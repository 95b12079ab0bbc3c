"""Rows whose columns may have any names: packed into one struct while an operator works."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as SQL takes it literally."""
    return "`" + name.replace("`", "``") + "`"


def packed(columns: Sequence[str]) -> Column:
    """The columns as the struct ``row``."""
    return F.struct(*[F.col(quoted(c)) for c in columns]).alias("row")


def unpacked(rows: DataFrame, *more: str) -> DataFrame:
    """The columns inside ``row``, and ``more`` from beside it."""
    names = rows.schema["row"].dataType.names
    return rows.select(*[F.col("row")[n].alias(n) for n in names], *more)


def identity(*columns: str) -> Column:
    """128-bit digest of the columns' values; nulls differ from every value."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.col(quoted(c)).cast("string")), F.lit("n")) for c in columns]
    # Lengths keep neighbouring values apart.
    sized = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.md5(F.concat(*sized))
