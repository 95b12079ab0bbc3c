"""Assembling NAV from many schemes: naming by a code->name mapping and
unions of NAV frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from navspark.schemas import MAPPING_SCHEMA, NAV_COLUMNS
from navspark.sources.payload import filter_dates, landed_nav
from navspark.sources.sinks import nav_counts

# A dict mapping of up to this many bytes of text is broadcast to the scan
# tasks; for a larger one, and for a mapping table, Spark chooses by size.
MAX_BROADCAST_MAPPING_BYTES = 16 << 20


def mapping_frame(spark: SparkSession, mapping: Mapping[str, str] | DataFrame) -> DataFrame:
    """A dict or a DataFrame (``scheme_code, scheme_name``) -> mapping frame
    with one row per code (the smallest name wins for a repeated code)."""
    if isinstance(mapping, DataFrame):
        return mapping.groupBy(F.col("scheme_code").cast("string").alias("scheme_code")).agg(
            F.min("scheme_name").alias("scheme_name")
        )
    rows = [(str(k), None if v is None else str(v)) for k, v in mapping.items()]
    return spark.createDataFrame(rows, MAPPING_SCHEMA)


def attach_names(
    nav: DataFrame,
    mapping: Mapping[str, str] | DataFrame,
    how: str = "inner",
    max_broadcast_bytes: int = MAX_BROADCAST_MAPPING_BYTES,
) -> DataFrame:
    """Name NAV rows from a code->name mapping (equi-join on ``scheme_code``).

    ``how="inner"`` keeps only mapped schemes (the multi-scheme fetch);
    ``"left"`` keeps every row and leaves unknown codes unnamed. A dict is
    broadcast when its text is at most ``max_broadcast_bytes``; a mapping
    table is joined as Spark's size estimates choose, in a shuffle join with
    AQE's skew split for a code that holds a large share of the rows.
    """
    spark = nav.sparkSession
    m = mapping_frame(spark, mapping)
    if not isinstance(mapping, DataFrame):
        size = sum(len(str(k)) + len(str(v)) + 32 for k, v in mapping.items())
        m = F.broadcast(m) if size <= max_broadcast_bytes else m
    return nav.drop("scheme_name").join(m, "scheme_code", how).select(*NAV_COLUMNS)


def nav_multi(
    spark: SparkSession,
    root: str,
    mapping: Mapping[str, str] | DataFrame,
    start=None,
    end=None,
    with_fetch_time: bool = True,
    multiline: bool = True,
    split_documents: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """NAV of every scheme in ``mapping`` from the landed payloads, named,
    date-bounded and stamped with ``fetch_timestamp``.

    One scan of all the mapped schemes (of a dict only the schemes' own
    folders are listed); schemes with no data contribute no rows. The stamp
    is fixed per query run (``current_timestamp`` is folded at planning). An
    ``observation`` gets the counts of the landed points as they are parsed.
    """
    codes = None if isinstance(mapping, DataFrame) else list(mapping.keys())
    raw = landed_nav(spark, root, codes, multiline, split_documents)
    if observation is not None:
        raw = raw.observe(observation, *nav_counts())
    named = filter_dates(attach_names(raw, mapping, "inner"), start, end)
    if with_fetch_time:
        named = named.withColumn("fetch_timestamp", F.current_timestamp())
    return named


def nav_union(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of NAV frames by column name; a frame lacking ``scheme_name``
    (or any canonical column) contributes NULLs for it. Extra columns shared
    by the inputs are kept after the canonical ones."""
    frames = list(frames)
    if not frames:
        raise ValueError("nav_union needs at least one frame")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    for c in NAV_COLUMNS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    extra = [c for c in out.columns if c not in NAV_COLUMNS]
    return out.select(*NAV_COLUMNS, *extra)
