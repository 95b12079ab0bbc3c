"""Parquet sinks.

Replacing a table is staged: the new one is written beside the old one and takes
its place by renaming when it is complete, so a write that fails leaves the old
table as it was, and a table may be rewritten from itself. A re-run after a lost
job or executor leaves the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from navspark.functions.exprs import parse_arg_date
from navspark.plans.sequence import HOT_ROWS, key_counts


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder, then put it in the place of ``path``.

    The new and the displaced folder are siblings of ``path`` whose names begin
    with ``_``, which Spark's readers of the parent folder do not see. If the
    driver dies between the two renames, :func:`restore_folder` puts the
    displaced table back.
    """
    fs, target = _file_system(spark, path.rstrip("/"))
    tag = uuid.uuid4().hex
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    staging, old = (jpath(target.getParent(), f"_{target.getName()}.{kind}-{tag}") for kind in ("staging", "old"))
    try:
        write(staging.toString())
    except BaseException:
        fs.delete(staging, True)
        raise
    had_old = fs.exists(target) and fs.rename(target, old)
    if not fs.rename(staging, target):
        if had_old:
            fs.rename(old, target)
        raise OSError(f"cannot move the new table to {path}; it is left at {staging.toString()}")
    if had_old:
        fs.delete(old, True)


def restore_folder(spark: SparkSession, path: str) -> bool:
    """Put back the table that a replacement of ``path`` had set aside when it
    was interrupted; True if there was one to put back."""
    fs, target = _file_system(spark, path.rstrip("/"))
    if fs.exists(target):
        return False
    prefix = f"_{target.getName()}.old-"
    aside = [s.getPath() for s in fs.listStatus(target.getParent()) if s.getPath().getName().startswith(prefix)]
    return bool(aside) and fs.rename(max(aside, key=lambda p: fs.getFileStatus(p).getModificationTime()), target)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", observation: Observation | None = None) -> None:
    """Write ``df`` as parquet. ``overwrite`` is staged (:func:`replace_folder`),
    other modes are Spark's. An ``observation`` gets the number of ``rows``
    while they are written."""
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    if mode == "overwrite":
        replace_folder(df.sparkSession, path, lambda p: df.write.parquet(p))
    else:
        df.write.mode(mode).parquet(path)


def write_nav(nav: DataFrame, path: str, mode: str = "overwrite", observation: Observation | None = None) -> None:
    """NAV table partitioned by ``year`` so date-bounded reads prune files.

    The rows are rebalanced on ``year`` before the write (the REBALANCE hint):
    AQE cuts a year's shuffle output into partitions of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and merges small
    ones, so files have a sane size and a year, scheme, day or pile of copies
    holding a large share of the rows is still written by many tasks (the cut
    is by map-output blocks, not by key). Each task sorts its rows by
    (scheme_code, date), so parquet row groups carry tight min/max
    statistics for pushed-down filters. Rows with a NULL date land in the
    ``year=__HIVE_DEFAULT_PARTITION__`` part.

    ``overwrite`` replaces the whole table, staged; ``years`` replaces only
    the years that ``nav`` has rows of, each when all of them are written
    (Spark's dynamic partition overwrite); other modes are Spark's. An
    ``observation`` gets ``rows``, and those without a date and a NAV.
    """
    if observation is not None:
        nav = nav.observe(observation, *nav_counts())
    out = nav_layout(nav).write.partitionBy("year")
    if mode == "overwrite":
        replace_folder(nav.sparkSession, path, out.parquet)
    elif mode == "years":
        out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        out.mode(mode).parquet(path)


def nav_counts():
    """Row counts of a NAV frame for an ``Observation``: all rows, rows whose
    date and rows whose NAV are NULL (absent or not parsed)."""
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("date").isNull()).alias("unparsed_dates"),
        F.count_if(F.col("nav").isNull()).alias("unparsed_navs"),
    ]


def write_nav_bucketed(nav: DataFrame, table: str, path: str, buckets: int, key: str = "scheme_name") -> None:
    """Catalogue table ``table`` with files at ``path``, bucketed by ``key`` and
    sorted by (key, date, nav): operators over one key's sequence read it
    without a shuffle (see :func:`read_nav_bucketed`).

    The rows are rebalanced on the key, so each task writes few buckets, and
    a key that holds a large share of the rows is written by many tasks, each
    with its own file of the bucket.
    """
    rows = nav.hint("rebalance", key)
    rows.write.mode("overwrite").option("path", path).bucketBy(int(buckets), key).sortBy(key, "date", "nav").saveAsTable(table)


def read_nav_bucketed(
    spark: SparkSession, table: str, key: str = "scheme_name", hot_rows: int = HOT_ROWS, counts: DataFrame | None = None
) -> DataFrame:
    """A table of :func:`write_nav_bucketed`: its buckets if no key has more than
    ``hot_rows`` rows, else its files.

    A bucket is read by one task. With a hot key that task would hold a large
    share of the table, so then the files are read as such, split at any size,
    and operators take their split plan for the hot key.
    """
    nav = spark.table(table)
    counts = key_counts(nav, [key]) if counts is None else counts
    if counts.where(F.col("_n") + F.col("_u") > int(hot_rows)).isEmpty():
        return nav
    folder = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    return spark.read.schema(nav.schema).parquet(folder)


def nav_layout(nav: DataFrame) -> DataFrame:
    """``nav`` plus ``year``, rebalanced and sorted as :func:`write_nav` writes it."""
    return (
        nav.withColumn("year", F.year("date"))
        .hint("rebalance", "year")
        .sortWithinPartitions("year", "scheme_code", "date")
    )


def read_nav_table(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Read a table written by :func:`write_nav` (all its columns but the
    ``year`` partition column). Date bounds prune ``year`` partitions and are
    pushed into the parquet scan."""
    df = spark.read.parquet(path)
    s, e = parse_arg_date(start), parse_arg_date(end)
    if s is not None:
        df = df.where((F.col("year") >= s.year) & (F.col("date") >= F.lit(s)))
    if e is not None:
        df = df.where((F.col("year") <= e.year) & (F.col("date") <= F.lit(e)))
    return df.drop("year")
