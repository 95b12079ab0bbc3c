"""Adapters from the shared test tables (TPC-H-like parquet) to the NAV model.

``lineitem`` rows stand in for price observations and ``part`` for the scheme
catalogue. They are inputs for tests and benchmarks; the prices have no
meaning as a fund history in themselves.

Scale notes: the adapters are one join (lineitem x part on the part key) and
one aggregation. Only the needed columns reach the scans (``ReadSchema``).
The join strategy is left to Spark: part is a dimension, so the planner
broadcasts it when its size statistics are under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans at runtime from
measured sizes; above that it is a sort-merge join on a uniform key. The
aggregation is partial before its shuffle, so a hot scheme or date costs one
row per map task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navspark.plans.materialize import broadcast_if_small, materialize
from navspark.schemas import NAV_COLUMNS
from navspark.session import ensure_checkpoint_dir

# A rendered payload document holds at most about this many points.
MAX_DOC_POINTS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _priced(spark: SparkSession, sf_dir: str, *part_cols: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("price"),
    )
    pt = table(spark, sf_dir, "part").select("p_partkey", *part_cols)
    return li.join(pt, li["l_partkey"] == pt["p_partkey"], "inner")


def nav_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scheme per brand (25 schemes); NAV of a day = the lowest price of
    the brand's items shipped that day. Unique per (scheme, date)."""
    return (
        _priced(spark, sf_dir, "p_brand")
        .groupBy("p_brand", "date")
        .agg(F.min("price").alias("nav"))
        .select(
            "date",
            "nav",
            F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).alias("scheme_code"),
            F.col("p_brand").alias("scheme_name"),
        )
        .select(*NAV_COLUMNS)
    )


def nav_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scheme per part (thousands of schemes, and many codes share a
    name, which exercises name- versus code-keyed operators)."""
    return (
        _priced(spark, sf_dir, "p_name")
        .groupBy("p_partkey", "p_name", "date")
        .agg(F.min("price").alias("nav"))
        .select(
            "date",
            "nav",
            F.col("p_partkey").cast("string").alias("scheme_code"),
            F.col("p_name").alias("scheme_name"),
        )
    )


def scheme_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows from ``part``: code = part key, name, type."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("schemeCode"),
        F.col("p_name").alias("schemeName"),
        F.col("p_type").alias("schemeType"),
    )


def landing_folder(spark: SparkSession, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed-{kind}-{uuid.uuid4().hex}"


def landed_payloads(nav: DataFrame, period: str | None = "yyyy") -> str:
    """Write a NAV table as landed payload files, one folder per scheme and one
    document per file, under the session's shared checkpoint folder; returns
    the root. Whole table, every point; documents hold a ``period`` (None: all
    dates)."""
    return land_documents(payload_documents(nav, period=period))


def land_documents(docs: DataFrame) -> str:
    """Write documents (``scheme_code, value``) as landed files; returns the root."""
    root = landing_folder(docs.sparkSession, "payloads")
    docs.select("scheme_code", "value").write.partitionBy("scheme_code").option("maxRecordsPerFile", 1).text(root)
    return root


def landed_catalogue(catalogue: DataFrame, per_document: int = 5_000) -> str:
    """Write a catalogue as landed documents (JSON arrays of about
    ``per_document`` schemes, one per file); returns the folder."""
    root = landing_folder(catalogue.sparkSession, "catalogue")
    n = max(1, -(-catalogue.count() // per_document))
    part = F.pmod(F.xxhash64(*catalogue.columns), F.lit(n)).alias("part")
    docs = catalogue.groupBy(part).agg(
        F.to_json(F.collect_list(F.struct(*catalogue.columns))).alias("value")
    )
    docs.select("value").write.option("maxRecordsPerFile", 1).text(root)
    return root


def payload_documents(nav: DataFrame, max_points: int = MAX_DOC_POINTS, period: str | None = "yyyy-MM") -> DataFrame:
    """Render a NAV table as payload documents in the service's text format:
    ``scheme_code, period, part, value``, one or more documents per scheme and
    ``period`` (a date pattern; months unless given, None for all dates), each holding at most about ``max_points`` points.

    Copies of a point first collapse into one row with a multiplicity (a
    partial aggregation). A (scheme, month) over ``max_points`` points is cut
    into ``ceil(n / max_points)`` parts by a hash of the point and its copy
    chunk, and the copies are regenerated inside each bounded document, so
    neither a hot scheme nor a pile of copies gathers into one row.
    """
    d = int(max_points)
    pts = nav.select(
        "scheme_code",
        (F.date_format("date", period) if period else F.lit("all")).alias("period"),
        F.struct(
            F.date_format("date", "dd-MM-yyyy").alias("date"),
            F.col("nav").cast("string").alias("nav"),
        ).alias("p"),
    )
    runs = pts.groupBy("scheme_code", "period", "p").agg(F.count(F.lit(1)).alias("_m"))
    # Groups too large for one document: at most (rows / max_points) of them.
    big = materialize(
        runs.groupBy("scheme_code", "period")
        .agg(F.sum("_m").alias("_n"))
        .where(F.col("_n") > F.lit(d))
        .select("scheme_code", "period", F.ceil(F.col("_n") / F.lit(d)).alias("_parts"))
    )
    n_big = big.count()
    if n_big:
        bj = big.select(F.col("scheme_code").alias("_b_code"), F.col("period").alias("_b_period"), "_parts")
        bj = broadcast_if_small(bj)
        on = runs["scheme_code"].eqNullSafe(bj["_b_code"]) & runs["period"].eqNullSafe(bj["_b_period"])
        chunks = (
            runs.join(bj, on, "left")
            .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_m") / F.lit(d)) - 1)))
            .withColumn("_w", F.least(F.lit(d).cast("long"), F.col("_m") - F.col("_c") * F.lit(d)))
            .withColumn(
                "part",
                F.when(F.col("_parts").isNull(), F.lit(0).cast("long")).otherwise(
                    F.pmod(F.xxhash64("p", "_c"), F.col("_parts"))
                ),
            )
        )
    else:
        chunks = runs.withColumn("_w", F.col("_m")).withColumn("part", F.lit(0).cast("long"))
    points = F.flatten(
        F.transform(F.collect_list(F.struct("p", "_w")), lambda x: F.array_repeat(x["p"], x["_w"].cast("int")))
    )
    return chunks.groupBy("scheme_code", "period", "part").agg(
        F.to_json(F.struct(points.alias("data"))).alias("value")
    )
