"""Mixing sources to target weights by Poisson replication.

Each document's number of copies is a Poisson draw with the mean its source
needs to reach its target weight, found by inverting the distribution at a
uniform number hashed from the seed and the document. The draws need no
coordination, are the same on every run and recompute, and keep the expected
size of every source exact. Copies are exploded and dealt out by a hash of
seed, document and copy number, so sources end up interleaved.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.packing import packed, quoted, unpacked
from navspark.plans.materialize import BROADCAST_BYTES, materialize, table_bytes

SEED = 20240229
#: Without explicit weights a source of n documents weighs n ** TEMPERATURE.
TEMPERATURE = 0.5
#: Means above this are drawn as sums of equal parts, so exp(-mean) stays normal.
PART_MEAN = 400.0
#: Salted keys for a rate table too large to broadcast.
SALTS = 64


def hash_uniform(*parts: Column) -> Column:
    """A double in [0, 1) from the first 52 bits of an MD5 of ``:``-joined parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def poisson_cdf(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until the tail is below double precision."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    first = F.exp(-mean)
    return F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("cdf")),
        lambda s, k: F.struct(
            (s["p"] * mean / k).alias("p"),
            (s["c"] + s["p"] * mean / k).alias("c"),
            F.concat(s["cdf"], F.array(s["c"] + s["p"] * mean / k)).alias("cdf"),
        ),
        lambda s: s["cdf"],
    )


def source_rates(
    docs: DataFrame, source_col: str, weights: Mapping[str, float] | DataFrame | None, total: float | None
) -> DataFrame:
    """``(source, rate, parts, cdf)``: mean copies per document of each source.

    ``weights`` maps sources to non-negative numbers of any scale (a dict, or a
    frame ``source, weight``); sources without one get none. None weighs a
    source by ``count ** TEMPERATURE``. Null is a source like any other.
    ``total`` is the expected number of copies, the input's rows if None.
    """
    counts = docs.groupBy(F.col(quoted(source_col)).alias("source")).agg(F.count("*").cast("double").alias("n"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow("n", F.lit(TEMPERATURE)))
    else:
        if not isinstance(weights, DataFrame):
            spark = docs.sparkSession
            weights = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, weight double")
        w = weights.groupBy(F.col("source").alias("_source")).agg(F.sum("weight").alias("weight"))
        weighed = counts.join(w, counts["source"].eqNullSafe(w["_source"]), "left").drop("_source")
        weighed = weighed.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    weighed = materialize(weighed)
    sums = weighed.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    size = float(total if total is not None else sums["n"] or 0.0)
    scale = size / sums["weight"] if sums["weight"] else 0.0
    mean = F.col("weight") * F.lit(scale) / F.col("n")
    rates = weighed.select("source", mean.alias("rate"), F.greatest(F.lit(1.0), F.ceil(mean / PART_MEAN)).cast("int").alias("parts"))
    return rates.withColumn("cdf", poisson_cdf(F.col("rate") / F.col("parts")))


def poisson_mix(
    docs: DataFrame,
    weights: Mapping[str, float] | DataFrame | None = None,
    total: float | None = None,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep_all_columns: bool = False,
) -> DataFrame:
    """Copies of ``docs`` in the target mix, globally shuffled.

    Returns the id, text and source columns (or with ``keep_all_columns`` every
    column of ``docs``), ``copy`` (1, 2, ...), ``copies`` and ``shuffle_key``.
    Rows with a null id draw by their text's digest. Repeated rows draw alike,
    each for itself. A null source is a source; null and empty texts are mixed
    like others; an empty table gives an empty result. Columns of the input
    named like the three added ones are replaced by them.
    """
    added = {"copy", "copies", "shuffle_key"}
    columns = [c for c in docs.columns if c not in added] if keep_all_columns else [id_col, text_col, source_col]
    rates = materialize(source_rates(docs, source_col, weights, total))
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    draw = F.coalesce(F.col(quoted(id_col)).cast("string"), F.concat(F.lit("null-"), F.md5(text)))
    keyed = docs.select(packed(columns), F.col(quoted(source_col)).alias("of_source"), draw.alias("draw"))
    same = F.col("of_source").eqNullSafe(F.col("source"))
    if table_bytes(rates) <= BROADCAST_BYTES:
        joined = keyed.join(F.broadcast(rates), same)
    else:
        spread = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = keyed.withColumn("row_salt", F.pmod(F.xxhash64("draw"), F.lit(SALTS)).cast("int")).join(
            spread, same & (F.col("row_salt") == F.col("salt"))
        )

    def part(j: Column) -> Column:
        u = hash_uniform(F.lit(str(seed)), j.cast("string"), F.col("draw"))
        return F.struct(u.alias("u"))

    drawn = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.col("parts")), part),
        F.lit(0),
        lambda n, p: n + F.size(F.filter("cdf", lambda c: c <= p["u"])),
    )
    counted = joined.select("row", "draw", drawn.alias("copies")).where("copies > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    keyed = copies.withColumn(
        "shuffle_key", F.md5(F.concat_ws(":", F.lit(f"order-{seed}"), F.col("draw"), F.col("copy").cast("string")))
    )
    mixed = keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return unpacked(mixed, "copy", "copies", "shuffle_key")


MIX_SQL = f"""
WITH RECURSIVE counts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY source),
sums AS (SELECT sum(n) AS n, sum(pow(n, {TEMPERATURE})) AS weight FROM counts),
rates AS (
  SELECT source, pow(c.n, {TEMPERATURE}) * (s.n / s.weight) / c.n AS rate FROM counts c, sums s),
parted AS (
  SELECT source, CAST(greatest(1, ceil(rate / {PART_MEAN})) AS INTEGER) AS parts,
         rate / greatest(1, ceil(rate / {PART_MEAN})) AS mean FROM rates),
cdf AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM parted
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf
  WHERE k < ceil(mean + 12 * sqrt(mean) + 30)),
drawn AS (
  SELECT d.doc_id, d.text, d.source, p.j,
         CAST(CAST('0x' || substr(md5('{SEED}:' || p.j || ':' || d.doc_id), 1, 13) AS BIGINT) AS DOUBLE) / {2**52}.0 AS u
  FROM documents d JOIN (SELECT source, unnest(generate_series(1, parts)) AS j FROM parted) p
    ON d.source IS NOT DISTINCT FROM p.source),
lists AS (SELECT source, list(c ORDER BY k) AS cs FROM cdf GROUP BY source),
counted AS (
  SELECT d.doc_id, any_value(d.text) AS text, any_value(d.source) AS source,
         CAST(sum(len(list_filter(l.cs, lambda x: x <= d.u))) AS INTEGER) AS copies
  FROM drawn d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source GROUP BY d.doc_id)
SELECT doc_id, text, source, copy, copies, md5('order-{SEED}:' || doc_id || ':' || copy) AS shuffle_key
FROM (SELECT *, CAST(unnest(generate_series(1, copies)) AS INTEGER) AS copy FROM counted WHERE copies > 0)
"""
