"""Connected components of a link table by alternating large-star and small-star.

Labels, links and components stay in DataFrames; only row counts and one
checksum per round reach the driver. Minima are pre-aggregated before their
shuffle and joined back, so a node with very many links never sits in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navspark.plans.materialize import Stored, broadcast_if_small

MAX_ROUNDS = 60


def _minimum(edges: DataFrame, used: list[Stored]) -> DataFrame:
    """``(u, m)``: each node's smallest neighbour or itself, ready to be joined with ``edges``.

    ``u`` is a new expression, so a shuffle join deals both sides anew and
    Spark can split a node with very many links; a small table is sent whole
    and the links stay where they are.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    used.append(Stored(low.select(F.greatest("u", "m").alias("u"), "m")))
    return broadcast_if_small(used[-1].df)


def _large_star(edges: DataFrame, used: list[Stored]) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_minimum(both, used), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, used: list[Stored]) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minimum(down, used)
    return down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))


def components_table(edges: DataFrame) -> Stored:
    """``(node, component)`` for every node of ``edges(u, v)``, stored: the smallest node reachable.

    Rows with a null end are ignored; self links and repeated links are
    allowed; an empty table gives an empty result. Rounds grow with the
    logarithm of the longest chain; a round's tables are deleted when the next
    one has used them.
    """
    clean = edges.select("u", "v").where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    current = Stored(clean.distinct())
    state = None
    for _ in range(MAX_ROUNDS):
        used = [current]
        step = _small_star(_large_star(current.df, used), used).where(F.col("u") != F.col("v")).distinct()
        current = Stored(step)
        for table in used:
            table.drop()
        now = current.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    stars = current.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = Stored(stars.union(stars.select(F.col("component").alias("node"), "component")).distinct())
    current.drop()
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """The table of :func:`components_table`, for callers that keep it to the end."""
    return components_table(edges).df
