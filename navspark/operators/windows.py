"""Per-scheme sequence analytics: k-row returns and trailing-row statistics.

Both order a scheme's rows by (date, nav) - the NAV breaks ties on a date so
results never depend on input order - and count **rows**, not calendar days:
``return_7d`` compares with the 7th earlier row. The plan behind them is
:func:`navspark.plans.sequence.sequence_window`, which splits hot keys.

Trailing statistics over long frames. Spark evaluates a sliding
``rowsBetween(-(n-1), 0)`` frame by aggregating the whole frame again for
every row: ``n`` updates per row and statistic. For ``n`` above
``DIRECT_FRAME_ROWS`` the rows of a sequence are instead cut into blocks of
``n`` consecutive rows, and two cumulative frames per block (which Spark
updates incrementally, O(1) per row) give each row the statistics of its
block's prefix and suffix. The frame of row ``i`` is the suffix of row
``i - n + 1`` (one block back) joined with the prefix of row ``i``: min/max
are the lesser/greater of the two, and mean and sample deviation come from
merging the two parts' (count, sum, M2) with the parallel-variance formula.
Cost per row is constant in ``n``: a row number, two sorts within the
existing partitions (no extra shuffle) and a lag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navspark.functions.exprs import change_pct
from navspark.plans.sequence import BLOCK_ROWS, HOT_ROWS, sequence_window

# Trailing frames of up to this many rows use Spark's sliding frame directly.
DIRECT_FRAME_ROWS = 32


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def returns(
    nav: DataFrame,
    periods: Sequence[int] = (1, 7, 30),
    key: str | Sequence[str] = "scheme_name",
    split: str = "auto",
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Input rows plus ``return_{p}d`` = (nav - nav p rows earlier) / that * 100
    for each p. NULL for the first p rows of a key, when either NAV is NULL or
    the earlier NAV is 0. All periods share one window: one shuffle, one sort.
    ``counts`` (:func:`navspark.plans.sequence.key_counts`) saves counting again.
    """
    periods = [int(p) for p in periods]
    if any(p < 1 for p in periods):
        raise ValueError("return periods must be >= 1")

    def compute(df: DataFrame, parts: list[str], order: list[Column]) -> DataFrame:
        w = Window.partitionBy(*parts).orderBy(*order)
        return df.select(
            "*",
            *[change_pct("nav", F.lag("nav", p).over(w)).alias(f"return_{p}d") for p in periods],
        )

    return sequence_window(
        nav, _keys(key), max(periods, default=0), compute, split, hot_rows, block_rows, counts
    )


def _rolling_frame(df: DataFrame, parts: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*parts).orderBy(*order).rowsBetween(-(n - 1), Window.currentRow)
    return df.select(
        "*",
        F.avg("nav").over(w).alias("rolling_avg_nav"),
        F.min("nav").over(w).alias("rolling_min_nav"),
        F.max("nav").over(w).alias("rolling_max_nav"),
        F.stddev_samp("nav").over(w).alias("rolling_volatility"),
    )


def _rolling_blocks(df: DataFrame, parts: list[str], order: list[Column], n: int) -> DataFrame:
    cols = df.columns
    i, b = F.col("_i"), F.col("_b")
    w = Window.partitionBy(*parts).orderBy(*order)
    df = df.withColumn("_i", F.row_number().over(w) - F.lit(1))
    if "_p" in cols:
        # A part of a split key: count from the part's place in the whole
        # sequence, so that blocks are cut where the plain plan cuts them.
        first = F.first("_p").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        df = df.withColumn("_i", F.col("_i") + first)
    df = df.withColumn("_b", F.floor(i / F.lit(n)))
    cum = Window.partitionBy(*parts, "_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nav = F.col("nav")

    def stats(w, tag):
        return [
            F.count(nav).over(w).alias(f"_n{tag}"),
            F.sum(nav).over(w).alias(f"_s{tag}"),
            F.var_pop(nav).over(w).alias(f"_v{tag}"),
            F.min(nav).over(w).alias(f"_lo{tag}"),
            F.max(nav).over(w).alias(f"_hi{tag}"),
        ]

    # suffix (rows i..end of block) and prefix (start of block..i)
    df = df.select("*", *stats(cum.orderBy(i.desc()), "a"))
    df = df.select("*", *stats(cum.orderBy(i.asc()), "b"))
    back = Window.partitionBy(*parts).orderBy(b, i)  # same order as the prefix frame: no new sort
    df = df.select("*", *[F.lag(f"_{x}a", n - 1).over(back).alias(f"_{x}j") for x in ("n", "s", "v", "lo", "hi")])

    # Row i's frame is the suffix at i-n+1 plus the prefix at i, unless that
    # suffix is outside the sequence or is the whole of i's block.
    merge = (i >= F.lit(n)) & (i % F.lit(n) != F.lit(n - 1))
    na, nb = F.col("_nj"), F.col("_nb")
    sa, sb = F.coalesce(F.col("_sj"), F.lit(0.0)), F.coalesce(F.col("_sb"), F.lit(0.0))
    tot = na + nb
    delta = sb / nb - sa / na
    m2 = F.col("_vj") * na + F.col("_vb") * nb + delta * delta * na * nb / tot
    m2 = F.when(na == 0, F.col("_vb") * nb).when(nb == 0, F.col("_vj") * na).otherwise(m2)
    avg = F.when(merge, F.when(tot > 0, (sa + sb) / tot)).otherwise(F.when(nb > 0, sb / nb))
    sd = F.when(merge, F.when(tot > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (tot - 1)))).otherwise(
        F.when(nb > 1, F.sqrt(F.col("_vb") * nb / (nb - 1)))
    )
    return df.select(
        *cols,
        avg.alias("rolling_avg_nav"),
        F.least(F.col("_loj"), F.col("_lob")).alias("rolling_min_nav"),
        F.greatest(F.col("_hij"), F.col("_hib")).alias("rolling_max_nav"),
        sd.alias("rolling_volatility"),
    )


def rolling_metrics(
    nav: DataFrame,
    window_days: int = 252,
    key: str | Sequence[str] = "scheme_name",
    split: str = "auto",
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
    method: str = "auto",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Input rows plus mean, min, max and sample standard deviation of the NAV
    over the current row and the ``window_days - 1`` rows before it. The
    first rows of a key use the shorter frame they have (not NULLed);
    ``rolling_volatility`` is NULL while the frame has one non-NULL NAV.
    ``method``: ``"frame"`` (Spark's sliding frame), ``"blocks"`` (prefix and
    suffix blocks, constant cost per row) or ``"auto"`` (blocks above
    ``DIRECT_FRAME_ROWS``).
    """
    n = int(window_days)
    if n < 1:
        raise ValueError("window_days must be >= 1")
    if method not in ("auto", "frame", "blocks"):
        raise ValueError(f"method must be auto, frame or blocks, not {method!r}")
    blocks = method == "blocks" or (method == "auto" and n > DIRECT_FRAME_ROWS)

    def compute(df: DataFrame, parts: list[str], order: list[Column]) -> DataFrame:
        return (_rolling_blocks if blocks else _rolling_frame)(df, parts, order, n)

    return sequence_window(nav, _keys(key), n - 1, compute, split, hot_rows, block_rows, counts)
