"""Skew-safe plan for per-scheme sequence windows (k-row lags, trailing-row
frames).

A sequence is a key's rows in the order (date, NAV with NULLs first, row
hash): ties on a date are broken by the NAV, and rows equal in both by
``xxhash64`` of the whole row, so the order does not depend on how the input
is partitioned. With one NAV per scheme and day the order is the dates.

A plain ``Window.partitionBy(key).orderBy(...)`` sends each key's whole
history to one task. That is right for ordinary keys, so keys with at most
``hot_rows`` rows (all keys, in the usual case) take exactly that plan. A key
holding a large share of all rows is split instead; since the calendar is
short, such a key may also hold very many rows per day (a third of 100 TB is
about 10^8 rows per day of a 30-year history), so the split goes below days:

1. **Copies collapse into runs.** Rows identical in every column are grouped
   (a partial aggregation: a group of copies costs one row per task) into a
   run with multiplicity ``m``. A window that looks back at most ``halo`` rows
   gives every copy after the first ``halo + 1`` of a run the same result as
   copy ``halo``, so each run is expanded to at most ``halo + 1`` *head* rows
   and the last head carries the weight of the remaining copies.
2. **Sampled ranges, counted pieces.** The heads are range-partitioned by (key,
   date, NAV, row hash, copy number): Spark samples them and sends every head
   to its range. No two heads are equal in all of these, so a day, a NAV or a
   pile of copies of any size is cut like everything else, in one step. The
   sample goes through the driver and every range is a task, so their number
   does not follow the number of blocks: up to ``FEW_RANGES`` a range is one
   block, beyond that ranges hold up to ``RANGE_ROWS`` heads, and each, sorted
   in its task, is cut by counting into pieces of ``block_rows`` heads. The
   part of a key in one piece is a *block*.
3. **Prefix counts and halos.** One aggregation counts the heads of every block;
   a running count over that small table gives each block its place in the
   sequence, and shows which earlier blocks hold the ``halo`` heads before its
   first. Only the last ``halo`` heads of a block (a partial top-``halo`` in
   each task) are copied to the blocks that need them.
4. **One window pass** over (key, block); halo copies are dropped.
5. **Expansion.** The carried copies are regenerated. When the block table
   shows that some block would emit more than ``4 * block_rows`` rows, the
   copies are cut into chunks of ``CHUNK_ROWS`` and the chunks are spread over
   tasks by a shuffle before they are generated; otherwise they are generated
   in place.

The result equals the plain plan's (property tests compare them). The ranged
heads and the block table are written to the session's
``spark.checkpoint.dir``: a lost executor costs tasks that read them, and a
second sampling can never give other ranges to a part of the plan. The block
table is broadcast only after its bytes are checked. Grouping a run needs
groupable columns: a split of a table with map columns is refused, the plain
plan takes them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navspark.plans.materialize import broadcast_if_small, materialize

# Keys with more rows than this are split.
HOT_ROWS = 2_000_000
# Target head rows per block of a split key (each block is one window partition).
BLOCK_ROWS = 500_000
# Copies are regenerated in pieces of at most this many rows.
CHUNK_ROWS = 1_000_000
# Up to this many blocks each is a sampled range of its own. More blocks share
# ranges, of RANGE_ROWS rows once that takes more ranges than FEW_RANGES.
FEW_RANGES = 256
RANGE_ROWS = 1_000_000
# Ranges of a split at most: beyond RANGE_ROWS times as many rows the ranges
# grow (cutting a larger range sorts and spills, it holds no range).
MAX_RANGES = 20_000

# compute(frame, parts, order) adds columns using windows partitioned by
# ``parts`` (or finer) and ordered by ``order`` (sort expressions, the
# sequence order); row frames must end at the current row and reach back at
# most ``halo`` rows.
Compute = Callable[[DataFrame, list[str], list[Column]], DataFrame]


def row_hash(cols: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in cols])


def _order_columns(*extra: str) -> list[Column]:
    return [F.col(c) for c in ("date", "nav", "_rh", *extra)]


def _sequence_order(*extra: str) -> list[Column]:
    return [c.asc_nulls_first() for c in _order_columns(*extra)]


def _on(left: DataFrame, right: DataFrame, pairs) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def _groupable(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _groupable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_groupable(f.dataType) for f in t.fields)
    return not isinstance(t, (T.MapType, T.VariantType))


def _expand(df: DataFrame, cols: Sequence[str], spread: bool) -> DataFrame:
    """Regenerate ``_w`` copies of each row. With ``spread`` the copies are cut
    into chunks that a shuffle spreads over tasks before they are generated."""
    if spread:
        df = (
            df.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_w") / F.lit(CHUNK_ROWS)) - 1)))
            .withColumn("_w", F.least(F.lit(CHUNK_ROWS), F.col("_w") - F.col("_k") * F.lit(CHUNK_ROWS)))
            .repartition("_rh", "_k")
        )
    return df.withColumn("_e", F.explode(F.array_repeat(F.lit(True), F.col("_w").cast("int")))).select(*cols)


def tag(df: DataFrame) -> DataFrame:
    """``df`` with the helper columns the plans use: ``_nd`` (undated), ``_sp``
    (undated rows' NAV, their plain-window group) and ``_rh`` (hash of the
    columns that can be grouped)."""
    undated = F.col("date").isNull()
    hashed = [f.name for f in df.schema.fields if _groupable(f.dataType)]
    return df.withColumns({"_nd": undated, "_sp": F.when(undated, F.col("nav")), "_rh": row_hash(hashed)})


def ranged_heads(rows: DataFrame, cols: Sequence[str], keys: Sequence[str], halo: int, block_rows: int, n_rows: int):
    """Steps 1-3 for dated ``rows`` (tagged by :func:`tag`, about ``n_rows`` of
    them): ``(heads, blocks)``, both stored. A head has its copy number ``_j``,
    its weight ``_w`` and its piece ``_t``; a block (key, ``_t``) has its heads
    ``_c``, emitted rows ``_sw`` and ``_from``, the earlier pieces ``src`` that
    hold heads within ``halo`` before it, with the place ``end`` where they end."""
    b = max(int(block_rows), int(halo) + 1)
    n_blocks = max(1, -(-int(n_rows) // b))
    n = min(MAX_RANGES, n_blocks, max(FEW_RANGES, -(-int(n_rows) // RANGE_ROWS)))
    # A range sampled for one block may hold somewhat more than b heads.
    piece = b if n < n_blocks else 2 * b
    runs = rows.groupBy(*cols, "_rh").agg(F.count(F.lit(1)).alias("_m"))
    last = F.least(F.col("_m"), F.lit(int(halo) + 1)) - 1
    heads = runs.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    heads = heads.withColumn("_w", F.when(F.col("_j") == last, F.col("_m") - last).otherwise(F.lit(1).cast("long")))
    order = [*keys, *_sequence_order("_j")]
    heads = heads.drop("_m").repartitionByRange(n, *order).sortWithinPartitions(*order)
    # The ids count a range's rows, from 2^33 times its number: they ascend in
    # the sequence. A piece is named by the id of its first row.
    heads = heads.withColumn("_t", F.monotonically_increasing_id())
    heads = materialize(heads.withColumn("_t", F.expr(f"_t - _t % {1 << 33} % {piece}")))

    blocks = heads.groupBy(*keys, "_t").agg(F.count(F.lit(1)).alias("_c"), F.sum("_w").alias("_sw"))
    pieces = Window.partitionBy(*keys).orderBy("_t")
    start = F.coalesce(F.sum("_c").over(pieces.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("_s", start)
    blocks = blocks.withColumn(
        "_prev", F.lag(F.struct(F.col("_t").alias("src"), (F.col("_s") + F.col("_c")).alias("end"))).over(pieces)
    )
    # Block q needs p's heads if p ends within halo before q: if the block
    # after p starts there.
    near = Window.partitionBy(*keys).orderBy("_s").rangeBetween(-max(0, int(halo) - 1), 0)
    return heads, materialize(blocks.withColumn("_from", F.collect_list("_prev").over(near)).drop("_prev"))


def _with_halos(heads: DataFrame, blocks: DataFrame, keys: Sequence[str], halo: int) -> DataFrame:
    """``heads`` plus ``_halo`` copies of the heads that later blocks look back
    to. ``_p`` of a block's first row is that row's place in the sequence."""
    own = heads.withColumns({"_halo": F.lit(False), "_p": F.lit(0).cast("long")})
    if halo <= 0:
        return own
    from_end = Window.partitionBy(*keys, "_t").orderBy(*[c.desc_nulls_last() for c in _order_columns("_j")])
    tails = heads.withColumn("_k", F.row_number().over(from_end)).where(F.col("_k") <= int(halo))
    needs = blocks.select(
        *[F.col(k).alias(f"_b_{k}") for k in keys], F.col("_t").alias("_to"), F.inline("_from")
    )
    needs = broadcast_if_small(needs)
    on = _on(tails, needs, [(k, f"_b_{k}") for k in keys]) & (tails["_t"] == needs["src"])
    copies = tails.join(needs, on, "inner").withColumns(
        {"_halo": F.lit(True), "_p": F.col("end") - F.col("_k"), "_t": F.col("_to")}
    )
    return own.unionByName(copies.select(*own.columns))


def split_window(
    rows: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str],
    halo: int,
    compute: Compute,
    block_rows: int,
    n_rows: int,
) -> DataFrame:
    """The split plan for dated ``rows`` (about ``n_rows``, all dated rows of
    the keys to split, tagged by :func:`tag`): ``cols`` + added columns."""
    b = max(int(block_rows), int(halo) + 1)
    loose = [f.name for f in rows.schema.fields if f.name in cols and not _groupable(f.dataType)]
    if loose:
        raise ValueError(f"columns that cannot be grouped (maps): {loose}; drop them or pass split='never'")
    heads, blocks = ranged_heads(rows, cols, keys, halo, b, n_rows)
    # The largest number of rows one block emits once copies are regenerated.
    widest = blocks.agg(F.max("_sw")).first()[0] or 0
    tagged = _with_halos(heads, blocks, keys, halo)
    out = compute(tagged, [*keys, "_t"], _sequence_order("_j")).where(~F.col("_halo"))
    added = [c for c in out.columns if c not in tagged.columns]
    return _expand(out.select(*cols, *added, "_w", "_rh"), [*cols, *added], spread=widest > 4 * b)


def _undated_rows(runs: DataFrame, cols: Sequence[str], added) -> DataFrame:
    """Undated rows (in no sequence) with NULL added columns, from ``runs``
    (``cols``, ``_rh`` and multiplicity ``_m``): copies are regenerated in
    chunks spread by a shuffle, so a large group of undated copies is not
    one task's work."""
    res_cols = [*cols, *[f.name for f in added]]
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in added]
    return _expand(runs.select(*cols, *nulls, F.col("_m").alias("_w"), "_rh"), res_cols, spread=True)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored row counts per key, dated (``_n``) and undated (``_u``): what
    ``split="auto"`` decides by. Pass them to several operators over the same
    rows to count once."""
    return materialize(
        df.groupBy(*keys).agg(F.count("date").alias("_n"), F.count_if(F.col("date").isNull()).alias("_u"))
    )


def sequence_window(
    df: DataFrame,
    keys: Sequence[str],
    halo: int,
    compute: Compute,
    split: str = "auto",
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Apply ``compute`` to every row of ``df``, each key's rows forming one
    sequence. ``split``: ``"auto"`` (one small aggregation counts rows per key;
    only keys over ``hot_rows`` are split), ``"never"`` (plain window) or
    ``"always"`` (every key split; for tests and data known to be skewed).
    Rows with a NULL date are in no sequence: they are kept, with NULL in the
    added columns.
    """
    keys = list(keys)
    if split not in ("auto", "never", "always"):
        raise ValueError(f"split must be auto, never or always, not {split!r}")
    cols = list(df.columns)
    tagged = tag(df)

    def plain(x: DataFrame) -> DataFrame:
        # Undated rows in ``x`` sit in window groups of their own, (key,
        # undated, nav), and get NULL outputs.
        res = compute(x, [*keys, "_nd", "_sp"], _sequence_order())
        added = [c for c in res.columns if c not in x.columns]
        return res.select(*cols, *[F.when(~F.col("_nd"), F.col(c)).alias(c) for c in added])

    if split == "never":
        return plain(tagged)
    dated = tagged.where(~F.col("_nd"))
    if split == "always":
        n_rows, n_undated = df.agg(F.count("date"), F.count_if(F.col("date").isNull())).first()
        out = split_window(dated, cols, keys, halo, compute, block_rows, n_rows)
        return _with_undated(out, tagged, cols) if n_undated else out

    # Unless the caller has them: one aggregation over the input (partial in
    # every task, one row per key). Stored, since both decisions read it.
    counts = key_counts(df, keys) if counts is None else counts
    is_hot = F.col("_n") > F.lit(int(hot_rows))
    n_undated, n_hot, n_rows = counts.agg(
        F.coalesce(F.sum("_u"), F.lit(0)), F.count_if(is_hot), F.sum(F.when(is_hot, F.col("_n")))
    ).first()
    if n_hot == 0:
        out = plain(dated)
    else:
        h = broadcast_if_small(counts.where(is_hot).select(*[F.col(k).alias(f"_h_{k}") for k in keys]))
        on = _on(dated, h, [(k, f"_h_{k}") for k in keys])
        cold = plain(dated.join(h, on, "left_anti"))
        hot = dated.join(h, on, "left_semi")
        out = cold.unionByName(split_window(hot, cols, keys, halo, compute, block_rows, n_rows))
    return _with_undated(out, tagged, cols) if n_undated else out


def _with_undated(out: DataFrame, tagged: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``out`` and the undated rows, which need no window: copies collapse (a
    partial aggregation) and are regenerated in spread chunks."""
    added = [f for f in out.schema.fields if f.name not in cols]
    lost = tagged.where(F.col("_nd"))
    if not all(_groupable(f.dataType) for f in out.schema.fields):
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in added]
        return out.unionByName(lost.select(*cols, *nulls))
    runs = lost.groupBy(*cols, "_rh").agg(F.count(F.lit(1)).alias("_m"))
    return out.unionByName(_undated_rows(runs, cols, added))
