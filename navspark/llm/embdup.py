"""Embedding near-duplicates with an inverted multi-index.

Vectors are scaled to length one and split in half; each half has its own
codebook (k-means over a bounded sample), and a pair of centroids is a cell of
the product grid. Every vector is indexed in its nearest cell. As a query it
visits cells in multi-sequence order, nearest first, and stops when no further
cell can hold a vector within reach: a cell's distance is bounded below by the
distances to the bisectors between the query's nearest centroids and the
cell's. At the default target recall of 1 the visited cells hold every vector
at or above the threshold. What is visited is then verified by cosine in
double precision.

Equal vectors are indexed once with their number. Cells are cut into tiles of
bounded size, so a hot cell is spread over tasks; a task returns each query's
number of links and a spanning forest, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.blocks import consecutive_groups, list_values
from navspark.llm.components import connected_components
from navspark.llm.features import below
from navspark.llm.shipping import ship
from navspark.plans.materialize import materialize

COSINE = 0.98
#: Expected vectors the codebooks are fitted on.
CODEBOOK_SAMPLE = 20_000
TILE = 2_048
#: Vectors of one label per cell the codebook size aims at, and its bounds. A visit
#: moves one embedding, which costs as much as some thousand comparisons; finer cells
#: compare less and move more (a vector of 64 unclustered components visits half of
#: 5 x 5 cells and a tenth of 40 x 40). A cell of one tile balances the two.
PER_CELL = TILE
CENTROIDS = (2, 256)
ITERATIONS = 8
_CHUNK = 512


@dataclass
class MultiIndex:
    books: tuple[np.ndarray, np.ndarray]  # centroids of either half
    width: int  # padded dimension
    reach: float  # squared distance within which cells are visited


def kmeans(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows of the (hash-ordered) sample."""
    c = np.unique(x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)], axis=0)
    for _ in range(ITERATIONS):
        at = np.argmin((c**2).sum(1) - 2 * (x @ c.T), axis=1)
        n = np.bincount(at, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def unit_rows(values: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros, scaled to length one."""
    x = np.zeros((len(offsets) - 1, width))
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x[rows, :size] = values[offsets[rows][:, None] + np.arange(size)]
    # Scaling by the largest component first keeps tiny and huge vectors apart from 0 and infinity.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def visited_cells(half: list[np.ndarray], books: tuple[np.ndarray, np.ndarray], reach: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each row's own cell and the cells it visits, nearest first.

    For a half at distance d from a centroid and d0 from its nearest one, any
    vector of that centroid's cell is at least (d^2 - d0^2) / 2|c - c0| away.
    """
    bounds, nearest = [], []
    for x, c in zip(half, books, strict=True):
        d2 = np.maximum((x**2).sum(1)[:, None] + (c**2).sum(1) - 2 * (x @ c.T), 0)
        best = np.argmin(d2, axis=1)
        apart = np.linalg.norm(c[best][:, None, :] - c[None, :, :], axis=2)
        gap = d2 - d2[np.arange(len(x)), best][:, None]
        bounds.append((np.where(apart > 0, gap / np.where(apart > 0, 2 * apart, 1), 0)) ** 2)
        nearest.append(best)
    k = len(books[1])
    cells = []
    for b0, b1 in zip(*bounds, strict=True):
        o0, o1 = np.argsort(b0, kind="stable"), np.argsort(b1, kind="stable")
        s0, s1 = b0[o0], b1[o1]
        o0 = o0[s0 <= reach]
        ends = np.searchsorted(s1, reach - s0[: len(o0)], side="right")  # the staircase of the two sequences
        i = np.repeat(np.arange(len(o0)), ends)
        j = np.arange(len(i)) - np.repeat(np.cumsum(ends) - ends, ends)
        order = np.argsort(s0[i] + s1[j], kind="stable")
        cells.append(o0[i[order]] * k + o1[j[order]])
    return nearest[0] * k + nearest[1], cells


def fit_index(classes: DataFrame, n: int, labels: int, width: int, threshold: float, target_recall: float) -> MultiIndex:
    """Codebooks of a hash-chosen sample; ``n`` vectors with ``labels`` labels are to be indexed."""
    rate = min(1.0, CODEBOOK_SAMPLE / max(n, 1))
    got = classes.where(below(rate, F.xxhash64(F.lit(5), "cid").bitwiseAND(F.lit((1 << 62) - 1)))).select("cid", "embedding").collect()
    got.sort(key=lambda r: r["cid"])
    lengths = np.array([len(r["embedding"]) for r in got], dtype=np.int64)
    values = np.concatenate([np.asarray(r["embedding"], dtype=np.float64) for r in got]) if got else np.zeros(0)
    x = unit_rows(values, np.concatenate(([0], np.cumsum(lengths))), width) if got else np.zeros((1, width))
    k = int(min(max(math.ceil(math.sqrt(n / (PER_CELL * max(labels, 1)))), CENTROIDS[0]), CENTROIDS[1]))
    cut = width // 2
    books = (kmeans(x[:, :cut], k) if cut else np.zeros((1, 0)), kmeans(x[:, cut:], k))
    return MultiIndex(books, width, (2 - 2 * threshold) * target_recall + 1e-9)


def index_entries(classes: DataFrame, index: MultiIndex) -> DataFrame:
    """``(cid, own, cells)``: a vector's own cell and the cells it visits as a query.

    Of two cells that may hold linked vectors only the lower one's vectors
    visit the other: each pair meets once.
    """
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cut = m.width // 2
        for batch in batches:
            for a in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(a, _CHUNK)
                values, offsets = list_values(part.column(1))
                x = unit_rows(values.astype(np.float64), offsets, m.width)
                own, cells = visited_cells([x[:, :cut], x[:, cut:]], m.books, m.reach)
                cells = [c[c >= o] for c, o in zip(cells, own, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(own, pa.int64()), pa.array(cells, pa.list_(pa.int64()))],
                    names=["cid", "own", "cells"],
                )

    return classes.select("cid", "embedding").mapInArrow(run, "cid bigint, own bigint, cells array<bigint>")


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in consecutive_groups(batches, "tile"):
            query = tile.column("query").to_numpy(zero_copy_only=False).astype(bool)
            if query.all() or not query.any():
                continue
            cid = tile.column("cid").to_numpy()
            copies = tile.column("copies").to_numpy()
            values, offsets = list_values(tile.column("embedding"))
            x = unit_rows(values.astype(np.float64), offsets, int(np.diff(offsets).max()))
            q, m = np.flatnonzero(query), np.flatnonzero(~query)
            home = tile.column("home").to_numpy(zero_copy_only=False).astype(bool)[q]
            link = (x[q] @ x[m].T >= threshold) & (~home[:, None] | (cid[q][:, None] < cid[m][None, :]))
            if not link.any():
                continue
            # A forest: every vector points at the smallest label its links reach.
            lq, lm = cid[q].copy(), cid[m].copy()
            top = np.iinfo(np.int64).max
            while True:
                nq = np.minimum(lq, np.where(link, lm[None, :], top).min(axis=1))
                nm = np.minimum(lm, np.where(link, nq[:, None], top).min(axis=0))
                if (nq == lq).all() and (nm == lm).all():
                    break
                lq, lm = nq, nm
            rq, rm = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
            found = np.concatenate((link[rq] @ copies[m], link[:, rm].T @ copies[q]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((cid[q][rq], cid[m][rm]))),
                    pa.array(found.astype(np.int64)),
                    pa.array(np.concatenate((lq[rq], lm[rm]))),
                ],
                names=["cid", "n", "label"],
            )

    return run


def _valid(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def near_vectors(
    vectors: DataFrame,
    threshold: float = COSINE,
    target_recall: float = 1.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Vectors of one label and one length link at a cosine of ``threshold`` or
    more. Null, empty, zero and non-finite vectors, null labels and null ids
    link with nothing (a null id: component null, kept). Repeated rows are
    vectors of their own that link with each other; ``kept`` then holds for
    every row with the component's id. Links have no direction, so equal
    cosines are no ties. Other columns are ignored, so their names cannot
    clash. Empty in, empty out.
    """
    spark = vectors.sparkSession
    ship(spark)
    base = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("embedding"), F.col(label_col).alias("label")
    )
    good = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & _valid(F.col("embedding"))
    # Rows find their class by 128 bits; within the index a class is a number.
    key = [F.xxhash64("label", "embedding", F.size("embedding")), F.xxhash64(F.lit(1), F.size("embedding"), "embedding", "label")]
    base = base.withColumns({"k1": F.when(good, key[0]), "k2": F.when(good, key[1])})
    classes = materialize(
        base.where("k1 IS NOT NULL")
        .groupBy("k1", "k2", "label", "embedding")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    )
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()))
    size = classes.agg(F.count("*"), F.countDistinct("label"), F.max(F.size("embedding"))).first()
    index = fit_index(classes, size[0], size[1], max(int(size[2] or 1), 2), threshold, target_recall)
    entries = materialize(index_entries(classes, index))

    space = [F.col("label"), F.size("embedding")]
    keyed = classes.join(entries, "cid")
    members = keyed.select("cid", F.xxhash64(*space, "own").alias("cell"))
    own_cell = F.xxhash64(*space, "own")
    queries = keyed.select(
        "cid", own_cell.alias("own_cell"), F.explode(F.transform("cells", lambda c: F.xxhash64(*space, c))).alias("cell")
    ).select("cid", "cell", (F.col("cell") == F.col("own_cell")).alias("home"))
    blocks = members.groupBy("cell").agg(F.ceil(F.count("*") / TILE).alias("m_blocks"))
    # Cells without members need no visit; what is left is counted for its tiles.
    visits = materialize(queries.join(blocks, "cell"))
    rounds = visits.groupBy("cell").agg(F.ceil(F.count("*") / TILE).alias("q_blocks"))
    upto = lambda c: F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1)
    spread = F.xxhash64(F.lit(9), "cid")
    as_query = visits.join(rounds, "cell").select(
        "cid",
        F.lit(True).alias("query"),
        "home",
        F.explode(F.transform(upto("m_blocks"), lambda b: F.xxhash64("cell", b, F.pmod(spread, F.col("q_blocks"))))).alias("tile"),
    )
    as_member = members.join(blocks, "cell").join(rounds, "cell").select(
        "cid",
        F.lit(False).alias("query"),
        F.lit(False).alias("home"),
        F.explode(F.transform(upto("q_blocks"), lambda b: F.xxhash64("cell", F.pmod(spread, F.col("m_blocks")), b))).alias("tile"),
    )
    rows = as_query.union(as_member).join(classes.select("cid", "copies", "embedding"), "cid")
    found = materialize(
        rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(_verify(threshold), "cid bigint, n bigint, label bigint")
    )

    links = found.groupBy("cid").agg(F.sum("n").alias("others"))
    comps = connected_components(found.select(F.col("cid").alias("u"), F.col("label").alias("v")))
    named = classes.select("cid", "k1", "k2", "copies", "first").join(comps.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    result = named.join(smallest, "component").join(links, "cid", "left")
    r = base.select("vec_id", "k1", "k2").join(result.select("k1", "k2", "copies", "others", "component_id"), ["k1", "k2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return r.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id").isNull() | (F.col("vec_id") == component)).alias("kept"),
    )
