"""Centroid clustering of 64-component vectors by bit planes.

A vector's components become integers; plane ``b`` packs bit ``b`` of all 64
components (two's complement) into one 64-bit word. With weights ``2**b``, and
minus that for the highest plane, the dot product of two vectors is the sum of
``weight * weight * popcount(plane AND plane)`` over all pairs of their planes,
exact in integers, and so are squared distances. Planes are packed once and
kept in a written table; every round reads only them. Tasks reduce their rows
to one partial sum per centroid, so only centroids reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navspark.llm.blocks import list_values
from navspark.llm.shipping import ship
from navspark.plans.materialize import materialize

COMPONENTS = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
#: Integers saturate here: beyond it a squared distance would not fit 64 bits.
LIMIT = 1 << 27
_BLOCK = 4096
_LONG_MAX = (1 << 63) - 1


def pack(ints: np.ndarray) -> np.ndarray:
    """``(rows, planes)`` words of ``(rows, 64)`` integers; the last plane holds the signs."""
    width = 1 + max(int(x).bit_length() for x in (ints.max(initial=0), -1 - ints.min(initial=0)))
    out = np.empty((len(ints), width), dtype="<u8")
    for b in range(width):
        bits = ((ints >> b) & 1).astype(np.uint8)
        out[:, b] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def weights(width: int) -> np.ndarray:
    """What each of ``width`` planes counts for."""
    w = np.int64(1) << np.arange(width, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products ``(rows of a, rows of b)`` of packed vectors."""
    out = np.zeros((len(b), len(a)), dtype=np.int64)
    columns = np.ascontiguousarray(a.T)
    for wi, plane in zip(weights(a.shape[1]), columns, strict=True):
        part = np.zeros_like(out)
        for wj, other in zip(weights(b.shape[1]), b.T, strict=True):
            part += wj * np.bitwise_count(plane[None, :] & other[:, None]).astype(np.int64)
        out += wi * part
    return out.T


def squares(planes: np.ndarray) -> np.ndarray:
    """Squared norms of packed vectors."""
    out = np.zeros(len(planes), dtype=np.int64)
    w = weights(planes.shape[1])
    for i in range(len(w)):
        out += w[i] * w[i] * np.bitwise_count(planes[:, i]).astype(np.int64)
        for j in range(i):
            out += 2 * w[i] * w[j] * np.bitwise_count(planes[:, i] & planes[:, j]).astype(np.int64)
    return out


def nearest(planes: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(number, squared distance)`` of each row's nearest centroid; ties go to the smaller number."""
    packed = pack(centroids)
    d = norms[:, None] + (centroids * centroids).sum(axis=1)[None, :] - 2 * products(planes, packed)
    at = np.argmin(d, axis=1)
    return at, d[np.arange(len(d)), at]


def cluster_sums(planes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """``(k, 64)`` component sums of each cluster's packed rows, from bit counts."""
    width = planes.shape[1]
    bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(len(planes), -1), axis=1, bitorder="little")
    member = (at[None, :] == np.arange(k)[:, None]).astype(np.float32)
    # Counts stay below a block's rows, so 32-bit floats hold them exactly.
    counts = (member @ bits.astype(np.float32)).astype(np.int64).reshape(k, width, COMPONENTS)
    return (counts * weights(width)[None, :, None]).sum(axis=1)


def _unpacked(planes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(len(planes), -1), axis=1, bitorder="little")
    bits = bits.reshape(len(planes), planes.shape[1], COMPONENTS).astype(np.int64)
    return (bits * weights(planes.shape[1])[None, :, None]).sum(axis=1)


def _rows(column: pa.Array) -> np.ndarray:
    """Planes of a list column; narrower rows are widened by repeating their sign plane."""
    values, offsets = list_values(column)
    lengths = np.diff(offsets)
    at = offsets[:-1, None] + np.minimum(np.arange(lengths.max())[None, :], lengths[:, None] - 1)
    return values[at].view("<u8")


def packed_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, planes, norm)`` of the vectors with 64 finite components; others are left out.

    Components become ``floor(1024 * x)``, saturated at +-2**27.
    """
    ship(vectors.sparkSession)
    id_type = vectors.schema[id_col].dataType.simpleString()
    inf = F.lit(float("inf")).cast("double")
    sound = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        (F.size("v") == COMPONENTS)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (x < inf) & (x > -inf))
    )

    def planes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values, _ = list_values(batch.column(1))
            ints = np.clip(np.floor(values.reshape(-1, COMPONENTS) * SCALE), -LIMIT, LIMIT).astype(np.int64)
            p = pack(ints)
            offsets = pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(p.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(squares(p))], names=["id", "planes", "norm"])

    return sound.mapInArrow(planes, f"id {id_type}, planes array<bigint>, norm bigint")


def first_centroids(packed: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of ``seed:id``, equal hashes by their planes."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = packed.select(F.sha2(name, 256).alias("h"), "planes").orderBy("h", "planes").limit(k).collect()
    return np.array(
        [_unpacked(np.array([r["planes"]], dtype=np.int64).view("<u8"))[0] for r in rows], dtype=np.int64
    ).reshape(-1, COMPONENTS)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    """``(ids, planes, cluster, distance)`` of bounded blocks."""
    for batch in batches:
        for a in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(a, _BLOCK)
            planes = _rows(part.column("planes"))
            yield part.column("id"), planes, *nearest(planes, part.column("norm").to_numpy(), centroids)


def _cluster_totals(packed: DataFrame, centroids: np.ndarray) -> list[tuple[int, list[int], int]]:
    """Of each centroid: how many vectors are nearest to it, their component sums and their distances' sum."""
    k = len(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, COMPONENTS), np.int64)
        spread = [0] * k
        for _, planes, at, distance in _assigned(batches, centroids):
            n += np.bincount(at, minlength=k)
            sums += cluster_sums(planes, at, k)
            for c in np.unique(at):
                # Halves, so that the sum of a block cannot overflow.
                d = distance[at == c]
                spread[c] += (int((d >> 32).sum()) << 32) + int((d & 0xFFFFFFFF).sum())
        data = {"cluster": pa.array(np.arange(k, dtype=np.int32)), "n": pa.array(n)}
        data |= {f"c{i}": pa.array(sums[:, i]) for i in range(COMPONENTS)}
        data["spread_high"] = pa.array([s >> 32 for s in spread], pa.int64())
        data["spread_low"] = pa.array([s & 0xFFFFFFFF for s in spread], pa.int64())
        yield pa.RecordBatch.from_pydict(data)

    names = ["n", *[f"c{i}" for i in range(COMPONENTS)], "spread_high", "spread_low"]
    partials = packed.mapInArrow(partial, "cluster int, " + ", ".join(f"{c} bigint" for c in names))
    exact = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in names]
    totals = {r["cluster"]: r for r in partials.groupBy("cluster").agg(*exact).collect()}
    return [
        (
            int(r["n"]),
            [int(r[f"c{i}"]) for i in range(COMPONENTS)],
            (int(r["spread_high"]) << 32) + int(r["spread_low"]),
        )
        if (r := totals.get(c))
        else (0, [0] * COMPONENTS, 0)
        for c in range(k)
    ]


def fit_centroids(packed: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Centroids after ``rounds`` of assigning and flooring means; an empty cluster keeps its centroid.

    A round that moves no centroid is the last: further ones would repeat it.
    """
    centroids = first_centroids(packed, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        totals = _cluster_totals(packed, centroids)
        moved = np.array([[s // n for s in sums] if n else list(c) for (n, sums, _), c in zip(totals, centroids, strict=True)])
        if (moved == centroids).all():
            break
        centroids = moved.astype(np.int64)
    return centroids


def assign(packed: DataFrame, centroids: np.ndarray, more: Callable[[np.ndarray], dict] = lambda at: {}, schema: str = "") -> DataFrame:
    """``(id, cluster, distance)`` of packed vectors, and columns that ``more`` makes of the clusters."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, at, distance in _assigned(batches, centroids):
            yield pa.RecordBatch.from_pydict(
                {"id": ids, "cluster": pa.array(at.astype(np.int32)), "distance": pa.array(distance)} | more(at)
            )

    return packed.mapInArrow(out, f"id {packed.schema['id'].dataType.simpleString()}, cluster int, distance bigint{schema}")


def plane_clusters(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of the vectors kept.

    Kept are vectors of exactly 64 components, none null or non-finite; others,
    null vectors included, have no row. Every kept row counts, also repeated
    ones and rows without an id (hashed as an empty one); equal distances go to
    the smaller centroid. Fewer than eight vectors make fewer centroids, an
    empty table an empty result; other columns are ignored. Inertias that no
    64-bit integer holds are null. Vectors of any other length cost nothing
    beyond the filter.
    """
    packed = materialize(packed_vectors(vectors, id_col, vec_col))
    centroids = fit_centroids(packed)
    spread = [s for _, _, s in _cluster_totals(packed, centroids)] if len(centroids) else []
    fits = [s if s <= _LONG_MAX else None for s in [*spread, sum(spread)]]
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]

    def more(at: np.ndarray) -> dict:
        return {
            "cluster_inertia": pa.array([fits[c] for c in at], pa.int64()),
            "inertia": pa.array([fits[-1]] * len(at), pa.int64()),
            "centroid_sha256": pa.array([digests[c] for c in at], pa.string()),
        }

    found = assign(packed, centroids, more, ", cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.withColumnRenamed("id", id_col)


def clusters_sql(k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """DuckDB SQL of the registered result: all distances, component by component, round by round."""
    parts = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = {COMPONENTS}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), e) - 1 AS INTEGER) AS k, e FROM v QUALIFY k < {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v.e) AS e, min(struct_pack(d := list_sum(list_transform(
    generate_series(1, {COMPONENTS}), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))), k := c.k)) AS near
  FROM v CROSS JOIN c{i} c GROUP BY r)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM (
      SELECT k, i, sum(x) AS s, count(*) AS n
      FROM (SELECT near.k AS k, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM a{i}) GROUP BY k, i)
    GROUP BY k) m ON m.k = c.k)""")
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT vec_id, near.k AS cluster, CAST(near.d AS BIGINT) AS distance,
       CAST(sum(near.d) OVER (PARTITION BY near.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(near.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.k = near.k"""
    )
