"""Bit-plane clustering against plain integer arithmetic."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from navspark.llm.planes import LIMIT, cluster_sums, nearest, pack, plane_clusters, products, squares
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(0, 27), st.integers(0, 27))
def test_plane_products_are_exact(seed, a_bits, b_bits):
    rng = np.random.default_rng(seed)
    a = rng.integers(-(1 << a_bits), (1 << a_bits) + 1, (5, 64))
    b = rng.integers(-(1 << b_bits), (1 << b_bits) + 1, (3, 64))
    pa, pb = pack(a), pack(b)
    assert (products(pa, pb) == a @ b.T).all()
    assert (squares(pa) == (a * a).sum(axis=1)).all()
    at, d = nearest(pa, squares(pa), b)
    every = ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)
    assert (at == every.argmin(axis=1)).all() and (d == every.min(axis=1)).all()
    sums = cluster_sums(pa, at, 3)
    assert all((sums[k] == a[at == k].sum(axis=0)).all() for k in range(3))


def plain(rows):
    """The contract in Python integers over ``(vec_id, vector)``."""
    kept = [
        (i, [max(-LIMIT, min(LIMIT, int(np.floor(1024.0 * float(x))))) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)
    ]
    name = lambda r: hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    cents = [list(v) for _, v in sorted(kept, key=name)[:8]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), k) for k, c in enumerate(cents)) for _, v in kept]

    for _ in range(10):
        at = assign()
        for k in range(len(cents)):
            mine = [v for (_, v), (_, j) in zip(kept, at) if j == k]
            if mine:
                cents[k] = [sum(col) // len(mine) for col in zip(*mine)]
    at = assign()
    inertia = [sum(d for d, j in at if j == k) for k in range(len(cents))]
    long = lambda x: x if x < 2**63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(
        ((-1 if i is None else i), k, d, long(inertia[k]), long(sum(inertia)), digest[k]) for (i, _), (d, k) in zip(kept, at)
    )


def got(df):
    return sorted(
        ((-1 if r["vec_id"] is None else r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
        for r in df.collect()
    )


@pytest.fixture(scope="module")
def odd_rows():
    rng = np.random.default_rng(5)
    good = [(i, [float(np.float32(x)) for x in rng.normal(i % 5, 1, 64)]) for i in range(60)]
    return [
        *good,
        good[3],  # a repeated row
        (None, good[4][1]),
        (200, None),
        (201, []),
        (202, [1.0] * 63),
        (203, [1.0] * 65),
        (204, [1.0] * 63 + [None]),
        (205, [1.0] * 63 + [float("nan")]),
        (206, [1.0] * 63 + [float("inf")]),
        (207, [0.0] * 64),
        (208, [1e30, -1e30] * 32),
    ]


SCHEMA = "vec_id long, embedding array<float>"


def test_against_plain_integers(spark, odd_rows):
    for rows in (odd_rows, odd_rows[:60], odd_rows[:5], odd_rows[:1], odd_rows[62:69], []):
        assert got(plane_clusters(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_extra_columns_and_doubles(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", "1 AS id", "'x' AS v", "map('a', 1) AS planes", "2 AS norm", "3 AS cluster", "4 AS h")
    assert got(plane_clusters(df.repartition(7))) == plain(odd_rows)


def test_registered_query_equals_sql(spark):
    assert compare(spark, SF_SMALL, ["op11_clusters"], verbose=False)["op11_clusters"]["ok"]
