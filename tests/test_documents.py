"""Rendered payload documents stay bounded and round-trip exactly."""

import datetime as dt
import json

from navspark.schemas import NAV_SCHEMA
from navspark.sources.payload import nav_from_payloads, payloads_from_text
from navspark.sources.tables import payload_documents

BASE = dt.date(2020, 1, 1)


def test_documents_bounded_and_round_trip(spark):
    # A hot scheme-month (2000 points), a pile of 500 copies of one point and
    # a single point; documents of at most about 100 points.
    rows = [(BASE + dt.timedelta(days=i % 20), float(i % 37), "h", "H") for i in range(2000)]
    rows += [(BASE, 1.0, "c", "C")] * 500 + [(BASE, 2.0, "x", "X")]
    df = spark.createDataFrame(rows, NAV_SCHEMA)
    docs = payload_documents(df, max_points=100).collect()
    sizes = [len(json.loads(r["value"])["data"]) for r in docs]
    assert sum(sizes) == len(rows)
    assert len(docs) >= 2000 // 100 + 500 // 100 + 1 - 5
    assert max(sizes) <= 4 * 100  # hash-balanced parts: about max_points each
    back = nav_from_payloads(payloads_from_text(payload_documents(df, max_points=100)))
    assert sorted(tuple(r)[:3] for r in back.collect()) == sorted(r[:3] for r in rows)


def test_small_groups_are_one_document(spark):
    rows = [(BASE + dt.timedelta(days=i), float(i), "a", "A") for i in range(10)]
    docs = payload_documents(spark.createDataFrame(rows, NAV_SCHEMA)).collect()
    assert [(r["scheme_code"], r["period"], r["part"]) for r in docs] == [("a", "2020-01", 0)]
