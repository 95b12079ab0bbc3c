"""op2 and op10: against DuckDB, and edge cases."""

import base64
import hashlib
import math
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from navspark.llm import mixing, warc
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare


def test_against_sql(spark):
    got = compare(spark, SF_SMALL, ["op2_mix", "op10_warc"], verbose=False)
    assert all(r["ok"] for r in got.values()), got


def test_poisson_inversion(spark):
    means = [0.0, 0.3, 1.0, 7.5, 390.0]
    got = spark.createDataFrame([(m,) for m in means], "m double").select("m", mixing.poisson_cdf(F.col("m")).alias("c")).collect()
    for r in got:
        want = 0.0
        for k, c in enumerate(r.c):
            want += math.exp(-r.m + (k * math.log(r.m) if r.m else (0 if k == 0 else -math.inf)) - math.lgamma(k + 1))
            assert abs(c - want) < 1e-9


def test_target_weights(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "'t' AS text", "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 100 = 1 THEN NULL ELSE 'b' END AS source", "7 AS copies")
    out = mixing.poisson_mix(docs, {"a": 1.0, "b": 3.0, "absent": 5.0}, total=20_000)
    n = Counter(r.source for r in out.select("source").collect())
    assert abs(n["a"] - 5_000) < 400 and abs(n["b"] - 15_000) < 600 and n[None] == 0
    again = mixing.poisson_mix(docs.repartition(7), {"a": 1.0, "b": 3.0}, total=20_000)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_large_means_and_salted_join(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x", "rare")] + [(i, "y", None) for i in range(2, 40)], "doc_id long, text string, source string")
    out = mixing.poisson_mix(docs, {"rare": 1.0}, total=3_000)
    assert abs(out.count() - 3_000) < 350
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, mixing.poisson_mix(docs, {"rare": 1.0}, total=3_000).collect())) == sorted(map(tuple, out.collect()))


def test_mix_edges(spark):
    rows = [(1, None, None), (1, None, None), (None, "t", "a"), (None, "u", "a"), (2, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.poisson_mix(docs, total=400).collect()
    assert {r.doc_id for r in out} == {1, 2, None}
    by = Counter(r.doc_id for r in out)
    assert by[1] % 2 == 0
    assert mixing.poisson_mix(docs.limit(0)).count() == 0


PAGES = [
    (1, "http://a", "same"),
    (2, "http://b\r\nX: y", "same"),
    (3, None, None),
    (4, "http://c", ""),
    (5, "http://d", "line\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n é😀"),
    (5, "http://d", "other"),
    (2, "http://b", "same"),
    (None, "http://e", "only here"),
    (None, "http://f", "same"),
    (6, "http://g", "z" * 300_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS sha1")


def test_records(pages, tmp_path):
    got = warc.archive_digest(pages, str(tmp_path / "a")).collect()
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    top = {}
    for i, _, h in PAGES:
        top[h or ""] = max((x for x in (top.get(h or ""), i) if x is not None), default=None)
    want = sorted(
        (str(i), len((h or "").encode()), sha(h), "response" if i == top[h or ""] else "revisit", str(None if i == top[h or ""] else top[h or ""]))
        for i, _, h in PAGES
    )
    assert sorted((str(r[0]), r[1], r[2], r[3], str(r[4])) for r in got) == want


def test_minimum_size(pages, tmp_path):
    got = warc.archive_digest(pages, str(tmp_path / "m"), min_bytes=5).collect()
    assert {r.record_type for r in got} == {"response"}


def test_round_trip_and_files(spark, pages, tmp_path):
    path = warc.write_archive(pages, str(tmp_path / "b"))
    payloads = spark.read.parquet(f"{path}/payloads").collect()
    assert len(payloads) == len({h or "" for _, _, h in PAGES})
    back = sorted((str(r.page_id), bytes(r.payload).decode()) for r in warc.read_records(spark, path).collect())
    assert back == sorted((str(i), h or "") for i, _, h in PAGES)
    warc.export_warc(spark, path, str(tmp_path / "out"))
    n, seen = 0, []
    for f in sorted((tmp_path / "out").glob("part-*")):
        data, at = f.read_bytes(), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at) + 4
            head = dict(x.split(": ", 1) for x in data[at:end].decode().split("\r\n")[1:-2])
            size = int(head["Content-Length"])
            block = data[end : end + size]
            if head["WARC-Type"] == "response":
                assert head["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
                seen.append(block.decode())
            assert data[end + size : end + size + 4] == b"\r\n\r\n"
            at = end + size + 4
            n += 1
    assert n == len(PAGES) and set(seen) == {h or "" for _, _, h in PAGES}


def test_corruption_is_found(spark, pages, tmp_path):
    path = warc.write_archive(pages, str(tmp_path / "c"))
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.concat("payload", F.lit("!").cast("binary")))
    bad.write.parquet(f"{tmp_path}/d/payloads")
    with pytest.raises(PySparkException):
        warc.read_payloads(spark, f"{tmp_path}/d").select("payload_sha256").collect()


def test_records_are_rebuilt_from_both_tables(spark, pages, tmp_path):
    path = warc.write_archive(pages, str(tmp_path / "r"))
    rebuilt = warc.original_records(spark, path)
    parsed = warc.parsed_records(rebuilt).collect()
    heads = {r.header for r in spark.read.parquet(f"{path}/headers").collect()}
    assert len(parsed) == len(PAGES) and {r.header for r in parsed} == heads
    full = {r.payload_sha256: bytes(r.payload) for r in spark.read.parquet(f"{path}/payloads").collect()}
    for r in parsed:
        assert bytes(r.block) == (full[r.payload_sha256] if "WARC-Type: response" in r.header else b"")
    with pytest.raises(PySparkException, match="not as long"):
        warc.parsed_records(rebuilt.selectExpr("page_id", "payload_sha256", "concat(value, 'x') AS value")).collect()


def test_empty(pages, tmp_path):
    assert warc.archive_digest(pages.limit(0), str(tmp_path / "e")).count() == 0
