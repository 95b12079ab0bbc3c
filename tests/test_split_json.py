"""Large landed documents read by many tasks, rejects, and folder look-ups."""

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

import navspark.sources.payload as payload
from navspark.sources.catalogue import read_schemes
from navspark.sources.payload import read_nav, read_payloads, read_points, rejected_payloads

ODD_TEXTS = ["a } b", "} { }", '"}', '\\"},{', 'x"}]}', '},{"date":"01-01-2024","nav":"9"}', "\\\\", '"data":[{', "é}", "{"]


def document(n, odd=0.0, meta=True, tail=True, seed=1, **dump):
    rng = random.Random(seed)
    points = []
    for i in range(n):
        p = {"date": f"{i % 28 + 1:02d}-01-2024", "nav": str(i / 7)}
        if rng.random() < odd:
            note = {"note": rng.choice(ODD_TEXTS)}
            p = {**note, **p} if rng.random() < 0.5 else {**p, **note}
        points.append(p)
    doc = {"meta": {"fund_house": 'A } " { B', "code": 12, "scale": -1.5e-3, "open": True}} if meta else {}
    doc["data"] = points
    if tail:
        doc["status"] = "SUC}CESS"
    return json.dumps(doc, **{"separators": (",", ":"), "ensure_ascii": False} | dump)


def land(root, code, body, name="a.json"):
    folder = os.path.join(root, f"scheme_code={code}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "wb") as f:
        f.write(body if isinstance(body, bytes) else body.encode())


def points(df):
    return sorted(map(str, df.select("scheme_code", "p.date", "p.nav").collect()))


def whole(spark, root, codes=None):
    return points(read_payloads(spark, root, codes).select("scheme_code", F.explode("data").alias("p")))


@pytest.fixture()
def small_splits(spark):
    # Splits of a few points each; file systems' open cost must not widen them.
    keys = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def test_one_document_is_read_by_many_tasks(spark, tmp_path, small_splits):
    land(tmp_path, "000123", document(400, odd=0.1))
    got = read_points(spark, str(tmp_path))
    assert points(got) == whole(spark, str(tmp_path)) and got.count() == 400
    tasks = got.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks > 20
    ordinary = read_payloads(spark, str(tmp_path)).select(F.explode("data"), F.spark_partition_id().alias("t"))
    assert ordinary.select("t").distinct().count() == 1


def test_every_form_of_document_equals_the_whole_reader(spark, tmp_path, small_splits):
    docs = {
        "plain": document(90),
        "odd": document(60, odd=0.5),
        "all odd": document(40, odd=1.0),
        "bare": document(30, meta=False, tail=False),
        "indented": document(30, odd=0.3, indent=1, separators=None),
        "newline": document(30) + "\n",
        "one": document(1),
        "none": document(0),
        "no data": '{"status": "x"}',
        "null data": '{"data": null}',
        "numbers": '{"data":[{"date":"01-01-2024","nav":5},{"date":null,"nav":12.25},{}]}',
        # Irregular: read whole.
        "nested": document(20).replace('"nav"', '"x":{"a":1},"nav"'),
        "nulls": '{"data":[null,{"date":"01-01-2024","nav":"5"}]}',
        "two arrays": '{"other":[{"date":"1"},{"date":"2"}],"data":[{"date":"01-01-2024","nav":"1"}]}',
        "array of documents": '[{"data":[{"date":"01-01-2024","nav":"1"}]},{"data":[{"date":"02-01-2024"}]}]',
        "two documents": document(5) + document(3),
        "truncated": document(50)[:-400],
        "no end": document(20, odd=0.5)[:-1],
        "no comma": '{"data":[{"date":"01-01-2024","nav":"1"} {"date":"02-01-2024","nav":"2"}]}',
        "no colon": '{"data":[{"date" "01-01-2024"},{"nav":"2"}]}',
        "trailing comma": '{"data":[{"date":"01-01-2024","nav":"1"},]}',
        "text": "nonsense } { ] [",
        "text data": '{"data":"x"}',
        "empty": "",
        "blank": " \n",
    }
    for name, body in docs.items():
        land(tmp_path, name, body)
    land(tmp_path, "packed", gzip.compress(document(30, odd=0.3).encode()), "z.json.gz")
    land(tmp_path, "plain", document(20, seed=3), "b [1] {x}.json")
    got, expected = points(read_points(spark, str(tmp_path))), whole(spark, str(tmp_path))
    assert got == expected and len(got) > 300
    some = ["odd", "plain", "404", "truncated"]
    assert points(read_points(spark, str(tmp_path), some)) == whole(spark, str(tmp_path), some)
    assert read_points(spark, str(tmp_path), ["404"]).count() == 0

    def nav(**kw):
        return sorted(map(str, read_nav(spark, str(tmp_path), start="02-01-2024", **kw).collect()))

    assert nav(split_documents=True) == nav()


@pytest.mark.parametrize("size", ["37", "38", "53", "64"])
def test_any_split_point(spark, tmp_path, small_splits, size):
    # Splits shorter than a point, at many places of strings and braces.
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    land(tmp_path, "1", document(25, odd=0.6, seed=int(size)))
    assert points(read_points(spark, str(tmp_path))) == whole(spark, str(tmp_path))


def test_catalogue_split(spark, tmp_path, small_splits):
    rows = [{"schemeCode": i, "schemeName": f"Fund }} {i} \"{{", "schemeType": None if i % 3 else "x"} for i in range(120)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text(json.dumps(rows[:3], indent=2) + "\n")
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text(json.dumps(rows[0]))
    (tmp_path / "e.json").write_text(json.dumps(rows)[:-30])
    got, expected = (
        sorted(map(str, read_schemes(spark, str(tmp_path), split_documents=s).where("schemeCode IS NOT NULL").collect()))
        for s in (True, False)
    )
    assert got == expected and len(got) >= 124


def test_rejected_documents_are_named(spark, tmp_path):
    good = {"ok": document(3), "no data": '{"status": 1}', "empty data": '{"data": []}', "a+b %c": document(2)}
    bad = {"cut": document(9)[:-30], "text": "nonsense", "type": '{"data": "x"}', "blank": "  \n", "x+y %z": ""}
    for code, body in {**good, **bad}.items():
        land(tmp_path, code.replace("%", "%25"), body)
    before = sorted(map(str, read_nav(spark, str(tmp_path), codes=list(good)).collect()))
    rejects = rejected_payloads(spark, str(tmp_path)).collect()
    assert {r["scheme_code"]: r["payload"] for r in rejects} == bad | {"blank": ""} and len(rejects) == len(bad)
    assert all(r["path"].endswith("a.json") for r in rejects)
    assert sorted(map(str, read_nav(spark, str(tmp_path)).collect())) == before
    assert rejected_payloads(spark, str(tmp_path), ["ok", "404"]).count() == 0
    assert [r["scheme_code"] for r in rejected_payloads(spark, str(tmp_path), ["cut", "ok"]).collect()] == ["cut"]
    assert rejected_payloads(spark, str(tmp_path), ["404"]).count() == 0


def test_rejected_lines(spark, tmp_path):
    land(tmp_path, "1", document(1) + "\n" + document(1)[:-5] + "\n")
    rejects = rejected_payloads(spark, str(tmp_path), multiline=False).collect()
    assert [r["payload"] for r in rejects] == [document(1)[:-5]]


def test_many_codes_cost_few_store_calls(spark, tmp_path, monkeypatch):
    for k in (1, 5_000, 9_999):
        land(tmp_path, str(k), document(2))
    odd = ["a,b", "a{b", "c*d", "e[f]", "g h"]
    for code in odd:
        escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(code)
        land(tmp_path, escaped, document(1))
    calls = []
    for name in ("_exists", "_folder_names"):
        real = getattr(payload, name)
        monkeypatch.setattr(payload, name, lambda *a, real=real, name=name: (calls.append(name), real(*a))[1])
    codes = [*map(str, range(10_000)), *odd]
    folders = payload.scheme_folders(spark, str(tmp_path), codes)
    assert calls == ["_folder_names"] and len(folders) <= 1 + len(odd)
    docs = read_payloads(spark, str(tmp_path), codes)
    assert sorted(r["scheme_code"] for r in docs.collect()) == sorted(["1", "5000", "9999", *odd])
    calls.clear()
    assert len(payload.scheme_folders(spark, str(tmp_path), ["1", "2", "g h"])) == 2 and len(calls) == 3
    assert payload.scheme_folders(spark, str(tmp_path / "absent"), codes) == []
