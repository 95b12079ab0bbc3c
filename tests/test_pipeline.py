"""End-to-end pipeline over landed files derived from the test tables."""

import json
import os

from pyspark.sql import functions as F

from navspark.plans.pipeline import first_schemes, run_pipeline
from navspark.sources.catalogue import schemes_to_json_lines
from navspark.sources.tables import nav_by_brand, payload_documents, scheme_catalogue
from tests.conftest import SF_SMALL


def land_from_tables(spark, root):
    """Write payload documents (per scheme and month) and one catalogue
    document, in the service's formats, from the sf0.001 tables."""
    docs = payload_documents(nav_by_brand(spark, SF_SMALL))
    for r in docs.collect():
        d = os.path.join(root, "payloads", f"scheme_code={r['scheme_code']}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"{r['period']}-{r['part']}.json"), "w") as f:
            f.write(r["value"])
    cat = [json.loads(r["value"]) for r in schemes_to_json_lines(scheme_catalogue(spark, SF_SMALL)).collect()]
    with open(os.path.join(root, "schemes.json"), "w") as f:
        json.dump(cat, f)


def test_first_schemes_keeps_order():
    assert first_schemes({"b": "1", "a": "2", "c": "3"}, 2) == {"b": "1", "a": "2"}


def test_pipeline_end_to_end(spark, tmp_path):
    root = str(tmp_path)
    land_from_tables(spark, root)
    mapping = {"2": "Two Fund", "17": "Seventeen Fund", "5": "Five Fund", "404": "Missing"}
    res = run_pipeline(
        spark,
        os.path.join(root, "schemes.json"),
        os.path.join(root, "payloads"),
        os.path.join(root, "out"),
        mapping=mapping,
        keyword="red",
        scheme_type="eco",
        start="01-01-1996",
        end="31-12-1997",
        n_schemes=3,
        rolling_rows=20,
    )
    for tier in ("raw/schemes", "raw/search", "raw/nav", "processed/pivoted", "analysis/performance",
                 "analysis/monthly", "analysis/latest"):
        assert os.path.isdir(os.path.join(root, "out", tier)), tier
    nav = res["nav"]
    assert {r[0] for r in nav.select("scheme_name").distinct().collect()} == {"Two Fund", "Seventeen Fund", "Five Fund"}
    assert nav.where((F.col("date") < "1996-01-01") | (F.col("date") > "1997-12-31")).count() == 0
    assert "fetch_timestamp" in nav.columns
    assert res["performance"].count() == 3
    assert res["latest"].count() == 3
    assert res["pivoted"].columns == ["date", "Five Fund", "Seventeen Fund", "Two Fund"]
    assert res["returns"].count() == nav.count() == res["rolling"].count()
    assert res["search"].count() == res["schemes"].where(
        F.lower("schemeName").contains("red") & F.lower("schemeType").contains("eco")
    ).count()
    # The landed round trip reproduces the adapter's NAV for a scheme.
    direct = nav_by_brand(spark, SF_SMALL).where(
        (F.col("scheme_code") == "2") & F.col("date").between("1996-01-01", "1997-12-31")
    )
    got = nav.where(F.col("scheme_code") == "2").select("date", "nav")
    assert sorted(got.collect()) == sorted(direct.select("date", "nav").collect())


def test_defaults_take_everything_in_order(spark, tmp_path):
    root = str(tmp_path)
    land_from_tables(spark, root)
    mapping = {str(i): f"Fund {i}" for i in (9, 2, 17, 5, 12)}
    res = run_pipeline(
        spark, os.path.join(root, "schemes.json"), os.path.join(root, "payloads"), os.path.join(root, "out"), mapping=mapping
    )
    direct = nav_by_brand(spark, SF_SMALL).where(F.col("scheme_code").isin(list(mapping)))
    assert res["nav"].count() == direct.count()
    assert [r.scheme_name for r in res["latest"].coalesce(1).collect()] == sorted(mapping.values())
    months = [(r.scheme_name, r.year, r.month) for r in res["monthly"].coalesce(1).collect()]
    assert sorted(months) == months and len(months) > 100
