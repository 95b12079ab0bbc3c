"""Every registered query equals its SQL form on DuckDB (sf0.001 tables)."""

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare


def test_every_query_has_an_oracle():
    assert set(E.core_queries()) == set(E.core_oracle_sql())


def test_queries_match_oracle(spark):
    res = compare(spark, SF_SMALL, verbose=False)
    bad = {k: v for k, v in res.items() if not v.get("ok")}
    assert not bad, bad


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["scheme_name", "scheme_code"]
