"""Run each registered query on Spark and its SQL form on DuckDB over the same
parquet tables and compare row count, column names/types and values
(order-insensitive). Usable from pytest and as a script::

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(rows, key=_key)


# Spark type -> DuckDB type name, for the schema check.
SPARK_TO_DUCK = {
    "IntegerType()": "INTEGER",
    "LongType()": "BIGINT",
    "DoubleType()": "DOUBLE",
    "StringType()": "VARCHAR",
    "DateType()": "DATE",
    "BooleanType()": "BOOLEAN",
    "TimestampType()": "TIMESTAMP WITH TIME ZONE",
}


def _view(con, sql):
    # A view, as the contract's comparison makes: SQL that needs rows to find its columns fails.
    con.execute(f"CREATE OR REPLACE TEMP VIEW compared AS {sql}")
    return con.sql("SELECT * FROM compared")


def type_diff(df, con, sql) -> dict:
    s = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    rel = _view(con, sql)
    d = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def duck_rows(con, sql):
    rel = _view(con, sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = rel.fetchall()
    rows = [tuple(_norm(r[i]) for i in order) for r in data]
    return [names[i] for i in order], sorted(rows, key=_key)


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(E.core_queries()):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        scols, srows = spark_rows(df)
        t1 = time.time()
        if name not in sqls:
            results[name] = {"rows": len(srows), "oracle": None}
            continue
        dcols, drows = duck_rows(con, sqls[name])
        types = type_diff(df, con, sqls[name])
        ok_cols = scols == dcols and not types
        ok_rows = len(srows) == len(drows)
        diff = [a for a, b in zip(srows, drows) if a != b] if ok_rows else []
        ok = ok_cols and ok_rows and not diff and srows == drows
        results[name] = {
            "ok": ok,
            "rows": len(srows),
            "oracle_rows": len(drows),
            "cols_match": ok_cols,
            "n_diff": len(diff),
            "spark_sec": round(t1 - t0, 2),
        }
        if verbose:
            print(name, results[name], flush=True)
            if not ok_cols:
                print("  spark cols:", scols, "\n  duck cols: ", dcols, "\n  type differences:", types)
            for a in diff[:3]:
                j = srows.index(a)
                print("  spark:", a, "\n  duck: ", drows[j])
    return results


if __name__ == "__main__":
    from navspark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] or None
    spark = local_session(8, 8)
    res = compare(spark, sf, only)
    bad = [k for k, v in res.items() if v.get("ok") is False]
    print("FAILED:" if bad else "ALL OK", bad)
