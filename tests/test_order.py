"""The integer that sorts as (date, NAV) does."""

import datetime as dt
import math
import random
import struct

from pyspark.sql import functions as F

from navspark.functions.exprs import dated_order, double_order


def bits(x: float) -> int:
    if math.isnan(x):
        return (2047 << 52) + 1
    n = struct.unpack("<Q", struct.pack("<d", abs(x)))[0]
    return -n if x < 0 else n


def test_every_double_has_its_place(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, 1.7976931348623157e308, 2.225073858507201e-308]
    for k in range(-1074, 1024):
        x = math.ldexp(1.0, k)
        values += [x, -x, math.nextafter(x, math.inf), math.nextafter(x, 0.0)]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    wrong = [(r.x, r.o) for r in df.select("x", double_order("x").alias("o")).collect() if r.o != bits(r.x)]
    assert not wrong
    assert spark.createDataFrame([(None,)], "x double").select(double_order("x")).first()[0] is None


def test_dated_order_sorts_as_the_pair(spark):
    rng = random.Random(2)
    days = [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(9999, 12, 31)]
    navs = [None, -math.inf, -2.5, -0.5, 0.0, 5e-324, 1.0, math.nextafter(1.0, 2.0), 1e300, math.inf, math.nan]
    pairs = [(d, v) for d in days for v in navs]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs, "date date, nav double").withColumn("o", dated_order("date", "nav"))
    by_pair = [str(r[:2]) for r in df.orderBy("date", F.col("nav").asc_nulls_first()).collect()]
    ordered = df.orderBy("o").collect()
    assert [str(r[:2]) for r in ordered] == by_pair and len({r["o"] for r in ordered}) == len(pairs)
    assert spark.createDataFrame([(None, 1.0)], "date date, nav double").select(dated_order("date", "nav")).first()[0] is None
