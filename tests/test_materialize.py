"""Stored tables: lineage cut, shuffle files removed, consumed tables deleted."""

import glob
import os

from pyspark.sql import functions as F

from navspark.plans.materialize import SHUFFLE_CLEANUP, Stored, materialize


def shuffle_files(spark):
    roots = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for r in roots for f in glob.glob(os.path.join(r, "**", "shuffle_*"), recursive=True)}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    df = spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count()
    stored = materialize(df)
    assert not {f for f in shuffle_files(spark) - before if f.endswith(".data")}
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting


def test_a_consumed_table_is_deleted(spark):
    rows = [(1, None, [1, None], b"x"), (2, "a", None, None)]
    t = Stored(spark.createDataFrame(rows, "a long, b string, c array<long>, d binary"))
    assert sorted(map(str, t.df.collect())) == sorted(map(str, spark.createDataFrame(rows, t.df.schema).collect()))
    path = t.df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    t.drop()
    assert not os.path.exists(path)
    empty = Stored(spark.createDataFrame([], "a long"))
    assert empty.df.collect() == [] and empty.df.columns == ["a"]
    empty.drop()


def test_a_wide_table_is_a_checkpoint_that_can_be_deleted(spark):
    t = Stored(spark.range(50).selectExpr("id", "sequence(0, id) AS many"), wide=True)
    assert t.df.count() == 50 and os.path.exists(t._path.removeprefix("file:"))
    t.drop()
    assert not os.path.exists(t._path.removeprefix("file:"))
