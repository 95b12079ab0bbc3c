"""Materialising intermediate tables that a plan reads several times."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A stored table of at most this many bytes may be sent whole to every executor.
BROADCAST_BYTES = 32 << 20


def checkpoint_dir(df: DataFrame) -> str | None:
    spark = df.sparkSession
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        d = d or spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext (remote session)
        pass
    return d or None


#: Spark's switch for removing a query's shuffle files when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries built inside remove their shuffle files at their end: a stored
    table is read from its files, so nothing asks for the shuffles again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage.

    With a checkpoint folder configured (``spark.checkpoint.dir``, shared
    storage on a cluster) this is a reliable ``checkpoint()``: later readers
    and retries after a lost executor read the written files instead of
    re-running the input scan. Shuffle files that the computation made are
    removed with it. Without a folder (an unconfigured local session) the
    table is persisted to memory and disk; lost blocks are then recomputed from
    lineage, which is still correct.
    """
    d = checkpoint_dir(df)
    if d:
        sc = df.sparkSession.sparkContext
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        with shuffles_removed(df.sparkSession):
            return df.select("*").checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


class Stored:
    """A table written to the checkpoint folder, with :meth:`drop` for when it is consumed.

    For loops whose every round makes a table that the next one consumes. The
    files are ordinary parquet, so Spark knows their size; a table of long
    arrays or texts (``wide``) is a checkpoint instead, which is written row by
    row and not gathered in the memory of a column writer.
    """

    def __init__(self, df: DataFrame, wide: bool = False) -> None:
        self._spark, self._schema = df.sparkSession, df.schema
        folder = checkpoint_dir(df)
        self._plain = materialize(df) if wide or not folder else None
        self._path = None
        if self._plain is None:
            self._path = f"{folder.rstrip('/')}/table-{uuid.uuid4().hex}"
            with shuffles_removed(self._spark):
                df.select("*").write.parquet(self._path)
        elif folder:
            file = self._plain._jdf.logicalPlan().rdd().getCheckpointFile()
            self._path = file.get() if file.isDefined() else None

    @property
    def df(self) -> DataFrame:
        if self._plain is not None:
            return self._plain
        return self._spark.read.schema(self._schema).parquet(self._path)

    def drop(self) -> None:
        if self._path is None:
            self._plain.unpersist()
            return
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._path)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)


def table_bytes(df: DataFrame) -> int:
    """Bytes of a stored table's values (one small job): text and arrays by
    their lengths, every other value as 16 bytes."""

    def width(f: T.StructField):
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + F.lit(16)
        if isinstance(f.dataType, T.ArrayType):
            return F.greatest(F.size(F.col(f.name)), F.lit(0)) * F.lit(8) + F.lit(16)
        return F.lit(16)

    row = sum((width(f) for f in df.schema.fields), F.lit(0))
    return int(df.agg(F.sum(row.cast("long"))).first()[0] or 0)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, a stored table, with a broadcast hint if its bytes are proven
    to be at most ``limit``; otherwise unchanged, and Spark plans a shuffle."""
    return F.broadcast(df) if table_bytes(df) <= limit else df
