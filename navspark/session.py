"""Session helpers for tests, the benchmark and local runs.

Library operators never build or stop a session; a cluster job passes its
own. These helpers only fill in settings that are not already set.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.driver.memory": "8g",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "navspark") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset is a folder of our own set: ``fallback``, or in a
    local session (tests) a fresh temporary folder on this machine. On a
    cluster executors would not share that one, so there it is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not fallback and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = fallback or tempfile.mkdtemp(prefix="navspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path
