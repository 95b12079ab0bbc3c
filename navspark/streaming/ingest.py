"""Streaming NAV ingest.

The batch ingest (:func:`navspark.sources.payload.read_nav`) re-reads every
landed document. When payloads keep landing under
``<root>/scheme_code=<code>/``, the same parsing runs as a Structured
Streaming query that only picks up new files: the file source records which
files it has processed in the checkpoint, so a restarted or failed query
resumes without re-ingesting or losing documents, and the parquet sink
commits each micro-batch atomically (exactly-once output).

No state is kept between micro-batches: ingest is a per-document map.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from navspark.schemas import NAV_COLUMNS, PAYLOAD_SCHEMA
from navspark.sources.payload import nav_from_payloads


def nav_stream(
    spark: SparkSession, root: str, max_files_per_trigger: int | None = None, multiline: bool = True
) -> DataFrame:
    """Streaming DataFrame of NAV rows from newly landed payload documents
    (with ``multiline=False`` every line of a file is a document)."""
    reader = spark.readStream.schema(PAYLOAD_SCHEMA).option("multiLine", multiline)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return nav_from_payloads(reader.json(root)).select(*NAV_COLUMNS)


def start_nav_ingest(
    spark: SparkSession,
    root: str,
    out: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    multiline: bool = True,
) -> StreamingQuery:
    """Append new NAV rows to the parquet table at ``out`` (partitioned by
    ``year``). ``checkpoint`` defaults to a folder of this root and output
    under the session's ``spark.checkpoint.dir``. With ``available_now`` the query processes what
    has landed and stops; otherwise it keeps running."""
    if checkpoint is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise ValueError("pass checkpoint= or set spark.checkpoint.dir")
        # One folder per pair of input and output: a checkpoint records what
        # one query has read and written, and must never serve another.
        pair = hashlib.sha256(f"{root.rstrip('/')}\n{out.rstrip('/')}".encode()).hexdigest()[:32]
        checkpoint = f"{base.rstrip('/')}/nav_ingest/{pair}"
    w = (
        nav_stream(spark, root, multiline=multiline)
        .withColumn("year", F.year("date"))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy("year")
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
