"""Corpus preparation as a chain of stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps,
with the columns of ``documents`` (the last one adds its own). :func:`run`
writes every stage's result as Parquet in the shared checkpoint folder and
hands the reread table to the next, so a lost executor costs at most tasks of
one stage.

A document is its id and text: a decision travels by a 128-bit digest of both,
so rows without an id are judged as well, rows that repeat an id with another
text are judged apart and exact copies share a decision. Null and empty texts are
clean and never duplicates, texts of any length are judged whole, an empty table
gives an empty result. Columns beside those of ``documents`` pass through, whatever
their names and types: a stage works on rows packed into one struct.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navspark.llm.decontam import decontaminate
from navspark.llm.mixing import poisson_mix
from navspark.llm.neardup import near_duplicates
from navspark.llm.packing import identity, packed, unpacked
from navspark.llm.pii import redact_documents
from navspark.llm.toxicity import THRESHOLD, fit_toxicity, learn_ids, score_toxicity
from navspark.plans.materialize import broadcast_if_small, materialize
from navspark.session import ensure_checkpoint_dir


def _keyed(docs: DataFrame) -> DataFrame:
    """``uid, id, text, row`` of every document."""
    return docs.select(
        identity("doc_id", "text").alias("uid"), F.col("doc_id").alias("id"), F.col("text"), packed(docs.columns)
    )


def _without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """``rows`` whose ``key`` is none of the one column of ``dropped``.

    The keys are sent to the documents while their size is proven small;
    beyond that keys and documents meet in one shuffle.
    """
    gone = materialize(dropped.toDF("gone").distinct())
    return rows.join(broadcast_if_small(gone), rows[key] == gone["gone"], "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores at or above its threshold go.

    The score is computed beside the row, so nothing is joined or shuffled.
    Repeated rows and rows without an id are scored each by its text; a null
    text is scored as an empty one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels, learn_ids())
    return unpacked(score_toxicity(docs, model, keep=docs.columns).where(F.col("score") < THRESHOLD))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays, once.

    A null id comes last. Of exact copies (id and text) the row with the first
    JSON text of its columns stays; texts without words that have no id all stay.
    """
    rows = _keyed(docs)
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if materialize(unclear).isEmpty():
        dropped = near_duplicates(docs.select("doc_id", "text")).where("NOT kept").select("doc_id")
        return unpacked(_without(rows, dropped, "id"))

    # A number for each document (id and text), stored so that it stays the same.
    named = materialize(rows.groupBy("uid").agg(F.first("id").alias("id"), F.count("*").alias("n")))
    named = materialize(named.withColumn("number", F.monotonically_increasing_id()))
    numbers = broadcast_if_small(named.select("uid", "number"))
    groups = near_duplicates(rows.select("uid", "text").join(numbers, "uid"), id_col="number")
    groups = materialize(groups.withColumnRenamed("doc_id", "number").distinct())
    named = materialize(named.join(groups, "number"))
    # All members of the groups of two and more.
    others = groups.where("NOT kept").select("component_id").distinct()
    members = named.join(others, "component_id")
    rank = F.struct(F.col("id").isNull().alias("last"), "id", "number")
    keeper = members.groupBy("component_id").agg(F.min(rank)["number"].alias("keeper"))
    dropped = members.join(keeper, "component_id").where("number <> keeper").select("uid")
    once = _without(rows, dropped, "uid")

    again = materialize(named.where("n > 1 AND (id IS NOT NULL OR n_shingles > 0)").select("uid"))
    single = once.join(broadcast_if_small(again), "uid", "left_anti").select("row")
    several = once.join(broadcast_if_small(again), "uid", "left_semi")
    first = several.groupBy("uid").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return unpacked(single.unionByName(first))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages beyond the contamination rule go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _keyed(docs)
    judged = decontaminate(rows.select("uid", "text"), benchmark, id_col="uid")
    return unpacked(_without(rows, judged.where("contaminated").select("doc_id"), "uid"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text becomes ``[KIND]``; every document stays.

    Repeated rows are redacted alike; a null text stays null.
    """
    return redact_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the sources' target weights and shuffled globally.

    A null source is a source; repeated rows draw alike, each for itself. Input
    columns named ``copy``, ``copies`` or ``shuffle_key`` are replaced.
    """
    return poisson_mix(docs, keep_all_columns=True)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("mixing", mixing),
]

#: The toxicity model has no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows the stages make of ``documents``, each stage written and reread.

    A stage's table is deleted once the next one is written; the last one stays
    under the checkpoint folder, since the result is read from it.
    """
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    docs, consumed = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (name, stage) in enumerate(STAGES):
        written = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(written)
        if consumed:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(consumed), True)
        docs, consumed = spark.read.parquet(written), written
    return docs
