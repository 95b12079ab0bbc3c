"""Registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from navspark.llm.decontam import decontaminate
from navspark.llm.divergence import DIVERGENCE_SQL, source_divergence
from navspark.llm.embdup import near_vectors
from navspark.llm.langid import language_digest
from navspark.llm.maintext import extract_text
from navspark.llm.mixing import MIX_SQL, poisson_mix
from navspark.llm.neardup import near_duplicates
from navspark.llm.oracles import DECONTAMINATION_SQL, NEAR_DEDUP_SQL, NEAR_VECTORS_SQL
from navspark.llm.pii import pii_digest
from navspark.llm.planes import clusters_sql, plane_clusters
from navspark.llm.quality import quality_digest
from navspark.llm.secret_scan import secret_digest
from navspark.llm.toxicity import toxicity_digest
from navspark.llm.warc import WARC_SQL, archive_digest


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid(spark, sf_dir):
    return language_digest(_table(spark, sf_dir, "documents"))


def op2_mix(spark, sf_dir):
    return poisson_mix(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark, sf_dir):
    return toxicity_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_secrets(spark, sf_dir):
    return secret_digest(_table(spark, sf_dir, "documents"))


def op5_pii(spark, sf_dir):
    return pii_digest(_table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    return quality_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_near_dedup(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark, sf_dir):
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op9_decontaminate(spark, sf_dir):
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_warc(spark, sf_dir):
    return archive_digest(_table(spark, sf_dir, "pages"))


def op11_clusters(spark, sf_dir):
    return plane_clusters(_table(spark, sf_dir, "embeddings"))


def op12_main_text(spark, sf_dir):
    return extract_text(_table(spark, sf_dir, "pages"))


def op13_divergence(spark, sf_dir):
    return source_divergence(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_langid": op1_langid,
    "op2_mix": op2_mix,
    "op3_toxicity": op3_toxicity,
    "op4_secrets": op4_secrets,
    "op5_pii": op5_pii,
    "op6_quality": op6_quality,
    "op7_near_dedup": op7_near_dedup,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_decontaminate": op9_decontaminate,
    "op10_warc": op10_warc,
    "op11_clusters": op11_clusters,
    "op12_main_text": op12_main_text,
    "op13_divergence": op13_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op2_mix": MIX_SQL,
    "op7_near_dedup": NEAR_DEDUP_SQL,
    "op8_embedding_dedup": NEAR_VECTORS_SQL,
    "op9_decontaminate": DECONTAMINATION_SQL,
    "op10_warc": WARC_SQL,
    "op11_clusters": clusters_sql(),
    "op13_divergence": DIVERGENCE_SQL,
}
