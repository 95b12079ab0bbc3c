"""Scheme catalogue source (the service's list of all schemes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from navspark.schemas import SCHEME_SCHEMA
from navspark.sources.split_json import CATALOGUE, named_files, split_elements


def read_schemes(
    spark: SparkSession, path: str, multiline: bool = True, split_documents: bool = False
) -> DataFrame:
    """Landed catalogue documents (each one JSON array of
    ``{schemeCode, schemeName, schemeType}`` objects) -> typed catalogue.

    The schema is declared, never inferred: a numeric code becomes its text
    ('120503'), a missing key becomes NULL, extra keys are dropped. Each
    document is one task; many documents under ``path`` read in parallel. With
    ``multiline=False`` every line is one object, and large files split. With
    ``split_documents`` one large array is read by many tasks (two passes).
    """
    if split_documents:
        text = spark.read.schema("value STRING").option("lineSep", "}").text(path)
        schemes, irregular = split_elements(spark, text, CATALOGUE, SCHEME_SCHEMA, [])
        rest = named_files(irregular, lambda paths: spark.read.schema(SCHEME_SCHEMA).option("multiLine", True).json(paths), lambda: read_schemes(spark, path))
        schemes = schemes.select("item.*")
        return schemes if rest is None else schemes.unionByName(rest)
    return spark.read.schema(SCHEME_SCHEMA).option("multiLine", multiline).json(path)


def schemes_from_json_lines(text: Column) -> Column:
    """One catalogue record per JSON text value -> struct of the catalogue
    schema (same coercions as :func:`read_schemes`). Select ``"rec.*"`` after
    aliasing to get the columns."""
    return F.from_json(text, SCHEME_SCHEMA)


def schemes_to_json_lines(catalogue: DataFrame) -> DataFrame:
    """Inverse of :func:`schemes_from_json_lines`: one JSON text per scheme."""
    return catalogue.select(
        F.to_json(F.struct(*[F.col(f.name) for f in SCHEME_SCHEMA.fields])).alias("value")
    )
