"""NAV payload sources.

Landed layout (one directory per scheme, any number of documents in it)::

    <root>/scheme_code=<code>/<anything>.json   {"data": [{"date": "dd-MM-yyyy", "nav": "…"}, …], …}

``scheme_code`` is a partition column declared as STRING, so codes keep their
leading zeros and a code filter prunes whole directories before any file is
opened. A document without ``data`` (or with an empty array) yields no rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navspark.functions.exprs import parse_arg_date, parse_nav_date, parse_nav_value
from navspark.schemas import NAV_COLUMNS, NAV_POINT_SCHEMA, PAYLOAD_DOC_SCHEMA, PAYLOAD_SCHEMA
from navspark.sources.split_json import PAYLOAD, named_files, split_elements

# Up to so many codes are looked up one by one, more in one listing of the root.
MAX_LOOKUPS = 16
# Folders that one glob names.
GLOB_FOLDERS = 500
CORRUPT = "_corrupt_record"


def read_payloads(
    spark: SparkSession, root: str, codes: Iterable[str] | None = None, multiline: bool = True
) -> DataFrame:
    """Landed payload documents -> ``data ARRAY<STRUCT<date,nav>>, scheme_code``.

    With ``codes`` only those schemes' folders are listed; a code without a
    folder contributes nothing. A multi-line document is read by one task
    whole (:func:`read_points` reads one with many tasks); with
    ``multiline=False`` every line of a file is a document of its own, and
    large files split over tasks. A malformed document has NULL ``data``;
    :func:`rejected_payloads` names it.
    """
    return _documents(spark, root, codes, PAYLOAD_SCHEMA, lambda r: r.option("multiLine", multiline).json)


def _documents(spark: SparkSession, root: str, codes: Iterable[str] | None, schema, how) -> DataFrame:
    """The documents of ``root``, or of the folders of ``codes`` in it, by the method ``how`` of a reader."""
    reader = spark.read.schema(schema)
    if codes is None:
        return how(reader)(root)
    folders = scheme_folders(spark, root, codes)
    if not folders:
        return spark.createDataFrame([], schema)
    return how(reader.option("basePath", root))(folders)


def scheme_folders(spark: SparkSession, root: str, codes: Iterable[str]) -> list[str]:
    """Paths or globs of the existing folders of ``codes`` under ``root``,
    through Hadoop's file system API, so any store that Spark reads will do.

    A few codes are asked for one by one. Many cost one listing of ``root``,
    and come back as globs of up to ``GLOB_FOLDERS`` folders, which Spark
    resolves with one listing each instead of a look-up for every path.
    """
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    wanted = [f"scheme_code={escape(code)}" for code in dict.fromkeys(str(c) for c in codes)]
    root = root.rstrip("/")
    if len(wanted) <= MAX_LOOKUPS:
        return [f"{root}/{name}" for name in wanted if _exists(fs, jvm.org.apache.hadoop.fs.Path(base, name))]
    there = _folder_names(jvm, fs, base)
    found = [name for name in wanted if name in there]
    # Names with a comma or a brace cannot stand in a glob's set.
    simple = [name for name in found if not set(name) & set(",{}[]*?\\")]
    globs = [f"{root}/{{{','.join(simple[i : i + GLOB_FOLDERS])}}}" for i in range(0, len(simple), GLOB_FOLDERS)]
    return globs + [f"{root}/{name}" for name in found if name not in set(simple)]


def _exists(fs, path) -> bool:
    return fs.exists(path)


def _folder_names(jvm, fs, base) -> set[str]:
    """Names in ``base``, by one listing."""
    return {status.getPath().getName() for status in fs.listStatus(base)} if fs.exists(base) else set()


def read_points(spark: SparkSession, root: str, codes: Iterable[str] | None = None) -> DataFrame:
    """Points of landed documents, one row each: ``p STRUCT<date,nav>, scheme_code``.

    The same rows as exploding :func:`read_payloads`, but a large document is
    read by many tasks (:mod:`navspark.sources.split_json`); documents of
    another form than the service's are read whole. A NAV given as a JSON number
    may have another text for the same value (``1e3``, ``1000.0``).
    """
    text = _documents(spark, root, codes, "value STRING, scheme_code STRING", lambda r: r.option("lineSep", "}").text)
    if not text.inputFiles():
        return spark.createDataFrame([], "p STRUCT<date: STRING, nav: STRING>, scheme_code STRING")
    points, irregular = split_elements(spark, text, PAYLOAD, NAV_POINT_SCHEMA, ["scheme_code"])
    points = points.select(F.col("item").alias("p"), "scheme_code")
    rest = named_files(irregular, lambda paths: read_payloads_at(spark, root, paths), lambda: read_payloads(spark, root, codes))
    return points if rest is None else points.unionByName(rest.select(F.explode("data").alias("p"), "scheme_code"))


def read_payloads_at(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """The payload documents at ``paths`` under ``root``."""
    return spark.read.schema(PAYLOAD_SCHEMA).option("multiLine", True).option("basePath", root).json(paths)


def rejected_payloads(
    spark: SparkSession, root: str, codes: Iterable[str] | None = None, multiline: bool = True
) -> DataFrame:
    """Landed documents that cannot be read: ``scheme_code, path, payload``.

    A truncated document, one that is no JSON and one whose ``data`` has
    another type are here with their text, a file without any text with an
    empty one. Documents without ``data`` are sound: a scheme may have none.
    """
    schema = T.StructType([*PAYLOAD_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    read = _documents(
        spark, root, codes, schema,
        lambda r: r.option("multiLine", multiline).option("columnNameOfCorruptRecord", CORRUPT).json,
    )
    files = _documents(spark, root, codes, "value STRING, scheme_code STRING", lambda r: r.option("wholetext", True).text)
    listed = files.inputFiles()
    if not listed:
        return spark.createDataFrame([], "scheme_code STRING, path STRING, payload STRING")
    path = F.col("_metadata.file_path").alias("path")
    # Spark refuses a query for the corrupt text alone; ``data`` never fails this test.
    bad = read.where(F.col(CORRUPT).isNotNull() & (F.coalesce(F.size("data"), F.lit(0)) >= -1))
    bad = bad.select("scheme_code", path, F.col(CORRUPT).alias("payload"))
    # Blank files give the JSON reader no record, files without a byte no reader any row.
    blank = files.where(F.col("value").rlike(r"^\s*\z")).select("scheme_code", path, F.lit("").alias("payload"))
    seen = files.select(path).distinct()
    listing = spark.createDataFrame([(f,) for f in listed], "path STRING")
    # The listing writes an empty authority as three slashes, metadata as one.
    none = listing.select(F.regexp_replace("path", r"^(\w+):///", "$1:/").alias("path")).join(seen, "path", "left_anti")
    code = F.regexp_extract("path", "scheme_code=([^/]*)/", 1)
    for _ in range(2):  # the partition's escapes, inside those of a URL
        code = F.url_decode(F.replace(code, F.lit("+"), F.lit("%2B")))
    none = none.select(code.alias("scheme_code"), "path", F.lit("").alias("payload"))
    return bad.unionByName(blank).unionByName(none)


def nav_from_payloads(payloads: DataFrame, name: Column | None = None) -> DataFrame:
    """``data`` arrays -> canonical NAV rows ``date, nav, scheme_code, scheme_name``.

    Text is typed with ANSI-safe parsers: an unparseable date or NAV becomes
    NULL and the row is kept (ingest never drops data). ``name`` fills
    ``scheme_name`` (NULL when not given).
    """
    pts = payloads.select(
        F.col("scheme_code"),
        *([name.alias("scheme_name")] if name is not None else []),
        F.explode("data").alias("p"),
    )
    return nav_from_points(pts)


def nav_from_points(points: DataFrame) -> DataFrame:
    """Points (``p STRUCT<date,nav>, scheme_code`` and, if there, ``scheme_name``) -> canonical NAV rows."""
    name = F.col("scheme_name") if "scheme_name" in points.columns else F.lit(None).cast("string")
    return points.select(
        parse_nav_date(F.col("p.date")).alias("date"),
        parse_nav_value(F.col("p.nav")).alias("nav"),
        F.col("scheme_code"),
        name.alias("scheme_name"),
    )


def payloads_from_text(text: DataFrame, value: str = "value") -> DataFrame:
    """Payload documents held as JSON text (with a ``scheme_code`` column) ->
    the same shape as :func:`read_payloads`."""
    return text.select(
        F.from_json(F.col(value), PAYLOAD_DOC_SCHEMA)["data"].alias("data"),
        F.col("scheme_code"),
    )


def filter_dates(nav: DataFrame, start=None, end=None) -> DataFrame:
    """Inclusive date bounds; either may be omitted. Arguments are
    'dd-mm-yyyy' text or dates; a bad argument raises ValueError."""
    s, e = parse_arg_date(start), parse_arg_date(end)
    if s is not None:
        nav = nav.where(F.col("date") >= F.lit(s))
    if e is not None:
        nav = nav.where(F.col("date") <= F.lit(e))
    return nav


def read_nav(
    spark: SparkSession,
    root: str,
    codes: Iterable[str] | None = None,
    start=None,
    end=None,
    multiline: bool = True,
    split_documents: bool = False,
) -> DataFrame:
    """Historical NAV of the landed schemes (all, or ``codes``), typed and
    bounded to ``[start, end]``. One scan for any number of schemes: tasks
    are split by document, never one job per scheme. With ``split_documents``
    a large document is read by many tasks (:func:`read_points`; two passes)."""
    nav = landed_nav(spark, root, codes, multiline, split_documents)
    return filter_dates(nav, start, end).select(*NAV_COLUMNS)


def landed_nav(
    spark: SparkSession, root: str, codes: Iterable[str] | None, multiline: bool = True, split_documents: bool = False
) -> DataFrame:
    """NAV rows of landed documents by the reader asked for, unbounded and unnamed."""
    if split_documents:
        return nav_from_points(read_points(spark, root, codes))
    return nav_from_payloads(read_payloads(spark, root, codes, multiline))


def scheme_payload(spark: SparkSession, root: str, code: str | Iterable[str] | None) -> DataFrame:
    """Raw payload text of one scheme, several or (None) all: ``scheme_code,
    payload``, one row per landed document. Only the given schemes' folders
    are listed and read; a scheme without a folder has no rows."""
    codes = [code] if isinstance(code, str) else code
    text = _documents(spark, root, codes, "value STRING, scheme_code STRING", lambda r: r.option("wholetext", True).text)
    return text.select("scheme_code", F.col("value").alias("payload"))
