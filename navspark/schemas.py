"""Declared schemas. Nothing in navspark infers a schema from data."""

from pyspark.sql import types as T

# Scheme catalogue as served by the NAV service: one JSON array of objects.
SCHEME_SCHEMA = T.StructType(
    [
        T.StructField("schemeCode", T.StringType(), True),
        T.StructField("schemeName", T.StringType(), True),
        T.StructField("schemeType", T.StringType(), True),
    ]
)

# One raw NAV point inside a payload: both fields are text ("dd-MM-yyyy", "12.3456").
NAV_POINT_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType(), True),
        T.StructField("nav", T.StringType(), True),
    ]
)

# A landed payload document. ``scheme_code`` is not in the document: it is the
# ``scheme_code=<code>`` directory the document was landed under (a partition
# column, so it keeps leading zeros and allows partition pruning).
PAYLOAD_DOC_SCHEMA = T.StructType(
    [T.StructField("data", T.ArrayType(NAV_POINT_SCHEMA), True)]
)
PAYLOAD_SCHEMA = T.StructType(
    PAYLOAD_DOC_SCHEMA.fields + [T.StructField("scheme_code", T.StringType(), True)]
)

# The canonical long NAV table. ``scheme_name`` is always present (nullable).
NAV_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType(), True),
        T.StructField("nav", T.DoubleType(), True),
        T.StructField("scheme_code", T.StringType(), True),
        T.StructField("scheme_name", T.StringType(), True),
    ]
)

NAV_COLUMNS = [f.name for f in NAV_SCHEMA.fields]

# Code -> name dimension used to name and select schemes.
MAPPING_SCHEMA = T.StructType(
    [
        T.StructField("scheme_code", T.StringType(), False),
        T.StructField("scheme_name", T.StringType(), True),
    ]
)

# Fixed text formats of the NAV service.
PAYLOAD_DATE_FORMAT = "dd-MM-yyyy"
ARG_DATE_FORMAT = "%d-%m-%Y"
