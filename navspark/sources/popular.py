"""The built-in dimension of popular schemes (code -> name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from navspark.schemas import MAPPING_SCHEMA

# They must equal the service's codes and the names given to them.
# Each code appears once; for a code listed twice in the source list the later
# name is the one kept (118989, 120716), in the position of its first listing.
POPULAR_SCHEMES = {
    "120503": "Axis Bluechip Fund",
    "118989": "Parag Parikh Long Term Equity Fund",
    "119533": "SBI Bluechip Fund",
    "125497": "ICICI Prudential Bluechip Fund",
    "120716": "HDFC Index Fund Nifty 50 Plan",
    "119551": "Axis Midcap Fund",
    "125494": "ICICI Prudential MidCap Fund",
    "119552": "Axis Small Cap Fund",
    "125498": "ICICI Prudential SmallCap Fund",
    "119434": "UTI Nifty 50 Index Fund",
    "100127": "Kotak Standard Multicap Fund",
}


def popular_schemes_mapping() -> dict[str, str]:
    return dict(POPULAR_SCHEMES)


def popular_schemes(spark: SparkSession) -> DataFrame:
    """The mapping as a two-column dimension (unique ``scheme_code``)."""
    return spark.createDataFrame(list(POPULAR_SCHEMES.items()), MAPPING_SCHEMA)
