"""navspark: fund net-asset-value (NAV) analytics as Spark DataFrame plans.

Every operator is a pure function ``DataFrame -> DataFrame`` (or
``SparkSession, path -> DataFrame`` for sources). Operators never run an
action, never own a session and never sort unless sorting is the feature.
The only operators that run a job while building the plan are the ones that
must know something first: the pivot's column list, the hot-key check of the
sequence windows and, when asked to split documents, the reader's first pass.
"""

from navspark.schemas import NAV_SCHEMA, PAYLOAD_SCHEMA, SCHEME_SCHEMA
from navspark.sources.catalogue import read_schemes, schemes_from_json_lines
from navspark.sources.payload import nav_from_payloads, read_nav, rejected_payloads, scheme_payload
from navspark.sources.popular import popular_schemes, popular_schemes_mapping
from navspark.sources.sinks import read_nav_bucketed, read_nav_table, write_nav, write_nav_bucketed, write_table
from navspark.operators.selection import nav_range, top_nav
from navspark.operators.combine import nav_multi, nav_union, attach_names
from navspark.operators.catalog import search_schemes
from navspark.operators.pivot import pivot_nav
from navspark.operators.metrics import performance_metrics, scheme_summary
from navspark.operators.windows import returns, rolling_metrics
from navspark.operators.periodic import latest_nav, monthly_nav
from navspark.plans.pipeline import run_pipeline
from navspark.streaming.ingest import nav_stream, start_nav_ingest

__all__ = [
    "NAV_SCHEMA",
    "PAYLOAD_SCHEMA",
    "SCHEME_SCHEMA",
    "attach_names",
    "latest_nav",
    "monthly_nav",
    "nav_from_payloads",
    "nav_multi",
    "nav_range",
    "nav_stream",
    "nav_union",
    "performance_metrics",
    "pivot_nav",
    "popular_schemes",
    "popular_schemes_mapping",
    "read_nav",
    "read_nav_bucketed",
    "read_nav_table",
    "read_schemes",
    "rejected_payloads",
    "returns",
    "rolling_metrics",
    "run_pipeline",
    "scheme_payload",
    "scheme_summary",
    "schemes_from_json_lines",
    "search_schemes",
    "start_nav_ingest",
    "top_nav",
    "write_nav",
    "write_nav_bucketed",
    "write_table",
]
