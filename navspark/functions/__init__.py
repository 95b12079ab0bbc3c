"""Column expressions shared by the operators. All are Spark built-ins, so
they stay inside whole-stage codegen; none is a Python UDF."""

from navspark.functions.exprs import (
    annualised_pct,
    change_pct,
    parse_arg_date,
    parse_nav_date,
    parse_nav_value,
    round4,
)

__all__ = [
    "annualised_pct",
    "change_pct",
    "parse_arg_date",
    "parse_nav_date",
    "parse_nav_value",
    "round4",
]
