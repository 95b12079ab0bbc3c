from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from navspark.schemas import ARG_DATE_FORMAT, PAYLOAD_DATE_FORMAT


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_nav_date(x: str | Column) -> Column:
    """'dd-MM-yyyy' text -> DATE; anything else (bad text, 31-02, 1-1-2024) -> NULL.

    ``try_to_date`` gives NULL instead of an error whether ANSI mode is on or off.
    """
    return F.try_to_date(_c(x), PAYLOAD_DATE_FORMAT)


def parse_nav_value(x: str | Column) -> Column:
    """NAV text -> DOUBLE; 'N.A.', '1,234.5' and other junk -> NULL (ANSI-safe)."""
    return _c(x).try_cast("double")


def parse_arg_date(value) -> _dt.date | None:
    """A date argument given as 'dd-mm-yyyy' text, a ``date`` or None.

    Bad arguments raise ``ValueError``: an argument error is the caller's
    mistake and must not turn into an empty result.
    """
    if value is None or value == "":
        return None
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.datetime.strptime(str(value), ARG_DATE_FORMAT).date()


def change_pct(new: str | Column, old: str | Column) -> Column:
    """((new - old) / old) * 100; NULL when old is 0 or either side is NULL."""
    return F.try_divide(_c(new) - _c(old), _c(old)) * F.lit(100.0)


def annualised_pct(latest: str | Column, first: str | Column, days: str | Column) -> Column:
    """(pow(latest / first, 365 / days) - 1) * 100 in DOUBLE; NULL when first or
    days is 0 (no guard: callers that want 0 for a zero-day period add it)."""
    ratio = F.try_divide(_c(latest), _c(first))
    exponent = F.try_divide(F.lit(365.0), _c(days).cast("double"))
    return (F.pow(ratio, exponent) - F.lit(1.0)) * F.lit(100.0)


def double_order(x: str | Column) -> Column:
    """DOUBLE -> BIGINT that sorts as the doubles do (NaN last, both zeros equal).

    The value's sign, exponent and mantissa put together by exact arithmetic:
    a power of two is exact in ``pow``, and so is a division by one. The
    exponent from ``log2`` may be one off and is corrected by the mantissa it
    leaves. NULL stays NULL.
    """
    v = _c(x)
    a = F.abs(v)
    e0 = F.floor(F.log2(F.when(a > 0, a).otherwise(F.lit(1.0))))
    e0 = F.least(F.greatest(e0, F.lit(-1022).cast("bigint")), F.lit(1023).cast("bigint"))
    m0 = a / F.pow(F.lit(2.0), e0.cast("double"))
    high, low = m0 >= 2.0, (m0 < 1.0) & (e0 > -1022)
    e = F.when(a == 0, F.lit(-1022).cast("bigint")).otherwise(e0 + F.when(high, 1).when(low, -1).otherwise(0))
    m = F.when(high, m0 / 2.0).when(low, m0 * 2.0).otherwise(m0)
    bits = (e + 1022) * F.lit(1 << 52) + (m * float(1 << 52)).cast("bigint")
    top = F.lit(2047 << 52)
    return F.when(F.isnan(v), top + 1).when(v == float("inf"), top).when(v == float("-inf"), -top).when(
        v < 0, -bits
    ).otherwise(bits)


def dated_order(date: str | Column, value: str | Column) -> Column:
    """(DATE, DOUBLE) -> DECIMAL that sorts by date, then value, NULL values
    first within a date; NULL for a NULL date. Of fixed width, so that it fits
    a hash aggregation's buffer."""
    day = F.unix_date(_c(date)).cast("decimal(8,0)")
    place = F.coalesce(double_order(value), F.lit(-(1 << 63)))
    return day * F.lit(str(1 << 64)).cast("decimal(20,0)") + place.cast("decimal(20,0)")


def round4(x: str | Column) -> Column:
    """Half-up rounding to 4 decimals that agrees bit-for-bit with the SQL
    oracle form ``CAST(floor(x*10000 + 0.50001) AS DOUBLE)/10000``.

    Used only by the query wrappers that are compared against the oracle, so
    last-bit float differences between two engines do not count as errors.
    """
    c = _c(x)
    return F.floor(c * F.lit(10000.0) + F.lit(0.50001)).cast("double") / F.lit(10000.0)
