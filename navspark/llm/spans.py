"""Regular-expression spans with code-point offsets, from built-in functions only.

Spark has no function that returns match offsets. ``split`` gives the text
between the matches and ``regexp_extract_all`` the matches, so the running sum
of their lengths gives every offset, in time linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
_BLOCK = 256


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column) -> Column:
    """Running sums of an array, quadratic only in its length."""
    return F.aggregate(
        values,
        F.array().cast("array<bigint>"),
        lambda acc, v: F.concat(acc, F.array(v + F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)))),
    )


def running_sums(values: Column) -> Column:
    """Running sums of a bigint array; blocks keep long arrays cheap. Empty in, empty out."""

    def blocks_of(a: Column) -> Column:
        n_blocks = F.ceil(F.size(a) / F.lit(float(_BLOCK))).cast("int")
        return F.transform(
            F.sequence(F.lit(0), n_blocks - 1), lambda b: _running(F.slice(a, b * _BLOCK + 1, _BLOCK))
        )

    def shifted(blocks: Column) -> Column:
        ends = _running(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return F.flatten(
            F.zip_with(blocks, ends, lambda b, e: F.transform(b, lambda v: v + e - F.element_at(b, -1)))
        )

    return let(
        values,
        lambda a: F.when(F.size(a) <= _BLOCK, _running(a)).otherwise(let(blocks_of(a), shifted)),
    )


def regex_spans(text: Column, pattern: str | Column) -> Column:
    """All leftmost non-overlapping matches of a Java regular expression (one for all rows or one per row).

    Returns ``array<struct<start, end, value, before, after>>`` in text order:
    offsets in code points (end exclusive), the matched text, and up to
    ``CONTEXT_CHARS`` characters on either side, never reaching into a
    neighbouring match. Null text gives an empty array. The pattern must not
    match the empty string.
    """
    empty = F.array().cast(
        "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"
    )
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def build(m: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        return let(
            F.struct(m.alias("m"), gaps.alias("g")),
            lambda p: let(
                F.struct(
                    p["m"].alias("m"),
                    p["g"].alias("g"),
                    running_sums(
                        F.transform(
                            p["m"],
                            lambda v, i: (
                                F.length(F.get(p["g"], i))
                                + F.when(i > 0, F.length(F.get(p["m"], i - 1))).otherwise(0)
                            ).cast("bigint"),
                        )
                    ).alias("s"),
                ),
                lambda q: F.transform(
                    q["m"],
                    lambda v, i: F.struct(
                        F.get(q["s"], i).alias("start"),
                        (F.get(q["s"], i) + F.length(v)).alias("end"),
                        v.alias("value"),
                        F.right(F.get(q["g"], i), F.lit(CONTEXT_CHARS)).alias("before"),
                        F.left(F.get(q["g"], i + 1), F.lit(CONTEXT_CHARS)).alias("after"),
                    ),
                ),
            ),
        )

    return F.coalesce(let(found, lambda m: F.when(F.size(m) > 0, build(m)).otherwise(empty)), empty)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in the array's order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def count_kind(spans: Column | str, kind: str) -> Column:
    """How many spans are of ``kind``."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
