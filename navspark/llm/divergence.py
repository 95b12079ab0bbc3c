"""How far the sources of a language differ in their words.

A term of a language is a row of the counts it has in the language's sources.
The distance of two sources is a sum over all kept terms, but where a source
does not have a term its share is the same constant for all such terms. So the
sum over all terms of ``|p - q|`` splits into that constant part, a part for
each count of one source alone, and a correction for each term that both have::

    |p - q| = |p0 - q0| + (|p - q0| - |p0 - q0|) + (|p0 - q| - |p0 - q0|) + correction

The corrections come from a frequent-pattern tree: the rows, each a path of
``(source, share)`` in source order with the number of terms that have it, are
sorted, so that equal beginnings lie together and are one node with a
multiplicity. A node meets each of its ancestors once, whatever its
multiplicity. Tasks take ranges of the sorted paths in bounded blocks; a node
that a border cuts is two nodes with their shares of the multiplicity, which
gives the same sums.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navspark.llm.shipping import ship
from navspark.plans.materialize import broadcast_if_small, materialize

MIN_DOCUMENTS = 30
TERM_RANKS = 50
SCALE = 1_000_000_000
SMOOTHING = 5
#: Counts of (source, term) that a task holds before it hands them on, and cells of one tree block.
HELD_COUNTS = 300_000
BLOCK_CELLS = 1 << 20

# Bytes outside words become blanks, A-Z become a-z; every byte of a non-ASCII character stays.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text."""
    return text.translate(_WORD_BYTES).split()


def term_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 1
) -> DataFrame:
    """``(lang, term, source, n, total)`` of the terms in at least ``min_docs`` documents of their language.

    ``n`` counts occurrences in the source, ``total`` in the language. Tasks
    hand on one row for each term of a language that they hold, with its
    sources' counts side by side, so a frequent term has as many rows as tasks,
    whatever its number of documents, and a rare one ends at the filter.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))],
        F.encode(F.coalesce(text_col, F.lit("")), "UTF-8").alias("text"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Counter, dict[str, Counter]]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*batch.columns, strict=True):
                found = terms(text.as_py())
                docs_with, sources = held.setdefault(lang.as_py(), (Counter(), {}))
                n = sources.setdefault(source.as_py(), Counter())
                size -= len(n)
                n.update(found)
                docs_with.update(set(found))
                size += len(n)
                if size >= HELD_COUNTS:
                    yield from _count_rows(held)
                    held, size = {}, 0
        yield from _count_rows(held)

    partial = rows.mapInArrow(
        count, "lang string, term string, docs bigint, total bigint, sources array<string>, counts array<bigint>"
    )
    whole = Window.partitionBy("lang", "term")
    kept = partial.withColumns({c: F.sum(c).over(whole) for c in ("docs", "total")}).where(F.col("docs") >= min_docs)
    cells = kept.select("lang", "term", "total", F.inline(F.arrays_zip("sources", "counts")).alias("source", "n"))
    return cells.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.max("total").alias("total"))


def _count_rows(held: dict[str, tuple[Counter, dict[str, Counter]]]) -> Iterator[pa.RecordBatch]:
    for lang, (docs_with, sources) in held.items():
        cells: dict[bytes, tuple[list[str], list[int]]] = {t: ([], []) for t in docs_with}
        for source, counts in sources.items():
            for term, n in counts.items():
                names, numbers = cells[term]
                names.append(source)
                numbers.append(n)
        if cells:
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(cells), pa.string()),
                "term": pa.array(list(cells), pa.binary()).cast(pa.string()),
                "docs": pa.array(list(docs_with.values()), pa.int64()),
                "total": pa.array([sum(n) for _, n in cells.values()], pa.int64()),
                "sources": pa.array([s for s, _ in cells.values()], pa.list_(pa.string())),
                "counts": pa.array([n for _, n in cells.values()], pa.list_(pa.int64())),
            })


def _share(n: str, total: str) -> Column:
    """``1 + floor(SCALE * (n + SMOOTHING) / total)`` in decimals, null without a total."""
    return F.expr(
        f"1L + (CAST({SCALE}L AS DECIMAL(10,0)) * CAST({n} + {SMOOTHING} AS DECIMAL(19,0))) "
        f"DIV CAST(nullif({total}, 0) AS DECIMAL(19,0))"
    )


def tree_corrections(sources: np.ndarray, p: np.ndarray, p0: np.ndarray, offsets: np.ndarray, times: np.ndarray):
    """``(earlier source, later source, correction)`` sums of sorted paths of one language.

    ``sources``, ``p`` and ``p0`` (a source's number, the term's share in it and
    its share of terms it does not have) lie end to end, cut at ``offsets``; a
    path stands for ``times`` terms.
    """
    lengths = np.diff(offsets)
    depth = int(lengths.max(initial=0))
    if depth < 2:
        return np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    inside = np.arange(depth)[None, :] < lengths[:, None]
    at = np.where(inside, offsets[:-1, None] + np.arange(depth)[None, :], 0)
    src, p, p0 = np.where(inside, sources[at], -1), p[at], p0[at]
    same = (src[1:] == src[:-1]) & (p[1:] == p[:-1]) & inside[1:]
    # How many nodes each path shares with the one before it.
    shared = np.concatenate(([0], np.cumprod(same, axis=1).sum(axis=1)))
    width = int(sources.max()) + 1
    codes, sums = [], []
    for j in range(1, depth):
        starts = np.flatnonzero(shared <= j)
        multiplicity = np.add.reduceat(times, starts)
        real = lengths[starts] > j
        node, multiplicity = starts[real], multiplicity[real]
        g, pg, qg = src[node, :j], p[node, :j], p0[node, :j]
        h, ph, qh = src[node, j, None], p[node, j, None], p0[node, j, None]
        gain = np.abs(pg - ph) - np.abs(pg - qh) - np.abs(qg - ph) + np.abs(qg - qh)
        code, total = _sums((g * width + h).ravel(), (gain * multiplicity[:, None]).ravel())
        codes.append(code)
        sums.append(total)
    code, total = _sums(np.concatenate(codes), np.concatenate(sums))
    return np.stack([code // width, code % width], axis=1), total


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(keys, return_inverse=True)
    out = np.zeros(len(distinct), dtype=np.int64)
    np.add.at(out, place, values)
    return distinct, out


def _tree_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        langs = batch.column("lang").to_pylist()
        times = batch.column("times").to_numpy()
        paths = batch.column("path")
        ends = paths.offsets.to_numpy().astype(np.int64)
        items = paths.values
        coded = items.field("source").dictionary_encode()
        names = coded.dictionary.to_pylist()
        sources = coded.indices.to_numpy().astype(np.int64)
        p, p0 = (items.field(c).to_numpy() for c in ("p", "p0"))
        a = 0
        while a < len(langs):
            # A block: rows of one language whose padded paths stay within the cells.
            b, longest = a, 1
            while b < len(langs) and langs[b] == langs[a]:
                longest = max(longest, ends[b + 1] - ends[b])
                if b > a and (b + 1 - a) * longest > BLOCK_CELLS:
                    break
                b += 1
            lo, hi = ends[a], ends[b]
            pairs, total = tree_corrections(
                sources[lo:hi], p[lo:hi], p0[lo:hi], ends[a : b + 1] - lo, times[a:b]
            )
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([langs[a]] * len(total), pa.string()),
                "source": pa.array([names[x] for x in pairs[:, 0]], pa.string()),
                "item": pa.array([names[x] for x in pairs[:, 1]], pa.string()),
                "value": pa.array(total, pa.int64()),
            })
            a = b


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair``: each other source of the language by its distance over all
    kept terms. Part ``term``: the terms that the source has more of than its
    language, the first 50. Null texts, languages and sources are empty ones;
    repeated rows count each time, texts of any length count whole, equal
    values rank by item in UTF-8 order. A group without words is a group; a
    language without kept terms has distances of 0. An empty table gives an
    empty result, other columns are ignored.
    """
    cells = materialize(term_counts(docs, text_col, lang_col, source_col, MIN_DOCUMENTS))

    known = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
    ).distinct()
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    kept = cells.groupBy("lang", "term").agg(F.max("total").alias("total"))
    langs = materialize(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_size")))
    groups = known.join(sizes, ["lang", "source"], "left").join(broadcast_if_small(langs), "lang", "left")
    groups = materialize(
        groups.select(
            "lang",
            "source",
            F.coalesce("v", F.lit(0).cast("bigint")).alias("v"),
            F.expr(f"coalesce(size, 0L) + {SMOOTHING} * coalesce(v, 0L)").alias("size"),
            F.expr(f"coalesce(lang_size, 0L) + {SMOOTHING} * coalesce(v, 0L)").alias("lang_size"),
        ).withColumn("p0", F.coalesce(_share("0L", "size"), F.lit(0).cast("bigint")))
    )
    # The pairs asked for are the square of these rows, so where these do not
    # fit a broadcast the result itself is thousands of times larger.
    groups = broadcast_if_small(groups)

    shares = cells.join(groups, ["lang", "source"]).withColumn("p", _share("n", "size"))

    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    apart = F.abs(F.col("p0") - F.col("q0"))
    base = groups.join(others, "lang").where("source <> item").select("lang", "source", "item", (F.col("v") * apart).alias("value"))

    single = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("times"))
    single = single.join(others, "lang").where("source <> item").groupBy("lang", "source", "item").agg(
        F.sum(F.col("times") * (F.abs(F.col("p") - F.col("q0")) - apart)).alias("value")
    )
    paths = shares.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "p0"))).alias("path"))
    paths = paths.groupBy("lang", "path").agg(F.count("*").alias("times"))
    sorted_paths = paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    both = sorted_paths.mapInArrow(_tree_tasks, "lang string, source string, item string, value bigint")
    both = both.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    either_way = single.unionByName(both).select(
        "lang",
        F.inline(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))),
        "value",
    )
    pairs = base.unionByName(either_way).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    excess = shares.withColumn("value", F.col("p") - _share("total", "lang_size")).where("value > 0")
    excess = excess.select("lang", "source", F.col("term").alias("item"), "value")

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [
        rows.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
        for part, rows in (("pair", pairs), ("term", excess))
    ]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= TERM_RANKS))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: DuckDB SQL of the result: every group with every kept term, all pairs by brute force.
DIVERGENCE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
t AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {MIN_DOCUMENTS}),
n AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
size AS (SELECT lang, source, sum(n) AS size FROM n GROUP BY lang, source),
v AS (SELECT lang, count(*) AS v, sum(total) AS lang_size FROM kept GROUP BY lang),
g AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(size, 0) AS size, coalesce(lang_size, 0) AS lang_size
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN size USING (lang, source) LEFT JOIN v USING (lang)),
grid AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (CAST({SCALE} AS HUGEINT) * (coalesce(n, 0) + {SMOOTHING})) // (size + {SMOOTHING} * v) AS p,
         1 + (CAST({SCALE} AS HUGEINT) * (total + {SMOOTHING})) // (lang_size + {SMOOTHING} * v) AS q
  FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
every_pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM every_pair
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM grid WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}"""
