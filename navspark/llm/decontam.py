"""Benchmark decontamination with a distributed positional inverted index.

1. One pass over all documents counts every term the benchmark uses.
2. Each benchmark window names its two rarest terms, its anchors. A second pass
   stores those terms' postings: per document, the runs of positions at which a
   term stands (a text of one repeated word is one run).
3. A posting less an anchor's place in its item is the item's offset in the
   document; a run against a run is a range of offsets. Offset-adjusted lists
   meet by document and item: an occurrence of any window has two of its
   rarest terms on one offset. Nearly equal offsets are proximity matches.
4. Along each surviving offset the document's words are compared with the
   item's: runs as long as a window are exact matches, their words are hit.

The number of passes does not depend on the benchmark's size: its vocabulary,
its anchors and its items are tables. Each is sent to the tasks if its size is
proven small, and joined beyond that. Documents are never collected, grouped
whole or joined among themselves, and their text moves only where the candidates
are too many to be sent to them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navspark.llm.blocks import frugal
from navspark.llm.packing import identity, quoted
from navspark.llm.shipping import ship
from navspark.llm.textops import ALPHANUMERIC, utf8_slices, word_bounds, word_hashes
from navspark.plans.materialize import BROADCAST_BYTES, broadcast_if_small, materialize

WINDOW = 13
ANCHORS = 2
SLOP = 3


def text_words(texts: pa.Array) -> Iterator[np.ndarray]:
    """Hashes of each text's words, in order."""
    for first, last, data, offsets in utf8_slices(texts):
        starts, ends, bounds = word_bounds(data, offsets, ALPHANUMERIC)
        words = word_hashes(data, starts, ends)
        for i in range(last - first):
            yield words[bounds[i] : bounds[i + 1]]


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item, words)``: each item's id as a string (null as empty) and its word hashes; wordless items are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.view(np.int64) for w in text_words(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.int64()))], names=["item", "words"])

    ids = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item")
    return items.select(ids, F.col(text_col)).mapInArrow(run, "item string, words array<bigint>").where("size(words) > 0").distinct()


def _small_vocabulary(terms: DataFrame) -> np.ndarray | None:
    """The distinct ``term`` values, sorted, if their size is proven small."""
    if terms.count() * 8 > BROADCAST_BYTES:
        return None
    return np.sort(np.array([r["term"] for r in terms.collect()], dtype=np.int64).view(np.uint64))


def _known(words: np.ndarray, vocabulary: np.ndarray | None) -> np.ndarray:
    """Whether each word is of the vocabulary (None: any)."""
    if vocabulary is None:
        return np.ones(len(words), dtype=bool)
    if not len(vocabulary):
        return np.zeros(len(words), dtype=bool)
    return vocabulary[np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)] == words


def collection_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, n)``: how often each of ``terms`` occurs in the ``text`` column of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(_small_vocabulary(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = shared.value
        total = np.zeros(0 if voc is None else len(voc), dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in utf8_slices(batch.column(0)):
                starts, ends, _ = word_bounds(data, offsets, ALPHANUMERIC)
                words = word_hashes(data, starts, ends)
                if voc is None:
                    found, n = np.unique(words, return_counts=True)
                    yield counts(found, n)
                elif len(voc):
                    at = np.searchsorted(voc, words[_known(words, voc)])
                    total += np.bincount(at, minlength=len(voc))
        if voc is not None:
            at = np.flatnonzero(total)
            yield counts(voc[at], total[at])

    def counts(found: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["term", "n"])

    rows = docs.select("text").mapInArrow(frugal(run), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    return terms.join(rows, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def rarest_places(frequency: np.ndarray) -> np.ndarray:
    """Places in an item, given its words' frequencies, that are among the ``ANCHORS`` rarest of some window."""
    w = min(WINDOW, len(frequency))
    windows = np.lib.stride_tricks.sliding_window_view(frequency, w)
    rarest = np.argsort(windows, axis=1, kind="stable")[:, :ANCHORS]
    return np.unique(rarest + np.arange(len(windows))[:, None])


def anchor_runs(items: DataFrame, frequencies: DataFrame) -> DataFrame:
    """``(term, item_no, p, q, need)``: runs of places ``p .. q - 1`` that anchor the
    same term in an item, of which ``need`` must agree with a document."""
    words = items.select("item_no", F.posexplode("words").alias("place", "term"))
    # A join of words with their counts; a frequent word's rows are as many as its places in the benchmark.
    counted = words.join(broadcast_if_small(frequencies), "term")
    lists = counted.groupBy("item_no").agg(F.array_sort(F.collect_list(F.struct("place", "term", "n"))).alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int, int]] = []
            for item, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms = [w["term"] for w in words]
                places = rarest_places(np.array([w["n"] for w in words])).tolist()
                need = min(ANCHORS, len(terms))
                first = places[0]
                for here, after in zip(places, [*places[1:], -1], strict=True):
                    if after != here + 1 or terms[after] != terms[here]:
                        out.append((terms[here], item, first, here + 1, need))
                        first = after
            yield pa.RecordBatch.from_pylist([dict(zip(names, o, strict=True)) for o in out], schema=arrow)

    names = ["term", "item_no", "p", "q", "need"]
    arrow = pa.schema([(n, pa.int64()) for n in names])
    return lists.mapInArrow(run, ", ".join(f"{n} bigint" for n in names))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Positional postings of ``terms`` over ``docs(uid, doc_id, text)``.

    One row per document: ``(uid, doc_id, n_words, postings)``; a posting
    ``(term, s, e)`` is a run of positions ``s .. e - 1`` with that term.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_small_vocabulary(terms))
    fields = [("term", pa.int64()), ("s", pa.int64()), ("e", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = shared.value
        for batch in batches:
            n, sizes, runs = [], [0], []
            for words in text_words(batch.column(2)):
                n.append(len(words))
                hit = np.flatnonzero(_known(words, voc))
                found = words[hit]
                begin = np.ones(len(hit), dtype=bool)
                begin[1:] = (hit[1:] != hit[:-1] + 1) | (found[1:] != found[:-1])
                first = np.flatnonzero(begin)
                last = np.append(first[1:], len(hit)) - 1
                sizes.append(len(first))
                runs.append((found[first].view(np.int64), hit[first], hit[last[: len(first)]] + 1))
            columns = [np.concatenate([r[k] for r in runs]) if runs else np.zeros(0, np.int64) for k in range(3)]
            postings = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f for f, _ in fields])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), postings)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), lists],
                names=["uid", "doc_id", "n_words", "postings"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("uid", "doc_id", "text").mapInArrow(
        frugal(run), f"uid string, doc_id {kind}, n_words bigint, postings array<struct<term:bigint,s:bigint,e:bigint>>"
    )


def adjusted_postings(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """``(uid, item_no, need, lo, hi, place)``: every posting against every anchor run
    of its term. Along the offsets ``lo .. hi`` one more anchor agrees."""
    once = index.where("size(postings) > 0").select("uid", "postings").dropDuplicates(["uid"])
    met = once.select("uid", F.inline("postings")).join(broadcast_if_small(anchors), "term")
    lo, hi = F.col("s") - F.col("q") + 1, F.col("e") - 1 - F.col("p")
    # Runs that overlap in one word agree once, in more words (at least) twice.
    ranges = F.filter(
        F.array(
            F.struct(lo.alias("lo"), hi.alias("hi"), F.col("p").alias("place")),
            F.struct((lo + 1).alias("lo"), (hi - 1).alias("hi"), (F.col("p") + 1).alias("place")),
        ),
        lambda r: r["lo"] <= r["hi"],
    )
    longer = (F.col("q") - F.col("p") > 1) & (F.col("e") - F.col("s") > 1)
    ranges = F.when(longer, ranges).otherwise(F.slice(ranges, 1, 1))
    return met.select("uid", "item_no", "need", F.inline(ranges))


def phrase_candidates(adjusted: DataFrame) -> DataFrame:
    """``(uid, item_no, lo, hi)``: offsets on which enough of an item's rarest terms agree."""
    steps = adjusted.select(
        "uid",
        "item_no",
        "need",
        F.inline(
            F.array(
                F.struct(F.col("lo").alias("at"), F.lit(1).alias("step")),
                F.struct((F.col("hi") + 1).alias("at"), F.lit(-1).alias("step")),
            )
        ),
    )
    steps = steps.groupBy("uid", "item_no", "need", "at").agg(F.sum("step").alias("step"))
    along = Window.partitionBy("uid", "item_no").orderBy("at")
    agreed = steps.withColumns(
        {"n": F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0)), "next": F.lead("at").over(along)}
    )
    return agreed.where("n >= need").select("uid", "item_no", F.col("at").alias("lo"), (F.col("next") - 1).alias("hi"))


def proximity_matches(adjusted: DataFrame, slop: int = SLOP) -> DataFrame:
    """``(uid, item_no)`` where two rare terms of an item stand within ``slop`` words of their distance in it."""
    along = Window.partitionBy("uid", "item_no").orderBy("lo", "hi", "place")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    # The farthest end of another anchor's range before this one, from the two best anchors so far.
    best = F.max(F.struct("hi", "place")).over(earlier)
    other = F.max(F.when(F.col("place") != F.col("best.place"), F.col("hi"))).over(earlier)
    rows = adjusted.select("uid", "item_no", "need", "lo", "hi", "place").withColumn("best", best)
    end = F.when(F.col("best.place") != F.col("place"), F.col("best.hi")).otherwise(other)
    near = rows.withColumn("end", end)
    return near.where((F.col("need") == 1) | (F.col("lo") - F.col("end") <= slop)).select("uid", "item_no").distinct()


def matching_runs(doc: np.ndarray, item: np.ndarray, offset: int) -> list[tuple[int, int]]:
    """Document intervals of at least a window's length where document and item agree along ``offset``."""
    a, b = max(0, -offset), min(len(item), len(doc) - offset)
    need = min(WINDOW, len(item))
    if b - a < need:
        return []
    same = np.concatenate(([False], doc[a + offset : b + offset] == item[a:b], [False]))
    edge = np.flatnonzero(same[1:] != same[:-1])
    return [(int(s + a + offset), int(e + a + offset)) for s, e in zip(edge[::2], edge[1::2], strict=True) if e - s >= need]


def confirm(docs: DataFrame, candidates: DataFrame, items: DataFrame) -> DataFrame:
    """``(uid, runs, items)``: hit intervals and matched items of each candidate document.

    ``candidates`` are ``(uid, item_no, lo, hi)``, ``items`` ``(item_no, item, words)``.
    The items' words go to the tasks if they are proven small, else with the candidates.
    """
    size = items.agg(F.sum(F.size("words") * 8 + F.octet_length("item") + 64)).first()[0] or 0
    known: dict[int, tuple[str, np.ndarray]] | None = None
    if size <= BROADCAST_BYTES:
        known = {r["item_no"]: (r["item"], np.array(r["words"], dtype=np.int64)) for r in items.collect()}
        candidates = candidates.withColumns({"item": F.lit(None).cast("string"), "words": F.lit(None).cast("array<bigint>")})
    else:
        candidates = candidates.join(items, "item_no")
    shared = docs.sparkSession.sparkContext.broadcast(known)
    grouped = candidates.groupBy("uid").agg(F.collect_list(F.struct("item_no", "lo", "hi", "item", "words")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            out: list[tuple[str, list, list]] = []
            uids, places = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for uid, place, doc in zip(uids, places, text_words(batch.column(1)), strict=True):
                runs: set[tuple[int, int]] = set()
                hit: set[str] = set()
                for p in place:
                    name, words = items[p["item_no"]] if items is not None else (p["item"], np.array(p["words"], dtype=np.int64))
                    item = words.view(np.uint64)
                    found = [r for offset in range(p["lo"], p["hi"] + 1) for r in matching_runs(doc, item, offset)]
                    if found:
                        runs.update(found)
                        hit.add(name)
                if runs:
                    out.append((uid, [{"s": a, "e": b} for a, b in sorted(runs)], sorted(hit)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([o[0] for o in out], pa.string()),
                        pa.array([o[1] for o in out], pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                        pa.array([o[2] for o in out], pa.list_(pa.string())),
                    ],
                    names=["uid", "runs", "items"],
                )

    text = docs.join(broadcast_if_small(materialize(grouped)), "uid").select("uid", "text", "places")
    return text.mapInArrow(frugal(run), "uid string, runs array<struct<s:bigint,e:bigint>>, items array<string>").dropDuplicates(["uid"])


def covered(runs: Column) -> Column:
    """Words in the union of intervals."""
    return F.aggregate(
        F.array_sort(runs),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("e")),
        lambda a, r: F.struct(
            (a["n"] + F.greatest(F.lit(0), r["e"] - F.greatest(a["e"], r["s"]))).alias("n"),
            F.greatest(a["e"], r["e"]).alias("e"),
        ),
        lambda a: a["n"],
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    proximity: bool = False,
) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, one row per input row.

    Null and wordless texts have no words and are clean; items without words
    match nothing; a null item id counts as the empty string; items with equal
    ids count once; repeated rows and null document ids get their own results;
    texts of any length are read whole by one task; other columns are ignored;
    an empty benchmark leaves everything clean and an empty table gives an
    empty result. With ``proximity`` a column ``n_near`` counts items of which
    two rare terms stand at nearly the right distance.
    """
    ship(docs.sparkSession)
    base = docs.select(
        identity(id_col, text_col).alias("uid"), F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text")
    )
    items = materialize(item_words(benchmark, item_col))
    items = materialize(items.select(F.monotonically_increasing_id().alias("item_no"), "item", "words"))
    vocabulary = materialize(items.select(F.explode("words").alias("term")).distinct())
    frequencies = materialize(collection_frequencies(base, vocabulary))
    anchors = materialize(anchor_runs(items, frequencies))
    index = materialize(build_index(base, materialize(anchors.select("term").distinct())))
    adjusted = adjusted_postings(index, anchors)
    if proximity:
        adjusted = materialize(adjusted)
    every = confirm(base, phrase_candidates(adjusted), items)
    found = every.select("uid", covered(F.col("runs")).alias("n_hit"), "items")
    # One row for each document with a hit, so small beside the documents.
    r = index.select("uid", "doc_id", "n_words").join(broadcast_if_small(materialize(found)), "uid", "left")
    extra = []
    if proximity:
        extra = [F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near")]
        near = proximity_matches(adjusted).join(items.select("item_no", "item"), "item_no").select("uid", "item").distinct()
        r = r.join(near.groupBy("uid").agg(F.count("*").alias("n_near")), "uid", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    listed = F.coalesce(F.array_sort(F.array_distinct("items")), F.array().cast("array<string>"))
    return r.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        *extra,
    )
