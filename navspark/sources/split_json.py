"""Reading one large JSON document with many tasks.

Spark's multi-line JSON reader parses a document in one task, however large.
Here documents are read as text whose records end at ``}``, which the text
source splits at any byte, and the objects of the document's one large array
are parsed one by one. What is left to do is to know which ``}`` ends what:

* A ``}`` inside a string ends a record but no object. A record with an odd
  number of quotes leaves or enters a string there. One pass counts such
  records for each file split; a running parity over the splits of a file says
  in which state each split starts. Only the splits that hold such records, or
  start inside a string, are put back together (a window over that split's rows).
* Structure is judged on a record's *skeleton*, the record without its strings:
  whether it opens the array's first element, another one, or another object
  of the document.
* A document that does not have the expected form (objects inside elements,
  several arrays of objects, a missing end, bytes that are no text, a
  compressed file) is *irregular*. It is left out here and named, so that the
  caller reads it with the ordinary reader, whole, in one task.

So regular documents of any size give exactly the elements that the ordinary
reader gives, and irregular ones are read by that reader itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navspark.plans.materialize import broadcast_if_small, materialize

# One JSON string, and an object without objects in it that ends the text
# (possessive, so that the work is linear in the text).
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_LAST_OBJECT = r'\{[^{}"]*+(?:' + _STRING + r'[^{}"]*+)*+\z'


# Patterns over skeletons, in which a string is one quote (one that equals the
# layout's key stands before its quote): values, pairs, an object's text up to
# its end. Anything looser than JSON proper matches none of them.
_S = r'(?:"\w+")?"\s*'
_V = r"(?:" + _S + r"|-?\d++(?:\.\d++)?(?:[eE][+-]?\d++)?\s*|true\s*|false\s*|null\s*|\[[^{}\[\]:]*\]\s*)"
_PAIR = _S + r":\s*" + _V
_OBJECT = r"\{\s*(?:" + _PAIR + r"(?:,\s*" + _PAIR + r")*+)?\z"
_AND_PAIRS = r"(?:,\s*" + _PAIR + r")*"


@dataclass(frozen=True)
class Layout:
    """Form of a document, in patterns over skeletons.

    ``key``: the array's key (None: the document is the array). ``first`` and
    ``next`` match a record that ends an element of the array, ``others``
    records without one, ``root`` the record that opens the document.
    """

    key: str | None
    root: str
    first: str
    next: str
    others: str


_DATA = r'"data""\s*:\s*\[\s*' + _OBJECT
#: ``{…, "data": [{…}, {…}, …], …}`` with at most flat objects beside ``data``.
PAYLOAD = Layout(
    key="data",
    root=r"^\s*\{",
    first=r"^\s*\{\s*(?:" + _PAIR + r",\s*)*" + _DATA + r"|^\s*\]?\s*" + _AND_PAIRS + r",\s*" + _DATA,
    next=r"^\s*,\s*" + _OBJECT,
    others="|".join([
        r"^\s*" + _OBJECT,
        r"^\s*\{\s*(?:" + _PAIR + r",\s*)*" + _S + r":\s*" + _OBJECT,
        r"^\s*\]?\s*" + _AND_PAIRS + r",\s*" + _S + r":\s*" + _OBJECT,
        r"^\s*\]?\s*" + _AND_PAIRS + r"\z",
    ]),
)
#: ``[{…}, {…}, …]``
CATALOGUE = Layout(
    key=None,
    root=r"^\s*\[",
    first=r"^\s*\[\s*" + _OBJECT,
    next=r"^\s*,\s*" + _OBJECT,
    others=r"^\s*\]?\s*\z",
)


def _skeleton(value: Column, key: str | None) -> Column:
    """``value`` with a single quote mark for each string; before it stands ``key`` if that is the string."""
    if key is None:
        return F.regexp_replace(value, _STRING, '"')
    return F.regexp_replace(value, f'("{key}")|{_STRING}', '$1"')


def _odd(value: Column) -> Column:
    """1 if ``value`` has an odd number of quotes that are not escaped."""
    plain = F.when(F.contains(value, F.lit("\\")), F.regexp_replace(value, r"\\.", "")).otherwise(value)
    return F.length(F.regexp_replace(plain, r'[^"]+', "")) % 2


def _facts(value: Column, layout: Layout) -> list[Column]:
    """What a whole record (no string open at either end) says about its document."""
    sk = _skeleton(value, layout.key)
    first, following = sk.rlike(layout.first), sk.rlike(layout.next)
    return [
        F.count(F.lit(1)).alias("records"),
        F.sum(F.length(sk) - F.length(F.replace(sk, F.lit("{"), F.lit("")))).alias("opened"),
        F.count_if(sk.rlike(layout.root)).alias("roots"),
        F.count_if(first).alias("firsts"),
        F.count_if(following).alias("others"),
        F.count_if(sk.rlike(r"^\s*\]")).alias("closed"),
        F.count_if(~(first | following | sk.rlike(layout.others))).alias("strange"),
    ]


def _stitched(pieces: DataFrame, hurt: DataFrame, extra: list[str]) -> DataFrame:
    """Whole records of the splits in ``hurt`` (``file, block, start``): those
    that a ``}`` inside a string cut are joined, also across splits."""
    rows = pieces.join(broadcast_if_small(hurt), ["file", "block"])
    here = Window.partitionBy("file", "block").orderBy("seq")
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("inside", (F.col("start") + F.sum("odd").over(so_far) - F.col("odd")) % 2)
    # A record that starts outside strings begins a whole one.
    rows = materialize(rows.withColumn("n", F.sum(1 - F.col("inside")).over(so_far)))
    begun = rows.groupBy("file", "block").agg(F.sum(1 - F.col("inside")).alias("begun"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = materialize(begun.withColumn("before", F.coalesce(F.sum("begun").over(earlier), F.lit(0))).drop("begun"))
    rows = rows.join(broadcast_if_small(begun), ["file", "block"])
    parts = F.array_sort(F.collect_list(F.struct("block", "seq", "value")))
    return rows.groupBy("file", (F.col("before") + F.col("n")).alias("n")).agg(
        F.array_join(F.transform(parts, lambda x: x["value"]), "}").alias("value"),
        *[F.first(c).alias(c) for c in extra],
    )


def split_elements(
    spark: SparkSession, text: DataFrame, layout: Layout, element: T.StructType, extra: list[str]
) -> tuple[DataFrame, DataFrame]:
    """``(elements, irregular)`` of documents read as text with ``lineSep="}"``.

    ``text`` has ``value``, ``extra`` columns constant in a file, and the file
    source's hidden ``_metadata``. ``elements``: ``extra`` and the parsed
    ``element`` as ``item``; ``irregular``: ``file``, the documents left out.
    Two passes over the text: one counts, one parses.
    """
    pieces = text.select(
        "value",
        *extra,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    ).withColumn("odd", _odd(F.col("value")))
    splits = pieces.groupBy("file", "block").agg(
        F.max("size").alias("size"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.sum("odd").alias("odds"),
        *_facts(F.col("value"), layout),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialize(splits.withColumn("start", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2))
    cut = (F.col("odds") > 0) | (F.col("start") == 1)
    hurt = materialize(splits.where(cut).select("file", "block", "start"))
    any_hurt = not hurt.isEmpty()

    totals = splits.groupBy("file").agg(F.max("size").alias("size"), F.sum("bytes").alias("bytes"), F.sum("odds").alias("odds"))
    names = ["records", "opened", "roots", "firsts", "others", "closed", "strange"]
    facts = splits.where(~cut).select("file", *names)
    if any_hurt:
        joined = materialize(_stitched(pieces, hurt, extra))
        facts = facts.unionByName(joined.groupBy("file").agg(*_facts(F.col("value"), layout)))
    facts = facts.groupBy("file").agg(*[F.sum(c).alias(c) for c in names]).join(totals, "file")
    # An unended last record has no ``}``; all others end an object, and all objects end.
    unended = F.col("bytes") - F.col("size")
    regular = (
        unended.isin(0, 1)
        & (F.col("odds") % 2 == 0)
        & (F.col("opened") == F.col("records") - unended)
        & (F.col("roots") == 1)
        & (F.col("firsts") <= 1)
        & (F.col("closed") == F.col("firsts"))
        & ((F.col("others") == 0) | (F.col("firsts") == 1))
        & (F.col("strange") == 0)
    )
    irregular = materialize(facts.where(~F.coalesce(regular, F.lit(False))).select("file"))

    whole = pieces
    if any_hurt:
        whole = pieces.join(broadcast_if_small(hurt.select("file", "block")), ["file", "block"], "left_anti")
    whole = whole.select("file", "value", *extra)
    if any_hurt:
        whole = whole.unionByName(joined.select("file", "value", *extra))
    if not irregular.isEmpty():
        whole = whole.join(broadcast_if_small(irregular), "file", "left_anti")
    sk = _skeleton(F.col("value"), layout.key)
    elements = whole.where(sk.rlike(layout.first) | sk.rlike(layout.next)).select(
        *extra, F.from_json(F.concat(F.regexp_extract("value", _LAST_OBJECT, 0), F.lit("}")), element).alias("item")
    )
    return elements, irregular


# Up to so many irregular documents are read by their paths, more by a scan of all.
MAX_PATHS = 10_000


def named_files(
    files: DataFrame, read_at: Callable[[list[str]], DataFrame], read_all: Callable[[], DataFrame]
) -> DataFrame | None:
    """The documents of the stored table ``files`` (``file``), None if it is empty."""
    paths = [r["file"] for r in files.limit(MAX_PATHS + 1).collect()]
    if not paths:
        return None
    if len(paths) <= MAX_PATHS:
        # Metadata paths are URL-encoded; a reader takes globs.
        return read_at(["".join(f"\\{c}" if c in "{}[]*?\\" else c for c in unquote(p)) for p in paths])
    docs = read_all()
    return docs.join(files, F.col("_metadata.file_path") == files["file"], "left_semi")
