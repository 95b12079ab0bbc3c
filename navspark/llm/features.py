"""Hashed character n-grams of texts, their document frequencies, and hash-chosen samples."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navspark.llm.packing import quoted
from navspark.llm.textops import code_points
from navspark.plans.materialize import broadcast_if_small, materialize

PIECE = 1 << 20
ORDERS = (1, 2, 3)
_PRIMES = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        n = sys.maxunicode + 1
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(n)), dtype=bool, count=n))
    return _letters[0]


def is_letter(points: np.ndarray) -> np.ndarray:
    return letter_table()[points]


def letters_only(text: str) -> np.ndarray:
    """Lower-cased code points with every run of non-letters as one space."""
    p = code_points(text.lower())
    ok = is_letter(p)
    keep = ok.copy()
    keep[1:] |= ok[:-1]
    return np.where(ok, p, np.uint32(32))[keep]


def ngram_counts(points: np.ndarray, size: int) -> np.ndarray:
    """Counts of hashed 1-, 2- and 3-grams, in pieces so that long texts stay cheap."""
    out = np.zeros(size, dtype=np.float32)
    shift = np.uint32(32 - (size.bit_length() - 1))
    for a in range(0, len(points), PIECE):
        p = points[a : a + PIECE + max(ORDERS) - 1].astype(np.uint32)
        for n in ORDERS:
            m = min(len(p) - n + 1, PIECE)
            if m <= 0:
                continue
            h = np.full(m, np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF))
            for k in range(n):
                h = (h ^ p[k : k + m]) * _PRIMES[k]
                h ^= h >> np.uint32(15)
            out += np.bincount((h * np.uint32(0x2C1B3C6D)) >> shift, minlength=size).astype(np.float32)
    return out


def document_frequencies(df: DataFrame, counts_of: Callable[[str], np.ndarray], size: int) -> tuple[np.ndarray, int]:
    """``(documents per feature, documents)`` over every non-null text of the one-column ``df``.

    Each task adds up its own texts; only ``size`` sums reach the driver.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    total[:size] += counts_of(text.as_py()) > 0
                    total[size] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["f", "n"])

    rows = df.mapInArrow(partial, "f bigint, n bigint").groupBy("f").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size + 1, dtype=np.int64)
    for r in rows:
        out[r["f"]] = r["n"]
    return out[:size], int(out[size])


def inverse_frequencies(df: np.ndarray, n: int) -> np.ndarray:
    return (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)


def row_hash(*columns: str) -> Column:
    """A non-negative 62-bit hash of a row's columns."""
    return F.xxhash64(F.lit(7), *columns).bitwiseAND(F.lit((1 << 62) - 1))


def below(rate: Column | float, h: Column) -> Column:
    """Whether a row's hash falls into a sample of the given rate."""
    return h < (F.lit(rate) if isinstance(rate, float) else rate) * F.lit(float(1 << 62))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, learn: Column, label: Column, label_col: str, size: int, id_col: str, text_col: str
) -> DataFrame:
    """``(text, h, label)``: about ``size`` distinct labelled rows, hash-chosen.

    ``label`` aggregates an id's labels; null labels and ids, and ids where
    ``learn`` does not hold, are left out. The bound is on rows, not on ids: an
    id with very many texts gives no more of them than their share.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(learn)
    known = materialize(known.groupBy(F.col(id_col).alias("known_id")).agg(label.alias("label")))
    rows = docs.select(
        F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"), row_hash(quoted(id_col), quoted(text_col)).alias("h")
    )
    labelled = rows.join(broadcast_if_small(known), F.col("id") == F.col("known_id"))
    n = labelled.agg(F.approx_count_distinct("h")).first()[0]
    return labelled.where(below(min(1.0, size / max(n, 1)), F.col("h"))).select("text", "h", "label").dropDuplicates(["h"])
