"""HyperMinHash sketches: leading-zero counts plus mantissa bits per bucket.

A shingle hash's top bits name its bucket; the smallest remaining value of
each bucket is kept as a 6-bit leading-zero count and a 10-bit mantissa, 16
bits in all. Empty buckets borrow from the first filled bucket of a fixed
random order of their own, which keeps every register's match probability at
the Jaccard similarity. Four registers pack into one 64-bit band key, so the
``BANDS`` keys of a text are its whole sketch.
"""

from __future__ import annotations

import numpy as np

from navspark.llm.textops import mix64

_U = np.uint64
BUCKET_BITS = 7
REGISTERS = 1 << BUCKET_BITS
ROWS = 4
BANDS = REGISTERS // ROWS
MANTISSA_BITS = 10
_WORD_BITS = 64 - BUCKET_BITS

_order = np.argsort(
    mix64(np.arange(REGISTERS * REGISTERS, dtype=_U) + _U(0x5851F42D4C957F2D)).reshape(REGISTERS, REGISTERS), axis=1
)
_RANK = np.argsort(_order, axis=1).astype(np.int16)


def compress(value: np.ndarray) -> np.ndarray:
    """(leading zeros, mantissa) of left-aligned bucket minima as 16 bits."""
    v = value.astype(_U)
    # A float holds the exponent exactly once the low bits can't round it up.
    top = np.where(v > _U(0), v & ~(v >> _U(53)), _U(1))
    exponent = np.frexp(top.astype(np.float64))[1].astype(np.int64) - 1
    zeros = np.where(v > _U(0), 63 - exponent, 63).astype(_U)
    zeros = np.minimum(zeros, _U(63))
    shifted = np.where(zeros < _U(63), v << np.minimum(zeros + _U(1), _U(63)), _U(0))
    return (zeros << _U(MANTISSA_BITS) | shifted >> _U(64 - MANTISSA_BITS)).astype(np.uint16)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The registers of one text from its sorted distinct shingle hashes (not empty)."""
    bucket = (hashes >> _U(_WORD_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    filled = bucket[first]
    out = np.zeros(REGISTERS, dtype=np.uint16)
    out[filled] = compress(hashes[first] << _U(BUCKET_BITS))
    if len(filled) < REGISTERS:
        empty = np.setdiff1d(np.arange(REGISTERS), filled, assume_unique=True)
        out[empty] = out[filled[np.argmin(_RANK[np.ix_(empty, filled)], axis=1)]]
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """Four registers to a signed 64-bit key, without loss."""
    return np.ascontiguousarray(registers).view(np.int64)


def registers_of(keys: np.ndarray) -> np.ndarray:
    """The registers behind rows of band keys."""
    return np.ascontiguousarray(keys, dtype=np.int64).view(np.uint16).reshape(len(keys), REGISTERS)


def accidental_matches(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected share of registers of disjoint sets of ``n`` and ``m`` items that match by chance."""
    ratio = np.minimum(n, m) / np.maximum(np.maximum(n, m), 1)
    return 0.16991948715973909 * 2.0**-MANTISSA_BITS * 4 * ratio / (1 + ratio) ** 2


def estimate(same: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimate from the number of equal registers."""
    by_chance = accidental_matches(n, m)
    return (same / REGISTERS - by_chance) / (1 - by_chance)
