"""Vectorised text helpers for Arrow batches: words, word hashes, character n-grams.

Everything works on whole columns of UTF-8 bytes with numpy, in slices of
about ``SLICE_BYTES`` so that memory stays bounded whatever the batch; a single
text longer than that is its own slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = True
ALPHANUMERIC[0x80:] = True

def utf8_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, bytes, offsets)`` slices of a string column.

    ``offsets`` has one entry more than the slice has rows and starts at 0.
    Null texts are empty.
    """
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    if column.null_count:
        lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), lengths, 0)
    first = 0
    while first < n:
        ends = np.cumsum(lengths[first : first + 65536])
        last = first + max(1, int(np.searchsorted(ends, limit, side="right")))
        size = lengths[first:last]
        local = np.concatenate(([0], np.cumsum(size)))
        if int(offsets[last] - offsets[first]) == int(local[-1]):
            chunk = data[offsets[first] : offsets[last]]
        else:  # nulls that hold bytes
            chunk = np.concatenate([data[offsets[i] : offsets[i] + lengths[i]] for i in range(first, last)])
        yield first, last, chunk, local
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and each text's offset into the words."""
    if not len(data):
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(offsets), dtype=np.int64)
    w = word_bytes[data]
    begin = w.copy()
    begin[1:] &= ~w[:-1]
    end = w.copy()
    end[:-1] &= ~w[1:]
    filled = offsets[:-1][np.diff(offsets) > 0]
    begin[filled] = w[filled]
    closed = offsets[1:][np.diff(offsets) > 0] - 1
    end[closed] = w[closed]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


#: Words of more bytes than this are hashed one by one.
LONG_WORD = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each lower-cased (A-Z) word, from its bytes alone.

    Eight bytes at a time go through :func:`mix64` together with the state so
    far, so no pattern of letters cancels out; words of at most eight bytes
    never collide with words of their length. Long words get a cryptographic
    hash. Which of the two is taken depends on the word's own length only.
    """
    lengths = ends - starts
    out = mix64(lengths.astype(_U) * _U(0xA24BAED4963EE407))
    if not len(starts):
        return out
    low = int(starts[0])
    lowered = np.zeros(int(ends[-1]) - low + 8, dtype=np.uint8)
    np.take(LOWER, data[low : int(ends[-1])], out=lowered[:-8])
    # The eight bytes that begin at any place.
    eight = np.ndarray((len(lowered) - 7,), "<u8", lowered.data, 0, (1,))
    rows = np.flatnonzero(lengths <= LONG_WORD)
    at, left = starts[rows] - low, lengths[rows]
    while len(rows):
        piece = eight[at]
        last = left < 8
        piece[last] &= (_U(1) << (left[last].astype(_U) * _U(8))) - _U(1)
        out[rows] = mix64(out[rows] ^ piece)
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(lengths > LONG_WORD):
        word = lowered[starts[i] - low : ends[i] - low]
        out[i] = int.from_bytes(hashlib.blake2b(word.tobytes(), digest_size=8).digest(), "little")
    return out


_SHINGLE = _U(0xC2B2AE3D27D4EB4F)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of one text.

    Fewer words, but not none, make one shingle of the whole sequence.
    """
    n = min(size, len(words))
    if not n:
        return np.zeros(0, dtype=_U)
    h = np.zeros(len(words) - n + 1, dtype=_U)
    for k in range(n):
        h *= _SHINGLE
        h += words[k : len(words) - n + 1 + k]
    return np.unique(mix64(h + _U(n)))


def code_points(text: str) -> np.ndarray:
    """The text's code points."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
