"""Streaming over groups of rows that a repartition and a sort have put together."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa


def consecutive_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of consecutive rows with the same ``key`` (a bigint column, not null).

    Holds one group at a time, whatever the batches' borders.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def list_values(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(values, offsets)`` of a list column without nulls."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = pa.concat_arrays(a.chunks)
    offsets = a.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    values = a.values.to_numpy(zero_copy_only=False)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, giving memory back to the system when its task ends: Python workers
    are kept for later tasks and would hold what the largest batch took."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped
