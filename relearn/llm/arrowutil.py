"""Helpers for mapInArrow functions: building batches and walking sorted groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes per output batch, about.
BATCH_BYTES = 8 << 20


def as_long(x: np.ndarray) -> pa.Array:
    """uint64 hashes as a bigint column (the same bits)."""
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def hashes(column: pa.Array) -> np.ndarray:
    """A bigint column without nulls as uint64 hashes."""
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def binary_rows(matrix: np.ndarray) -> pa.Array:
    """Every row of a matrix as one binary value."""
    raw = np.ascontiguousarray(matrix)
    width = raw.dtype.itemsize * raw.shape[1]
    offsets = np.arange(len(raw) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).cast(pa.binary())


def matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Binary values of one length as a matrix."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[o[0]:o[-1]].view(dtype).reshape(len(column), width)


def binary_list(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups (rows with one key, sorted by it) and each group's first row, one more at the end.

    Only the last group of a table may go on in the next batch, so it is held back; memory is a batch and a group.
    """
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        keys = table[key].combine_chunks().to_numpy(zero_copy_only=False)
        at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        rest = table.slice(at[-1])
        if at[-1]:
            yield table.slice(0, at[-1]), at
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])
