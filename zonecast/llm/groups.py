"""Reading sorted Arrow batches group by group inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def by_group(batches, key: str, at_least: int = 1) -> Iterator[pa.Table]:
    """Tables that hold whole groups of equal ``key`` (a non-null integer) from batches sorted by it.

    A table is yielded as soon as it has ``at_least`` rows and its last group is complete.
    """
    rest: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        k = column(batch, key).to_numpy()
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        if rest and column(rest[-1], key)[-1].as_py() != k[0]:
            cuts = np.r_[0, cuts]
        lo = 0
        for cut in cuts:
            if rows + cut - lo >= at_least:
                rest.append(batch.slice(lo, cut - lo))
                yield pa.Table.from_batches(rest)
                rest, rows, lo = [], 0, int(cut)
        rest.append(batch.slice(lo))
        rows += batch.num_rows - lo
    if rest:
        yield pa.Table.from_batches(rest)


def binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """An Arrow binary column cut from ``data``."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def lists(lengths: np.ndarray, values: pa.Array) -> pa.Array:
    """An Arrow list column cut from ``values``."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
