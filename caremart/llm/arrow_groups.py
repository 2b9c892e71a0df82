"""Groups of rows in Arrow batches that arrive sorted by a key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


#: Rows that a worker turns into Python objects at a time, whatever the session's batch size.
ROWS = 200


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``ROWS`` rows, without a copy; an empty one stays one."""
    for batch in batches:
        for start in range(0, max(batch.num_rows, 1), ROWS):
            yield batch.slice(start, ROWS)


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Runs of equal integer keys, each whole; what is open at a batch's end is carried on."""
    open_: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        ends = [*cuts.tolist(), len(keys)]
        start = 0
        for end in ends:
            if open_ and keys[start] != last:
                yield _joined(open_)
                open_ = []
            open_.append(batch.slice(start, end - start))
            last = keys[start]
            start = end
    if open_:
        yield _joined(open_)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def spanning_roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``count`` nodes the smallest node that the pairs ``(a, b)`` connect it with."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
