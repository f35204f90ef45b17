"""Groups of rows from sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal first columns, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(n).to_numpy() for n in range(n_keys)])
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            this = tuple(keys[begin].tolist())
            if held and this != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = this
            held.append(batch.slice(begin, end - begin))
    if held:
        yield key, pa.Table.from_batches(held)
