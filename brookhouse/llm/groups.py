"""Groups of rows that lie next to each other in a sorted partition, read from Arrow batches one group at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal values in the whole-number columns `keys`; only one group is held besides a batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(key).to_numpy(zero_copy_only=False).astype(np.int64) for key in keys])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        begins = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(begins[:-1], begins[1:], strict=True):
            own = tuple(values[:, a])
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = own
    if held:
        yield pa.Table.from_batches(held)
