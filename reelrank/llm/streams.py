"""Groups of rows read from partitions that are sorted by their key, batch by batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that end where the ``key`` changes, from batches sorted by it.

    Memory holds one batch and the group that reaches across its end.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut == 0 and held and held[-1].column(key)[-1].as_py() == keys[0]:
            held.append(batch)
            continue
        if cut == 0:
            if held:
                yield pa.Table.from_batches(held)
            held = [batch]
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(keys: np.ndarray) -> np.ndarray:
    """Places where sorted ``keys`` change, with both ends."""
    if len(keys) == 0:
        return np.zeros(1, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
