"""Products of two sets of vectors, laid out as a grid of tasks.

Each set is cut into groups by a hash of the id. A task owns one cell, a pair of groups,
and receives exactly the rows of the two; every row is sent once per cell of its row or
column of the grid. With ``g`` groups a row travels ``g`` times, so the groups are as
large as a task's memory and the wanted parallelism allow.

The first group of a cell is held as one matrix, the second streams past it in Arrow
batches, so a task's memory is bounded by the group size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Groups below this size cost more to schedule than to multiply.
MIN_GROUP_ROWS = 512

# Partitions of a grid, whatever its number of cells: what one driver schedules with ease.
MAX_PARTITIONS = 20_000

HELD, PASSING = 0, 1


def group_of(key: str, groups: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(groups).cast("long")).cast("int")


def groups_for(rows: int, group_rows: int, wanted: int) -> int:
    """At least enough groups for ``group_rows``, up to ``wanted`` if they stay sizeable."""
    needed = math.ceil(rows / group_rows)
    return max(1, needed, min(wanted, rows // MIN_GROUP_ROWS))


def place(rows: DataFrame, cells: int, *order: str) -> DataFrame:
    """Rows ``(cell, side, id, vec)`` sorted by cell, held rows first, then by ``order``.

    A cell has a partition of its own up to ``MAX_PARTITIONS``; beyond, a partition takes
    several cells, one after the other.
    """
    partitions = min(cells, MAX_PARTITIONS)
    place = F.pmod(F.col("cell"), F.lit(partitions)).cast("int")
    return rows.repartitionById(partitions, place).sortWithinPartitions("cell", "side", *order)


def read_cells(
    batches: Iterator[pa.RecordBatch],
    *also: str,
    carry: str | None = None,
) -> Iterator[tuple]:
    """``(cell, side, ids, matrix)`` runs of equal cell and side, in order of arrival; the
    matrix is in the precision of the vectors.

    A run also ends where a column of ``also`` changes. With ``carry`` each has the rows'
    values of that column as a fifth part.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cell = batch.column("cell").to_numpy(zero_copy_only=False)
        side = batch.column("side").to_numpy(zero_copy_only=False)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        vectors = batch.column("vec")
        width = len(vectors[0])
        matrix = vectors.flatten().to_numpy(zero_copy_only=False)
        if matrix.size != width * batch.num_rows:
            raise ValueError("vectors of different lengths")
        matrix = matrix.reshape(batch.num_rows, width)
        change = (np.diff(cell) != 0) | (np.diff(side) != 0)
        for name in also:
            change |= np.diff(batch.column(name).to_numpy(zero_copy_only=False)) != 0
        cuts = np.flatnonzero(change) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for start, stop in zip(bounds, bounds[1:]):
            run = int(cell[start]), int(side[start]), ids[start:stop], matrix[start:stop]
            yield run if carry is None else (*run, batch.column(carry).slice(start, stop - start))
