"""Vector code compression: each part of a vector as the number of its codebook entry.

Vectors are cut into equal parts and every part position has a codebook of its own, made in
a fixed number of rounds (assign, then average). All numbers are integers, so the result does
not depend on the order of rows or on how they are dealt to tasks.

The nearest entry of a part is found through memoised grid cells. The space of a part is cut
into a grid of boxes; a part's box is hashed, and the memo of a task holds for each box it
has met the entries that can be nearest for some point of it: an entry is left out when its
least distance to the box is above the largest distance of another one. Only what the memo
leaves is evaluated exactly, whatever it holds: a full memo starts anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.functions.vectors import is_finite
from reelrank.llm.words import mix
from reelrank.sources.durable import durable

#: Components are multiplied by this and rounded down.
SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Width of a grid cell in every direction, in scaled units.
CELL = 16
#: Cells in the memo of one part before it starts anew: 2 MB of flags.
MEMO_CELLS = 1 << 15
#: Scaled components are held within this, so that the squared distances fit in a long.
LIMIT = 1 << 26
#: Vectors that are assigned at once.
TILE_ROWS = 2_048


class CellMemo:
    """Nearest entries of one codebook (``entries``: k x width), by way of grid cells."""

    def __init__(self, entries: np.ndarray, cell: int = CELL, limit: int = MEMO_CELLS):
        self.entries, self.cell, self.limit = entries, cell, limit
        #: Distances evaluated exactly, and boxes whose entries were worked out.
        self.evaluated = self.built = 0
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.boxes = np.zeros((0, self.entries.shape[1]), dtype=np.int64)
        self.kept = np.zeros((0, len(self.entries)), dtype=bool)

    def _undominated(self, boxes: np.ndarray) -> np.ndarray:
        """For each box, the entries that no other entry is nearer than everywhere in it."""
        low = (boxes * self.cell)[:, None, :]
        high = low + (self.cell - 1)
        gap = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
        reach = np.maximum(np.abs(self.entries - low), np.abs(self.entries - high))
        least, most = (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)
        return least <= most.min(axis=1)[:, None]

    def _candidates(self, boxes: np.ndarray) -> np.ndarray:
        """Flags of the entries to evaluate, for each row of ``boxes``."""
        key = np.zeros(len(boxes), dtype=np.uint64)
        for column in boxes.T:
            key = mix(key ^ mix(column.astype(np.uint64)))
        distinct, first, number = np.unique(key, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        if not known.all():
            if len(self.keys) + int((~known).sum()) > self.limit:
                self._clear()
                known[:] = False
            fresh = boxes[first[~known]]
            self.built += len(fresh)
            keys = np.concatenate([self.keys, distinct[~known]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.boxes = np.concatenate([self.boxes, fresh])[order]
            self.kept = np.concatenate([self.kept, self._undominated(fresh)])[order]
            place = np.searchsorted(self.keys, distinct)
        at = place[number]
        # A box that shares its hash with another one is evaluated against all entries.
        return self.kept[at] | (self.boxes[at] != boxes).any(axis=1)[:, None]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry (ties: the lower one) and its squared distance."""
        if len(points) == 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        row, entry = np.nonzero(self._candidates(points // self.cell))
        self.evaluated += len(row)
        gap = points[row] - self.entries[entry]
        distance = (gap * gap).sum(axis=1)
        starts = np.searchsorted(row, np.arange(len(points)))
        least = np.minimum.reduceat(distance, starts)
        hits = np.flatnonzero(distance == least[row])
        first = hits[np.unique(row[hits], return_index=True)[1]]
        return entry[first], least


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of longs as rows of ``width``, zeros behind the shorter ones."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _assigned(
    batches: Iterator[pa.RecordBatch], codebooks: np.ndarray
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows with their parts (rows x parts x width), entries and squared distances."""
    parts, _, width = codebooks.shape
    memos = [CellMemo(entries) for entries in codebooks]
    for batch in batches:
        for start in range(0, batch.num_rows, TILE_ROWS):
            rows = batch.slice(start, TILE_ROWS)
            points = _matrix(rows.column("v"), parts * width).reshape(-1, parts, width)
            found = [memo.nearest(points[:, p]) for p, memo in enumerate(memos)]
            yield (
                rows,
                points,
                np.stack([entry for entry, _ in found], axis=1),
                np.stack([distance for _, distance in found], axis=1),
            )


def _averaged(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks with every used entry replaced by the average of its parts."""
    parts, entries, width = codebooks.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width), dtype=np.int64)
        count = np.zeros(parts * entries, dtype=np.int64)
        offset = np.arange(parts) * entries
        for _, points, entry, _ in _assigned(batches, codebooks):
            slot = (entry + offset).ravel()
            count += np.bincount(slot, minlength=len(count))
            np.add.at(total, slot, points.reshape(-1, width))
        slot = np.flatnonzero(count)
        place = np.tile(np.arange(width), len(slot))
        yield pa.record_batch(
            [
                pa.array(np.repeat(slot, width), pa.int32()),
                pa.array(place, pa.int32()),
                pa.array(np.repeat(count[slot], width)),
                pa.array(total[slot].ravel()),
            ],
            names=["slot", "place", "n", "total"],
        )

    # At most parts x entries x width rows come to the driver, whatever the table's size.
    sums_of = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    rows = (
        vectors.mapInArrow(sums, "slot int, place int, n long, total long")
        .groupBy("slot", "place")
        .agg(F.sum("n").alias("n"), sums_of)
        .collect()
    )
    out = codebooks.copy()
    for row in rows:
        out[row.slot // entries, row.slot % entries, row.place] = int(row.total) // row.n
    return out


def scaled(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, v array<long>)`` of the rows whose vectors are whole and finite."""

    def whole(x):
        return F.floor(F.greatest(F.least(x * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT))))

    kept = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    return kept.filter(is_finite(F.col("e"))).select(
        "vec_id", "label", F.transform("e", whole).alias("v")
    )


def codebooks(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> np.ndarray | None:
    """The codebooks (parts x entries x width) of :func:`scaled` vectors; None without any.

    The driver holds them and the vectors they start from, a few thousand numbers.
    """
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    if not first:
        return None
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    width = max(1, -(-longest // parts))
    start = _matrix(pa.array([row.v for row in first], pa.list_(pa.int64())), parts * width)
    books = np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _averaged(vectors, books)
    return books


def digest(books: np.ndarray) -> str:
    """Hex digest of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _coded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, entry, distance in _assigned(batches, books):
            code = [bytes(row).hex() for row in entry.astype(np.uint8)]
            yield pa.record_batch(
                [rows.column("vec_id"), rows.column("label"), pa.array(code, pa.string()),
                 pa.array(distance.sum(axis=1))],
                names=["vec_id", "label", "code", "error"],
            )

    fields = [vectors.schema["vec_id"], vectors.schema["label"]]
    fields += [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    return vectors.mapInArrow(run, T.StructType(fields))


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray | None]:
    """``(vec_id, label, code, error)`` of every usable vector, and the codebooks.

    ``vectors`` is ``(vec_id, label, embedding)``; other columns are ignored. It is read
    once per round and three times more. A vector that is null or holds null or
    non-finite components is dropped. Components become ``floor(256 * x)``; ``code`` has two
    hex digits a part (``entries`` is at most 256), ``error`` is the squared distance to the
    entries. With fewer vectors than entries every vector starts an entry; rows with one
    ``vec_id`` are vectors of their own and start entries in the order of their components;
    null ids come last. Vectors of unlike lengths count as filled up with zeros, to a
    multiple of ``parts``. Scaled components are held within 2**26 on either side. An empty
    table gives an empty result.
    """
    usable = scaled(vectors)
    books = codebooks(usable, parts, entries, rounds)
    if books is None:
        empty = usable.select("vec_id", "label", F.lit("").alias("code"))
        return empty.withColumn("error", F.lit(0).cast("long")).filter(F.lit(False)), None
    return _coded(usable, books), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the error summed over equal labels, nulls together.

    ``coded`` is read twice, so pass a stored table. Errors are summed before the shuffle,
    so a label that holds most rows is no heavier than others.
    """
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    same = F.col("label").eqNullSafe(F.col("_label"))
    return coded.join(sums, same).drop("_label")


def report(vectors: DataFrame) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of :func:`compress`."""
    coded, books = compress(vectors)
    named = F.lit("" if books is None else digest(books)).alias("codebooks_sha256")
    return with_label_errors(durable(coded, "codes")).select(
        "vec_id", "code", "error", "label_error", named
    )
