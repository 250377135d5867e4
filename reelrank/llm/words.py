"""Words of many texts at once, as numpy arrays, and native expressions for the same words.

A word is a run of bytes other than space and ``\\x09``-``\\x0D``, as in
``[^\\x20\\x09-\\x0D]+``. UTF-8 never uses these bytes inside a character, so bytes can be
cut where characters would be. Word hashes are 64-bit polynomials over the bytes, mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: White space between words, for Java's regular expressions and for ``translate``.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\f\r"
#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_LENGTH = np.uint64(0xA0761D6478BD642F)


#: Bytes of a batch that goes to a Python worker, which holds it whole with what it makes.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Have texts sent to Python workers in batches of ``size`` bytes, or one text.

    A setting of the session: the default is eight times as large, and a task holds a batch
    several times over on its way.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def split_words(text: Column) -> Column:
    """The words of ``text`` as an array; null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_RUN, -1)
    return F.filter(parts, lambda word: word != "")


def word_count(text: Column) -> Column:
    """Number of words of ``text``; null text has none."""
    count = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))
    return F.coalesce(count, F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def _inverse(x: np.uint64) -> np.uint64:
    """The odd number that multiplies ``x`` to 1 modulo 2**64."""
    return np.uint64(pow(int(x), -1, 1 << 64))


def _times(x: np.uint64, y: np.uint64) -> np.uint64:
    return np.uint64((int(x) * int(y)) & 0xFFFFFFFFFFFFFFFF)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_STEP ** i`` and its inverse for i up to ``n``."""
    if len(_POWERS.get("up", ())) <= n:
        size = 1 << int(n + 1).bit_length()
        for name, base in (("up", _STEP), ("down", _inverse(_STEP))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` (64-bit numbers) for each span; equal content, equal hash."""
    up, down = powers(len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    inside = (sums[ends] - sums[starts]) * down[starts]
    return mix(inside + (ends - starts).astype(np.uint64) * _LENGTH)


@dataclass
class Words:
    """Words of consecutive texts: ``of[i]`` to ``of[i + 1]`` are those of text ``i``."""

    first: int  # row of the first text within its batch
    data: np.ndarray  # bytes of all the texts
    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray
    hashes: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.of) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    def text_of(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(self.texts), self.counts)

    def spaced(self, keep: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The words numbered ``keep``, ascending, each with one space after it, and the
        places where they begin there, with the end of all."""
        starts, ends = self.starts[keep], self.ends[keep]
        places = np.concatenate(([0], np.cumsum(ends - starts + 1)))
        edge = np.zeros(len(self.data) + 1, dtype=np.int8)
        edge[starts] = 1
        edge[ends] -= 1
        solid = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
        out = np.full(places[-1], 32, dtype=np.uint8)
        inside = np.ones(places[-1], dtype=bool)
        inside[places[1:] - 1] = False
        out[inside] = self.data[solid]
        return out.tobytes(), places


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 places that bound its texts (null: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    _, places, data = column.buffers()
    bounds = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8), bounds


def chunks(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold at most ``limit`` bytes, or one row."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1
        end = min(rows, max(row + 1, end))
        yield row, end
        row = end


def words_of(
    column: pa.Array, lower: bool = False, limit: int = CHUNK_BYTES
) -> Iterator[Words]:
    """The words of a string column, chunk by chunk, A-Z lowered if asked."""
    data, bounds = text_buffer(column)
    for row, end in chunks(bounds, limit):
        cuts = bounds[row : end + 1] - bounds[row]
        part = data[bounds[row] : bounds[end]]
        part = _LOWER[part] if lower else part
        solid = ~_IS_SPACE[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        edge[cuts] = True
        opens, closes = solid.copy(), solid.copy()
        opens[1:] &= ~solid[:-1] | edge[1:-1]
        closes[:-1] &= ~solid[1:] | edge[1:-1]
        starts = np.flatnonzero(opens)
        ends = np.flatnonzero(closes) + 1
        hashes = span_hashes(_BYTE[part], starts, ends)
        yield Words(row, part, starts, ends, np.searchsorted(starts, cuts), hashes)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words, whatever texts they belong to."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    factor = _BASE
    for j in range(size):
        total += hashes[j : j + n] * factor
        factor = _times(factor, _STEP)
    return mix(total + _times(np.uint64(size), _LENGTH))
