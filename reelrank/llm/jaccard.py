"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word 5-grams. The set's hashes are XORed into a sketch:
a hash picks a block and toggles the block's content. One element more or less changes one
block, so the number of differing blocks, like the number of differing bits of a one-bit
sketch, is at most the symmetric difference of two sets. Sets with a Jaccard similarity of
0.8 or more differ in at most a ninth of their summed sizes, hence of enough blocks one is
equal in both (pigeonhole): documents are joined on equal blocks, per band of set sizes.
Pairs found are held against a second, folding bit sketch, and those left are verified on
their texts.

All links between different sets are found, but not all are written: of the documents under
one key only the first is paired with each other one. What that leaves open are keys whose
documents are still in different components; there all pairs across components are compared
by their bit sketches, cell by cell, and the similar ones verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.components import components
from reelrank.llm.streams import group_bounds, whole_groups
from reelrank.llm.words import bounded_batches, mix, window_hashes, words_of
from reelrank.sources.durable import durable

SHINGLE = 5
#: Sizes of a band differ by at most this factor, which is that of sizes that can link.
BAND_GROWTH = 1.25
#: Documents of one key in one cell of the comparison across components.
CELL_ROWS = 1500

_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def _bands(largest: int) -> np.ndarray:
    """Least sizes of the bands, up to one beyond ``largest``."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(int(starts[-1] * BAND_GROWTH) + 1)
    starts.append(int(starts[-1] * BAND_GROWTH) + 1)
    return np.array(starts)


_BANDS = _bands(1 << 40)


def most_different(a: int, b: int) -> int:
    """Largest symmetric difference of linked sets with ``a`` and ``b`` elements.

    100 * both >= 80 * union is the same as 9 * difference <= a + b.
    """
    return (a + b) // 9


def _blocks(band: int) -> tuple[int, int]:
    """Number of blocks of a band and how many of them may be empty in a plain document."""
    most = int(_BANDS[band + 1]) - 1
    different = most_different(most, most)
    spare = 0 if different == 0 else 2 + different // 16
    return different + 1 + spare, spare


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lowered.

    Texts with fewer than five words have one shingle, the whole sequence; texts without
    words, and nulls, have none.
    """
    for words in words_of(column, lower=True):
        full = window_hashes(words.hashes, SHINGLE)
        short = {k: window_hashes(words.hashes, k) for k in range(1, SHINGLE)}
        for start, end in zip(words.of[:-1], words.of[1:], strict=True):
            n = end - start
            if n >= SHINGLE:
                yield np.unique(full[start : end - SHINGLE + 1])
            elif n:
                yield short[n][start : start + 1]
            else:
                yield full[:0]


def block_keys(hashes: np.ndarray, band: int, limit: int) -> np.ndarray:
    """Keys of the first ``limit`` blocks of a set under ``band``.

    Empty blocks say nothing and have no key, unless more blocks are empty than the band
    spares: two sets may then agree in empty blocks alone, so both emit those.
    """
    count, spare = _blocks(band)
    block = ((hashes >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    block = block.astype(np.int64)
    content = np.zeros(count, dtype=np.uint64)
    np.bitwise_xor.at(content, block, mix(hashes ^ _SALT))
    filled = np.bincount(block, minlength=count)[:limit] > 0
    if limit - int(filled.sum()) > spare:
        filled[:] = True
    places = np.flatnonzero(filled)
    label = places.astype(np.uint64) + np.uint64(band << 40)
    return mix(content[places] + mix(label))


def keys_of(hashes: np.ndarray) -> np.ndarray:
    """All keys under which a set can meet one that it links with."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    home = int(np.searchsorted(_BANDS, n, side="right")) - 1
    largest = n * 5 // 4
    found = []
    for band in (home, home + 1):
        if band > home and largest < _BANDS[band]:
            continue
        partner = min(largest, int(_BANDS[band + 1]) - 1)
        limit = most_different(n, partner) + 1 + _blocks(band)[1]
        found.append(block_keys(hashes, band, min(limit, _blocks(band)[0])))
    return np.concatenate(found)


def bit_sketch(hashes: np.ndarray) -> bytes:
    """Parity of the hashes that fall on each bit, for a power of two of bits, twice the
    size at least. XOR of the halves is the sketch of half the length."""
    bits = 64
    while bits < 2 * len(hashes):
        bits *= 2
    places = (mix(hashes + _SALT) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """Hamming distance of two bit sketches at the shorter length: no set differs by less."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, fingerprint and bit sketch of each document."""
    for batch in batches:
        sizes, first, second, sketches = [], [], [], []
        for hashes in shingle_sets(batch.column("text")):
            sizes.append(len(hashes))
            first.append(int(mix(hashes ^ _SALT).sum(dtype=np.uint64)) & (2**63 - 1))
            parity = np.bitwise_xor.reduce(mix(hashes + _SALT), initial=np.uint64(0))
            second.append(int(parity >> np.uint64(1)))
            sketches.append(bit_sketch(hashes) if len(hashes) else b"")
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(first, pa.int64()),
                pa.array(second, pa.int64()),
                pa.array(sketches, pa.binary()),
            ],
            names=["doc_id", "n_shingles", "f1", "f2", "sketch"],
        )


_DESCRIBED = "doc_id long, n_shingles long, f1 long, f2 long, sketch binary"


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(k, a, b, pair)``: keys of the batch's distinct sets, and pairs of its equal sets."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        leader: dict[bytes, int] = {}
        keys, owners, pairs, held = [], [], [], 0
        for doc, hashes in zip(ids, shingle_sets(batch.column("text")), strict=True):
            if len(hashes) == 0:
                continue
            first = leader.setdefault(hashes.tobytes(), doc)
            if first != doc:
                pairs.append((first, doc))
                continue
            own = keys_of(hashes)
            keys.append(own)
            owners.append(np.full(len(own), doc, dtype=np.int64))
            held += len(own)
            if held > 1_000_000:
                yield _key_batch(np.concatenate(keys), np.concatenate(owners), None)
                keys, owners, held = [], [], 0
        if keys:
            yield _key_batch(np.concatenate(keys), np.concatenate(owners), None)
        if pairs:
            both = np.array(pairs, dtype=np.int64)
            yield _key_batch(
                mix(both[:, 1].astype(np.uint64)), both.min(axis=1), both.max(axis=1)
            )


def _key_batch(keys: np.ndarray, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
    pair = pa.array(np.full(len(a), b is not None))
    other = a if b is None else b
    return pa.record_batch([keys.view(np.int64), a, other, pair], names=["k", "a", "b", "pair"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: pairs (kind 0), and the groups to look at again (kind 1).

    A key's first document is paired with each other one. Groups of three and more are named
    by a hash of their members, so that the many keys of one family name one group.
    """
    for table in whole_groups(batches, "k"):
        k, a, b, given = (table.column(c).to_numpy() for c in ("k", "a", "b", "pair"))
        given = given.astype(bool)
        found = [np.stack([a[given], b[given]])]
        k, a = k[~given], a[~given]
        bounds = group_bounds(k)
        sizes = np.diff(bounds)
        many = sizes > 1
        if many.any():
            inside = np.repeat(many, sizes)
            first = np.repeat(a[bounds[:-1]], sizes)
            found.append(np.stack([first[inside], a[inside]]))
        pairs = np.concatenate(found, axis=1)
        pairs = np.unique(pairs[:, pairs[0] != pairs[1]], axis=1)
        yield _met(0, pairs[0], pairs[1])
        large = sizes > 2
        if large.any():
            sums = np.add.reduceat(mix(a.astype(np.uint64)), bounds[:-1])
            _, one = np.unique(sums[large], return_index=True)
            chosen = np.zeros(len(sizes), dtype=bool)
            chosen[np.flatnonzero(large)[one]] = True
            inside = np.repeat(chosen, sizes)
            yield _met(1, np.repeat(sums, sizes)[inside].view(np.int64), a[inside])


def _met(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(np.full(len(a), kind), pa.int32()), pa.array(a), pa.array(b)],
        names=["kind", "a", "b"],
    )


#: Words of 64 bits, or pairs of documents, that a comparison of sketches holds at a time.
COMPARED = 1 << 20


def _flat(sketches: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All sketches as one array of 64-bit words, the first word and the number of words of each."""
    lengths = pc.binary_length(sketches).to_numpy(zero_copy_only=False).astype(np.int64) // 8
    chunks = sketches.chunks if isinstance(sketches, pa.ChunkedArray) else [sketches]
    parts = []
    for chunk in chunks:
        if len(chunk):
            chunk = chunk.cast(pa.large_binary())
            at = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset :][: len(chunk) + 1]
            number = int(at[-1] - at[0]) // 8
            if number:
                parts.append(np.frombuffer(chunk.buffers()[2], np.uint64, number, int(at[0])))
    words = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return words, np.cumsum(lengths) - lengths, lengths


def _least_differences(
    one: tuple[np.ndarray, np.ndarray, np.ndarray],
    other: tuple[np.ndarray, np.ndarray, np.ndarray],
    a: np.ndarray,
    b: np.ndarray,
) -> np.ndarray:
    """:func:`least_difference` of the sketches ``a`` of ``one`` and ``b`` of ``other``."""
    out = np.zeros(len(a), dtype=np.int64)
    shape = one[2][a] * (1 << 32) + other[2][b]
    order = np.argsort(shape, kind="stable")
    bounds = group_bounds(shape[order])
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        x, y = int(one[2][a[order[start]]]), int(other[2][b[order[start]]])
        least = min(x, y)
        if least == 0:
            continue  # nothing is known of an empty one
        step = max(1, COMPARED // max(x, y))
        for at in range(start, end, step):
            rows = order[at : min(end, at + step)]
            folded = []
            for (words, first, _), place, length in ((one, a, x), (other, b, y)):
                read = words[first[place[rows]][:, None] + np.arange(length)]
                # Folding a sketch again and again is the XOR of its parts.
                read = read.reshape(len(rows), length // least, least)
                folded.append(np.bitwise_xor.reduce(read, axis=1))
            out[rows] = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)
    return out


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose bit sketches allow a link, from rows with both sketches."""
    for batch in batches:
        sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        rows = np.arange(batch.num_rows)
        sketches = (_flat(batch.column(f"sketch_{s}")) for s in "ab")
        fit = _least_differences(*sketches, rows, rows) <= sizes // 9
        yield batch.filter(pa.array(fit, pa.bool_())).select(["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose texts link."""
    for batch in batches:
        fit = []
        texts = (batch.column("text_a"), batch.column("text_b"))
        for one, other in zip(*map(shingle_sets, texts), strict=True):
            both = len(np.intersect1d(one, other, assume_unique=True))
            fit.append(both > 0 and 100 * both >= 80 * (len(one) + len(other) - both))
        yield batch.filter(pa.array(fit, pa.bool_())).select(["a", "b"])


def _linked(pairs: DataFrame, described: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs (a, b)`` that link."""
    of = lambda s: described.select(
        F.col("doc_id").alias(s),
        F.col("n_shingles").alias(f"n_{s}"),
        F.struct("n_shingles", "f1", "f2").alias(f"same_{s}"),
        F.col("sketch").alias(f"sketch_{s}"),
    )
    near = (
        pairs.join(of("a"), "a")
        .join(of("b"), "b")
        .filter("5 * n_a >= 4 * n_b and 5 * n_b >= 4 * n_a")
    )
    near = durable(
        near.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b",
                    (F.col("same_a") == F.col("same_b")).alias("same")),
        "near",
    )
    equal = near.filter("same").select("a", "b")
    open_pairs = durable(near.filter("not same").mapInArrow(_sift, "a long, b long"), "open")
    text = lambda s: texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}"))
    read = open_pairs.join(text("a"), "a").join(text("b"), "b")
    return equal.unionByName(read.mapInArrow(_verify, "a long, b long"))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs across components within each cell whose bit sketches allow a link."""
    for table in whole_groups(batches, "cell"):
        cell, ids, comps, sizes, sides = (
            table.column(c).to_numpy() for c in ("cell", "doc_id", "comp", "n_shingles", "side")
        )
        bounds = group_bounds(cell)
        sketches = _flat(table.column("sketch"))
        # By cell and size: a document's partners of its size or above follow it.
        place = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        order = np.lexsort((sizes, place))
        place, size = place[order], sizes[order]
        width = 2 * int(size.max()) + 2
        last = np.searchsorted(place * width + size, place * width + 5 * size // 4, side="right")
        partners = last - np.arange(len(order)) - 1
        total = np.cumsum(partners)
        start, done = 0, 0
        while start < len(order):
            end = max(start + 1, int(np.searchsorted(total, done + COMPARED, side="right")))
            rows = np.arange(start, end)
            i = np.repeat(rows, partners[rows])
            j = i + 1 + np.arange(len(i)) - np.repeat(total[rows] - partners[rows] - done, partners[rows])
            start, done = end, int(total[end - 1])
            a, b = order[i], order[j]
            # A cell of two slices compares across them only.
            fit = (comps[a] != comps[b]) & ((sides[a] == 2) | (sides[a] != sides[b]))
            a, b = a[fit], b[fit]
            if not len(a):
                continue
            near = _least_differences(sketches, sketches, a, b) <= (sizes[a] + sizes[b]) // 9
            a, b = ids[a[near]], ids[b[near]]
            yield pa.record_batch(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
            )


def _across(groups: DataFrame, labels: DataFrame, described: DataFrame) -> DataFrame:
    """Possible links between different components within ``groups (a, doc_id)``."""
    placed = groups.join(labels, "doc_id", "left").withColumn(
        "comp", F.coalesce("component_id", "doc_id")
    )
    placed = durable(placed.select("a", "doc_id", "comp"), "placed")
    mixed = (
        placed.groupBy("a")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("comp").alias("n"))
        .filter("lo <> hi")
        .select("a", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("slices"))
    )
    rows = placed.join(mixed, "a").join(
        described.select("doc_id", "n_shingles", "sketch"), "doc_id"
    )
    own = F.pmod(F.xxhash64("doc_id"), F.col("slices")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    spread = rows.withColumn("own", own).withColumn("other", other)
    return (
        spread.withColumn(
            "cell", F.xxhash64("a", F.least("own", "other"), F.greatest("own", "other"))
        )
        .withColumn(
            "side",
            F.when(F.col("own") == F.col("other"), 2)
            .when(F.col("own") < F.col("other"), 0)
            .otherwise(1),
        )
        .select("cell", "side", "doc_id", "comp", "n_shingles", "sketch")
        .repartition("cell")
        .sortWithinPartitions("cell", "doc_id")
        .mapInArrow(_cells, "a long, b long")
        .distinct()
    )


def jaccard_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, n_shingles, ...)`` of every document, and links ``(a, b)``, a < b.

    The links are enough to give the components of all links; all of them are true ones.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text").filter("doc_id is not null")
    if _repeats(texts):
        texts = texts.groupBy("doc_id").agg(F.max("text").alias("text"))
    described = durable(texts.mapInArrow(_describe, _DESCRIBED), "sets")
    met = durable(
        texts.mapInArrow(_emit_keys, "k long, a long, b long, pair boolean")
        .repartition("k")
        .sortWithinPartitions("k", "a")
        .mapInArrow(_meet, "kind int, a long, b long"),
        "met",
    )
    pairs = met.filter("kind = 0").select("a", "b").distinct()
    links = durable(_linked(pairs, described, texts), "links")
    groups = met.filter("kind = 1").select("a", F.col("b").alias("doc_id")).distinct()
    labels = components(links).withColumnRenamed("id", "doc_id")
    more = _across(groups, labels, described)
    return described, links.unionByName(durable(_linked(more, described, texts), "links"))


def _repeats(docs: DataFrame) -> bool:
    """Whether a ``doc_id`` occurs twice; reads no other column."""
    return not docs.groupBy("doc_id").count().filter("count > 1").isEmpty()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per ``doc_id``.

    ``component_id`` is the least ``doc_id`` reachable by links, itself included. Null and
    empty texts have no shingles and no links. Rows without ``doc_id`` are left out; of rows
    that repeat one, the greatest text counts. Other columns are ignored. An empty table
    gives an empty result.
    """
    described, links = jaccard_links(docs)
    found = components(links).withColumnRenamed("id", "doc_id")
    return described.select("doc_id", "n_shingles").join(found, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the least of its component."""
    kept = near_duplicates(docs).filter("doc_id = component_id").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi")
