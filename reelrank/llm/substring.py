"""Substring dedup: words inside 13-word windows that an earlier document holds too.

Windows are grouped by their least 5-gram hash, the anchor: consecutive windows with one
anchor form a segment, and equal windows of different documents always meet under the same
anchor. Only anchors that occur in two documents matter. Shards are ranges of anchors; each
shard's segments are concatenated into an FM-index (a Burrows-Wheeler transform over a
wavelet tree), and every distinct segment is streamed through it: backward search from each
word gives its matching statistic, up to the threshold, and where this is reached the
least document of the match. Segments are compared word by word there, words by their
64-bit hash.

A shard is built from a bounded number of words. Copies of a segment are collapsed in the
tasks that read them, so that a passage in a third of all documents reaches its shard once
per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.streams import group_bounds, whole_groups
from reelrank.llm.words import Words, bounded_batches, mix, span_hashes, window_hashes, words_of
from reelrank.sources.durable import durable, release

#: Words of a window: the least length of what counts as repeated.
WINDOW = 13
#: Words of the n-grams among which a window's anchor is the one with the least hash.
ANCHOR = 5
#: Words in one FM-index; a group of segments with one anchor is never cut.
INDEX_WORDS = 400_000
#: Bytes of text handled at once: what is made of them stays in a core's cache.
CHUNK_BYTES = 512 << 10
#: Places that go down the wavelet tree at once, for the same reason.
DESCENTS = 8192


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Least of each ``size`` consecutive values, by doubling."""
    width, least = 1, values
    while width < size:
        step = min(width, size - width)
        if len(least) <= step:
            return values[:0]
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def segments(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, text, first window and number of windows of each segment."""
    least = _sliding_min(window_hashes(words.hashes, ANCHOR), WINDOW - ANCHOR + 1)
    text = words.text_of()
    n = len(least)
    whole = text[:n] == text[WINDOW - 1 : WINDOW - 1 + n]
    starts = np.flatnonzero(whole)
    anchors, owner = least[starts], text[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
    cuts = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([cuts, [len(starts)]]))
    return anchors[cuts], owner[cuts], starts[cuts], sizes


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(k, anchor, doc_id)``; ``k`` is the anchor, or spreads rows known to be shared."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        anchors, docs = [], []
        for words in words_of(batch.column("text"), limit=CHUNK_BYTES):
            found, owner, _, _ = segments(words)
            anchors.append(found)
            docs.append(ids[words.first + owner])
        if not anchors:
            continue
        anchor, doc = np.concatenate(anchors), np.concatenate(docs)
        order = np.lexsort((doc, anchor))
        anchor, doc = anchor[order], doc[order]
        new_anchor = np.ones(len(anchor), dtype=bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        fresh = new_anchor.copy()
        fresh[1:] |= doc[1:] != doc[:-1]
        anchor, doc, new_anchor = anchor[fresh], doc[fresh], new_anchor[fresh]
        # From the third document of a batch on, an anchor is known to be shared.
        first = np.maximum.accumulate(np.where(new_anchor, np.arange(len(anchor)), 0))
        known = np.arange(len(anchor)) - first >= 2
        k = np.where(known, mix(anchor ^ mix(doc.astype(np.uint64))), anchor)
        yield pa.record_batch(
            [k.view(np.int64), anchor.view(np.int64), doc, pa.array(known)],
            names=["k", "anchor", "doc_id", "known"],
        )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(anchor, doc_id)`` of anchors with two documents, from rows sorted by ``k``."""
    for table in whole_groups(batches, "k"):
        k, known = (table.column(c).to_numpy() for c in ("k", "known"))
        twin = k[1:] == k[:-1]
        fit = known.astype(bool)
        fit[1:] |= twin
        fit[:-1] |= twin
        chosen = table.select(["anchor", "doc_id"]).filter(pa.array(fit))
        yield from chosen.combine_chunks().to_batches()


def _emit_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared segments: where each stands (kind 0, with the row in place of the anchor), and
    the words of each that a batch holds, once (kind 1)."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        rows = batch.column("row").to_numpy(zero_copy_only=False).view(np.uint64)
        lists = batch.column("anchors")
        found, data, size = [], [], 0
        for words in words_of(batch.column("text"), limit=CHUNK_BYTES):
            anchors, owner, first, sizes = segments(words)
            part = lists.slice(words.first, words.texts)
            wanted = part.flatten().to_numpy().view(np.uint64)
            row = np.repeat(np.arange(words.texts), part.value_lengths().to_numpy())
            pair = lambda a, t: mix(a ^ mix(t.astype(np.uint64)))
            fit = np.isin(pair(anchors, owner), pair(wanted, row))
            anchors, owner, first, sizes = (x[fit] for x in (anchors, owner, first, sizes))
            if len(anchors) == 0:
                continue
            last = first + sizes + WINDOW - 1
            name = span_hashes(mix(words.hashes), first, last)
            text, at = words.spaced(np.arange(len(words.starts)))
            of = words.first + owner
            place = first - words.of[owner]
            found.append(
                (name, anchors, ids[of], rows[of], place, sizes, at[first] + size, at[last] + size)
            )
            data.append(text)
            size += len(text)
        if not found:
            continue
        name, anchors, doc, row, place, sizes, start, end = map(
            np.concatenate, zip(*found, strict=True)
        )
        order = np.lexsort((doc, name))
        lead = order[np.concatenate(([True], name[order][1:] != name[order][:-1]))]
        data = b"".join(data)
        # Without the space after the last word.
        spans = zip(start[lead].tolist(), (end[lead] - 1).tolist(), strict=True)
        content = [data[a:b] for a, b in spans]
        yield _segment_batch(0, name, row, doc, place, sizes, None)
        yield _segment_batch(
            1, name[lead], anchors[lead], doc[lead], place[lead], sizes[lead], content
        )


_SEGMENT = "kind int, name long, anchor long, doc_id long, place long, n int, words binary"


def _segment_batch(kind, name, anchor, doc, place, sizes, content) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array(np.full(len(name), kind), pa.int32()),
            pa.array(name.view(np.int64)),
            pa.array(anchor.view(np.int64)),
            pa.array(doc, pa.int64()),
            pa.array(place, pa.int64()),
            pa.array(sizes, pa.int32()),
            pa.array(content if content is not None else [None] * len(name), pa.binary()),
        ],
        names=["kind", "name", "anchor", "doc_id", "place", "n", "words"],
    )


#: The bits of a 64-bit word below each of its places.
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class WaveletTree:
    """Ranks of symbols in a sequence: one bit vector per bit of the symbols.

    On each level the sequence is parted by one bit, zeros first, the order within either
    part kept. Bits lie in 64-bit words with the number of ones before each word.
    """

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.levels = []
        current = symbols.astype(np.uint32) if bits <= 32 else symbols
        for level in range(bits - 1, -1, -1):
            ones = ((current >> level) & 1).astype(bool)
            padded = np.zeros((len(ones) // 64 + 1) * 64, dtype=np.uint8)
            padded[: len(ones)] = ones
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(packed))))[:-1]
            zeros = len(ones) - int(ones.sum())
            self.levels.append((packed, before.astype(np.int64), zeros))
            current = np.concatenate([current[~ones], current[ones]])

    def descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where ``place`` comes to on the lowest level along the bits of ``symbol``, for
        arrays of both; ``place`` may have a row for each of several places. ``symbol`` occurs
        before ``place`` as often as this lies beyond where place 0 comes to."""
        out = np.empty_like(place)
        for start in range(0, len(symbol), DESCENTS):
            part = slice(start, start + DESCENTS)
            out[..., part] = self._descend(symbol[part], place[..., part])
        return out

    def _descend(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for depth, (packed, before, zeros) in enumerate(self.levels):
            bit = ((symbol >> (self.bits - 1 - depth)) & 1).astype(bool)
            word = place >> 6
            ones = before[word] + np.bitwise_count(packed[word] & _BELOW[place & 63])
            place = np.where(bit, zeros + ones, place - ones)
        return place


class FMIndex:
    """FM-index of a sequence of numbers from 0 for patterns of up to ``WINDOW`` symbols.

    Suffixes are sorted by at least their first ``WINDOW`` symbols, which places every such
    pattern's range exactly.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.text = symbols
        self.bits = max(1, int(symbols.max()).bit_length())
        # Ranks by as many symbols as a number holds, a symbol past the end being the least.
        width = max(1, 63 // (self.bits + 1))
        key = np.zeros(n, dtype=np.int64)
        for ahead in range(min(width, n)):
            shift = (self.bits + 1) * (width - 1 - ahead)
            key[: n - ahead] |= (symbols[ahead:] + 1) << shift
        while width < WINDOW:
            order = np.argsort(key)
            ranked = key[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1])))
            key = rank * (n + 1)
            key[: max(0, n - width)] += rank[width:] + 1
            width *= 2
        self.order = np.argsort(key)
        self.row = np.empty(n, dtype=np.int64)
        self.row[self.order] = np.arange(n)
        self.tree = WaveletTree(symbols[self.order - 1], self.bits)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(symbols))))
        every = np.arange(len(self.below) - 1)
        # First row of each symbol's suffixes, less where its occurrences begin in the tree.
        self.shift = self.below[:-1] - self.tree.descend(every, np.zeros_like(every))

    def matching_statistics(
        self, symbols: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Length (at most ``WINDOW``) of the longest match that ends before each of
        ``ends``, and the range of its suffixes, by backward search.

        Once a range is down to one suffix, what may follow is read from the text before it.
        """
        last = symbols[ends - 1]
        low, high = self.below[last], self.below[last + 1]
        length = (high > low).astype(np.int64)
        low[length == 0], high[length == 0] = 0, len(self.order)
        alive, at = np.flatnonzero(length), np.zeros(len(ends), dtype=np.int64)
        lone = np.zeros(0, dtype=np.int64)
        for back in range(1, WINDOW + 1):
            if back > 1:
                same = self.text[at[lone] - 1] == symbols[ends[lone] - back]
                lone = lone[same]
                at[lone] -= 1
                length[lone] = back
                # Equal patterns have one range and go on once.
                known = len(self.shift)
                pairs, which = np.unique(
                    low[alive] * known + symbols[ends[alive] - back], return_inverse=True
                )
                rows = np.stack([pairs // known, np.empty_like(pairs)])
                rows[1, which] = high[alive]
                symbol = pairs % known
                lo, hi = (self.shift[symbol] + self.tree.descend(symbol, rows))[:, which]
                fit = hi > lo
                alive, lo, hi = alive[fit], lo[fit], hi[fit]
                low[alive], high[alive], length[alive] = lo, hi, back
            one = high[alive] - low[alive] == 1
            at[alive[one]] = self.order[low[alive[one]]]
            lone, alive = np.concatenate([lone, alive[one]]), alive[~one]
        single = np.flatnonzero(high - low == 1)
        low[single] = self.row[at[single]]
        high[single] = low[single] + 1
        return length, low, high


def _search(names, docs, contents: pa.Array) -> pa.RecordBatch:
    """For each distinct segment, the least document of each of its windows."""
    column = contents.cast(pa.large_binary()).cast(pa.large_string(), safe=False)
    parts = [(words.hashes, words.counts) for words in words_of(column, limit=CHUNK_BYTES)]
    hashes, counts = zip(*parts, strict=True)
    symbols = np.unique(np.concatenate(hashes), return_inverse=True)[1].astype(np.int64) + 1
    sizes = np.concatenate(counts)
    # One 0 after each segment keeps matches from running across.
    owner = np.repeat(np.arange(len(names)), sizes)
    text = np.zeros(len(symbols) + len(names), dtype=np.int64)
    text[np.arange(len(symbols)) + owner] = symbols
    index = FMIndex(text)
    windows = sizes - (WINDOW - 1)
    start = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    step = np.concatenate(([0], np.cumsum(windows)))
    ends = np.repeat(start + WINDOW - step[:-1], windows) + np.arange(step[-1])
    length, low, high = index.matching_statistics(text, ends)
    # Every window is in the index itself, so each reaches the threshold.
    held = np.flatnonzero(length >= WINDOW)
    ranges, which = np.unique(low[held], return_inverse=True)
    last = np.zeros(len(ranges), dtype=np.int64)
    last[which] = high[held]
    doc_of = np.repeat(docs, sizes + 1)[index.order]
    cuts = np.stack([ranges, last], axis=1).ravel()
    least = np.minimum.reduceat(np.append(doc_of, np.iinfo(np.int64).max), cuts)[::2]
    best = np.full(len(ends), np.iinfo(np.int64).max)
    best[held] = least[which]
    lists = pa.ListArray.from_arrays(pa.array(step, pa.int32()), pa.array(best))
    return pa.record_batch([pa.array(names), lists], names=["name", "least"])


def _match_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Builds and searches one FM-index after the other, from rows sorted by anchor."""
    held: list[pa.Table] = []
    size = 0
    for table in whole_groups(batches, "anchor"):
        held.append(table)
        size += int(pa.compute.sum(table.column("n")).as_py()) + WINDOW * table.num_rows
        if size >= INDEX_WORDS:
            yield from _match(held)
            held, size = [], 0
    if held:
        yield from _match(held)


def _match(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
    table = pa.concat_tables(tables)
    name, doc = (table.column(c).to_numpy() for c in ("name", "doc_id"))
    order = np.lexsort((doc, name))
    lead = order[np.concatenate(([True], name[order][1:] != name[order][:-1]))]
    # Whole groups only, so a large table is searched in pieces of its anchors.
    lead = lead[np.argsort(table.column("anchor").to_numpy()[lead], kind="stable")]
    bounds = group_bounds(table.column("anchor").to_numpy()[lead])
    sizes = table.column("n").to_numpy()[lead].astype(np.int64) + WINDOW
    total = np.concatenate(([0], np.cumsum(sizes)))[bounds]
    contents = table.column("words")
    start = 0
    while start < len(bounds) - 1:
        end = int(np.searchsorted(total, total[start] + INDEX_WORDS))
        end = min(max(end, start + 1), len(bounds) - 1)
        piece = lead[bounds[start] : bounds[end]]
        words = contents.take(pa.array(piece)).combine_chunks()
        yield _search(name[piece], doc[piece], words)
        start = end


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each text, those covered by ``starts`` removed."""
    for batch in batches:
        ids = batch.column("doc_id")
        lists = batch.column("starts")
        for words in words_of(batch.column("text"), limit=CHUNK_BYTES):
            part = lists.slice(words.first, words.texts)
            lengths = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            starts = part.flatten().to_numpy() + np.repeat(words.of[:-1], lengths)
            change = np.zeros(len(words.starts) + WINDOW + 1, dtype=np.int64)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + WINDOW, -1)
            gone = np.cumsum(change)[: len(words.starts)] > 0
            kept = np.flatnonzero(~gone)
            data, at = words.spaced(kept)
            of = np.searchsorted(kept, words.of)
            # Without the space after a text's last word.
            bounds = zip(at[of[:-1]].tolist(), at[of[1:]].tolist(), strict=True)
            digests = [hashlib.sha256(data[a : max(a, b - 1)]).hexdigest() for a, b in bounds]
            yield pa.record_batch(
                [
                    ids.slice(words.first, words.texts),
                    pa.array(words.counts, pa.int64()),
                    pa.array(words.counts - np.diff(of), pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )


_CLEANED = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``(row, starts array<long>)``: windows, by their first word's number from 0, whose
    words also stand in a document with a smaller ``doc_id``.

    ``row`` tells apart texts that share a ``doc_id``, see :func:`row_key`.
    """
    texts = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    shared = durable(
        texts.mapInArrow(_emit_anchors, "k long, anchor long, doc_id long, known boolean")
        .repartition("k")
        .sortWithinPartitions("k")
        .mapInArrow(_shared, "anchor long, doc_id long"),
        "anchors",
        drop_shuffles=True,
    )
    lists = shared.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    named = texts.join(lists, "doc_id").withColumn("row", row_key())
    found = durable(named.mapInArrow(_emit_segments, _SEGMENT), "segments", drop_shuffles=True)
    release(shared)
    least = (
        found.filter("kind = 1")
        .select("name", "anchor", "doc_id", "n", "words")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_match_shards, "name long, least array<long>")
    )
    least = durable(least, "matches", drop_shuffles=True)
    placed = found.filter("kind = 0").select(
        "name", F.col("anchor").alias("row"), "doc_id", "place"
    )
    starts = F.filter(
        F.transform(
            "least",
            lambda doc, i: F.when(doc < F.col("doc_id"), F.col("place") + i),
        ),
        lambda start: start.isNotNull(),
    )
    hits = placed.join(least, "name").select("row", starts.alias("starts"))
    repeats = durable(
        hits.filter(F.size("starts") > 0)
        .groupBy("row")
        .agg(F.flatten(F.collect_list("starts")).alias("starts")),
        "repeats",
        drop_shuffles=True,
    )
    release(found, least)
    return repeats


def row_key() -> Column:
    """A number for a row's id and text; equal rows share it."""
    return F.xxhash64("doc_id", "text")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` of every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes when it lies in a window of 13
    words that also starts in a document with a smaller ``doc_id``. Null texts have no words.
    Rows that repeat a ``doc_id`` are one document as far as "smaller" goes, and each has its
    own words; a text repeated under one id is left alone. Rows without ``doc_id`` are returned unchanged. An empty
    table gives an empty result; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    starts = repeated_windows(docs)
    keyed = docs.select("doc_id", "text").withColumn("row", row_key())
    return keyed.join(starts, "row", "left").drop("row").mapInArrow(_apply, _CLEANED)
