"""Source divergence audit: how the sources of a language differ in their words.

One ``CountVectorizer`` fit serves many languages: a term begins with its language's mark, so
a term's document frequency is that within the language, ``minDF`` holds per language, and
with the largest ``vocabSize`` there is, no term in enough documents is left out. The fit reads
each document's terms once, as document frequencies need no more. For the counts the terms of a
group (language, source) in a batch of texts are brought together: a term that is there ``n``
times goes to the rows of the powers of two that make up ``n``, and the model gives an exact sparse
count vector for each row. The vectors, times their rows' powers, are summed per group as sparse
rows, which partial sums on the map side keep to one row per group, term and task.

Pairs of sources are evaluated over sparse rows too: a task takes two blocks of sources and a
share of the terms, and visits only terms that occur in one of the blocks. All other terms of
the language differ by the same amount, which is added in one product. All numbers are
integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.llm.streams import group_bounds, whole_groups
from reelrank.llm.words import bounded_batches, chunks, text_buffer
from reelrank.plans.topk import top_per_group
from reelrank.sources.durable import durable

MIN_DOCS = 30
VOCABULARY = 2**31 - 1
#: Probabilities are in billionths, one added; counts are smoothed by this.
UNIT, SMOOTHING = 1_000_000_000, 5
TOP_TERMS = 50
#: Sources in a block, and terms that are compared at once: 256 x 256 numbers are 512 KB.
SOURCE_BLOCK = 256
TERM_TILE = 256
#: Bytes of text in a batch.
BATCH_BYTES = 4 << 20

_TERM = np.ones(256, dtype=bool)
_TERM[:0x41] = _TERM[0x5B:0x61] = _TERM[0x7B:0x80] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: One of these bytes, which no term holds, before a term says which language it is of.
_MARKS = [byte for byte in range(256) if not _TERM[byte]]


def _terms(column: pa.Array, marks: np.ndarray) -> pa.Array:
    """The terms of each text as a list: runs of ASCII letters, lowered, and other letters,
    each behind its text's mark.

    Bytes of one UTF-8 character are all in a run or all outside, so runs can be found in
    bytes. A mark takes the place of the byte before its term; texts get one in front.
    """
    empty, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    spaced = pc.binary_join_element_wise(empty, column, space)
    data, bounds = text_buffer(spaced)
    parts = [pa.array([], pa.list_(pa.string()))]
    for row, end in chunks(bounds):
        cuts = bounds[row : end + 1] - bounds[row]
        part = _LOWER[data[bounds[row] : bounds[end]]]
        solid = _TERM[part]
        starts = np.flatnonzero(solid[1:] & ~solid[:-1])  # of the marks
        lists = np.searchsorted(starts, cuts).astype(np.int32)
        part[starts] = np.repeat(marks[row:end], np.diff(lists))
        solid[starts] = True
        # The bytes of the terms alone, end to end, and where each term starts among them.
        before = np.concatenate(([0], np.cumsum(solid, dtype=np.int64)))
        places = np.concatenate([before[starts], before[-1:]]).astype(np.int32)
        values = pa.Array.from_buffers(
            pa.string(),
            len(starts),
            [None, pa.py_buffer(places), pa.py_buffer(part[solid])],
        )
        parts.append(pa.ListArray.from_arrays(pa.array(lists), values))
    return pa.concat_arrays(parts)


def _once(lists: pa.ListArray) -> pa.ListArray:
    """Each list's different values, in the order of their first places."""
    codes = lists.flatten().dictionary_encode()
    size = max(1, len(codes.dictionary))
    row = np.repeat(np.arange(len(lists)), lists.value_lengths())
    pair = pc.unique(pa.array(row * size + codes.indices.to_numpy())).to_numpy()
    places = np.searchsorted(pair // size, np.arange(len(lists) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), codes.dictionary.take(pa.array(pair % size)))


def _by_power(groups: np.ndarray, lists: pa.ListArray) -> Iterator[pa.RecordBatch]:
    """``(group_no, times, terms)``: per group and power of two the different values whose
    number in the group's lists has that binary digit."""
    codes = lists.flatten().dictionary_encode()
    size = max(1, len(codes.dictionary))
    names, number = np.unique(groups, return_inverse=True)
    key = np.repeat(number, lists.value_lengths()) * size + codes.indices.to_numpy()
    found = pc.value_counts(pa.array(key))
    pair, count = (found.field(c).to_numpy() for c in ("values", "counts"))
    for digit in range(int(count.max(initial=0)).bit_length()):
        own = np.sort(pair[(count >> digit) & 1 == 1])
        bounds = group_bounds(own // size)
        group = names[own[bounds[:-1]] // size]
        terms = codes.dictionary.take(pa.array(own % size))
        yield pa.record_batch(
            [
                pa.array(group, pa.int64()),
                pa.array(np.full(len(group), 1 << digit)),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), terms),
            ],
            names=["group_no", "times", "terms"],
        )


def _marked(
    batches: Iterator[pa.RecordBatch], marks: dict[str, int]
) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        mark = np.array([marks[lang] for lang in langs], dtype=np.uint8)
        yield batch, _terms(batch.column("text"), mark)


def document_terms(docs: DataFrame, marks: dict[str, int]) -> DataFrame:
    """``(terms)``: the different marked terms of every whole text in a language of
    ``marks``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, terms in _marked(batches, marks):
            yield pa.record_batch([_once(terms)], names=["terms"])

    own = docs.select("lang", "text").filter(F.col("lang").isin(list(marks)))
    return own.mapInArrow(run, "terms array<string>")


def group_terms(docs: DataFrame, marks: dict[str, int]) -> DataFrame:
    """``(group_no, times, terms)``: the marked terms of all whole texts in a language of
    ``marks``, each of a row's terms standing for ``times`` of its kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, terms in _marked(batches, marks):
            yield from _by_power(batch.column("group_no").to_numpy(), terms)

    own = docs.select(_group_no().alias("group_no"), "lang", "text")
    own = own.filter(F.col("lang").isin(list(marks)))
    return own.mapInArrow(run, "group_no long, times long, terms array<string>")


def group_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """``(group_no, term_no, count)`` of kept terms, and ``(term_no, lang, term)``. Groups go
    by a hash of language and source.

    ``docs`` is ``(lang, source, text)`` without null languages and sources. The vocabulary
    passes through the driver, as a fitted model does: the terms that stand in ``min_docs``
    documents of their language, and the languages' names. A fit serves as many languages as
    there are marks.
    """
    spark = docs.sparkSession
    langs = sorted(row.lang for row in docs.select("lang").distinct().collect())
    sums, words = [], []
    for start in range(0, len(langs), len(_MARKS)):
        marks = dict(zip(langs[start : start + len(_MARKS)], _MARKS))
        found, vocabulary = _fitted(docs, marks, min_docs)
        sums.append(found.withColumn("term_no", F.col("term_no") + len(words)))
        named = {mark: lang for lang, mark in marks.items()}
        words += [(named[ord(w[0])], w[1:]) if w else ("", "") for w in vocabulary]
    table = [(number, *word) for number, word in enumerate(words) if word[1]]
    table = spark.createDataFrame(table, "term_no int, lang string, term string")
    if not sums:
        empty = spark.createDataFrame([], "group_no long, term_no int, count long")
        return empty, table
    return reduce(DataFrame.unionByName, sums), table


def _fitted(
    docs: DataFrame, marks: dict[str, int], min_docs: int
) -> tuple[DataFrame, list[str]]:
    """Counts by group and place in the vocabulary, and the vocabulary."""
    # A term of its own, so that a corpus of rare words only has a vocabulary to fit as well.
    filler = docs.sparkSession.range(min_docs).select(F.array(F.lit("")).alias("terms"))
    counter = CountVectorizer(
        inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=VOCABULARY
    )
    model = counter.fit(document_terms(docs, marks).unionByName(filler))
    entry = F.explode(F.arrays_zip("v.indices", "v.values"))
    sums = (
        model.transform(group_terms(docs, marks))
        .select("group_no", "times", F.unwrap_udt("vector").alias("v"))
        .select("group_no", "times", entry.alias("e"))
        .groupBy("group_no", F.col("e.indices").alias("term_no"))
        .agg(F.sum(F.col("e.values").cast("long") * F.col("times")).alias("count"))
    )
    return sums, model.vocabulary


def _group_no() -> Column:
    return F.xxhash64("lang", "source")


def _probability(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(UNIT * (count + 5) / (total + 5 * kept))``, exact at any size."""
    wide = lambda x: x.cast("decimal(20,0)")
    over = lambda a, b: F.call_function("div", a, b)
    above, below = count + SMOOTHING, total + SMOOTHING * kept
    fits = above < (1 << 62) // UNIT
    share = F.when(fits, over(above * F.lit(UNIT).cast("long"), below)).otherwise(
        over(wide(above) * F.lit(UNIT).cast("decimal(10,0)"), wide(below))
    )
    return (share + 1).cast("long")


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each cell and pair of its sources the summed difference over the terms that the
    cell has, and how many these are. Rows come sorted by cell."""
    for table in whole_groups(batches, "cell"):
        cells = table.column("cell").to_numpy()
        bounds = group_bounds(cells)
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            rows = table.slice(start, end - start)
            take = lambda name, rows=rows: rows.column(name).to_numpy()
            side, source, none = take("side"), take("source_no"), take("none")
            here = [np.flatnonzero((side == which) | (side == 2)) for which in (0, 1)]
            number, term = np.unique(take("term_no"), return_inverse=True)
            ids, blocks = [], []
            for own in here:
                found, first, row = np.unique(
                    source[own], return_index=True, return_inverse=True
                )
                ids.append(found)
                blocks.append((own, row, none[own][first]))
            if not len(ids[0]) or not len(ids[1]):
                continue
            total = np.zeros((len(ids[0]), len(ids[1])), dtype=np.int64)
            p = take("p")
            for low in range(0, len(number), TERM_TILE):
                width = min(TERM_TILE, len(number) - low)
                dense = []
                for own, row, empty in blocks:
                    block = np.repeat(empty[:, None], width, axis=1)
                    fit = (term[own] >= low) & (term[own] < low + width) & (p[own] > 0)
                    block[row[fit], term[own][fit] - low] = p[own][fit]
                    dense.append(block)
                for i, one in enumerate(dense[0]):
                    total[i] += np.abs(dense[1] - one).sum(axis=1)
            # Terms numbered -1 say that a source is there; they are no terms.
            seen = int((number >= 0).sum())
            spare = len(number) - seen
            if spare:
                total -= spare * np.abs(blocks[0][2][:, None] - blocks[1][2][None, :])
            a, b = np.repeat(ids[0], len(ids[1])), np.tile(ids[1], len(ids[0]))
            yield pa.record_batch(
                [pa.array(a), pa.array(b), pa.array(total.ravel()),
                 pa.array(np.full(len(a), seen, dtype=np.int64))],
                names=["a", "b", "part", "seen"],
            )


def pair_values(groups: DataFrame, terms: DataFrame, term_parts: int) -> DataFrame:
    """``(a, b, value)`` for each ordered pair of different groups of one language.

    ``groups`` is ``(group_no, lang, block, blocks, none, kept)``: the group's block of
    the language's ``blocks``, the probability ``none`` of a term that the group lacks, and
    how many terms the language has ``kept``. ``terms`` is
    ``(group_no, term_no, p)``. Each unordered pair of blocks and share of the terms is a
    cell; a row goes to the cells of its block, which are as many as the language has
    blocks.
    """
    # A row without a term for every group and share, so that every pair comes up.
    shares = F.explode(F.sequence(F.lit(0), F.lit(term_parts - 1)))
    there = groups.select(
        "group_no", F.lit(-1).alias("term_no"), F.lit(0).cast("long").alias("p"),
        shares.alias("share"),
    )
    share = F.pmod(F.xxhash64("term_no"), F.lit(term_parts)).cast("int")
    rows = terms.select("group_no", "term_no", "p", share.alias("share")).unionByName(there)
    own = groups.select("group_no", "lang", "block", "none", "blocks")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.join(own, "group_no").withColumn("other", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    cell = F.xxhash64("lang", low, high, "share")
    # 2: a block that meets itself.
    side = F.when(F.col("block") < F.col("other"), 0).when(F.col("block") > F.col("other"), 1)
    placed = rows.select(
        cell.alias("cell"), side.otherwise(2).alias("side"),
        F.col("group_no").alias("source_no"), "term_no", "p", "none",
    )
    sums = (
        placed.repartition("cell")
        .sortWithinPartitions("cell")
        .mapInArrow(_pair_sums, "a long, b long, part long, seen long")
        .groupBy("a", "b")
        .agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"))
    )
    one = groups.select(F.col("group_no").alias("a"), F.col("none").alias("none_a"), "kept")
    two = groups.select(F.col("group_no").alias("b"), F.col("none").alias("none_b"))
    rest = (F.col("kept") - F.col("seen")) * F.abs(F.col("none_a") - F.col("none_b"))
    full = sums.join(one, "a").join(two, "b").filter("a <> b")
    full = full.select("a", "b", (F.col("part") + rest).alias("value"), "none_a")
    turned = full.select(F.col("b").alias("a"), F.col("a").alias("b"), "value")
    # Blocks of one cell are compared one way; within a block both ways come out.
    return full.select("a", "b", "value").unionByName(turned).distinct()


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: what sets the sources of each language
    apart.

    Terms are runs of ASCII letters, lowered, and of characters beyond ASCII. A language
    keeps the terms that stand in ``min_docs`` of its documents. Each group (lang, source)
    and each language gives a kept term the probability ``1 + floor(10**9 * (count + 5) /
    (total + 5 * kept))``. Part ``pair`` has the summed absolute difference to each other
    source of the language; part ``term`` the terms that the group has and uses more than
    its language, by difference, ``top_terms`` of them. Ranks run from 1, the largest value
    first, then by item.

    Null texts, languages and sources are empty ones. Every row is a document, also one that
    repeats an id or a text. A group without kept terms has pairs and no terms; where a
    language keeps none, all values are 0. An empty table gives an empty result. Other
    columns are ignored.
    """
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    docs = docs.select(*text, "text")
    sums, vocabulary = group_counts(docs, min_docs)
    vocabulary = durable(vocabulary, "vocabulary")
    sums = durable(sums, "counts")
    kept = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = sums.groupBy("group_no").agg(F.sum("count").alias("total"))
    zero = F.lit(0).cast("long")
    found = docs.select("lang", "source").distinct()
    blocks = found.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / SOURCE_BLOCK).cast("int").alias("blocks")
    )
    none = F.when(F.col("kept") > 0, _probability(zero, F.col("total"), F.col("kept")))
    groups = (
        found.join(blocks, "lang").join(kept, "lang", "left")
        .withColumn("group_no", _group_no())
        .join(totals, "group_no", "left")
        .withColumn("kept", F.coalesce("kept", zero))
        .withColumn("total", F.coalesce("total", zero))
        .select("lang", "source", "kept", "total", "blocks",
                F.coalesce(none, zero).alias("none"), "group_no",
                F.pmod(F.xxhash64("source"), F.col("blocks").cast("long")).cast("int")
                .alias("block"))
    )
    groups = durable(groups, "groups")

    named = sums.join(groups, "group_no")
    own = named.select(
        "lang", "source", "group_no", "term_no",
        _probability(F.col("count"), F.col("total"), F.col("kept")).alias("p"),
    )
    rows = sums.count()
    term_parts = max(1, min(4_096, rows // 50_000))
    pairs = pair_values(groups, own.select("group_no", "term_no", "p"), term_parts)
    names = groups.select("group_no", "lang", "source")
    item = names.select(F.col("group_no").alias("b"), F.col("source").alias("item"))
    pairs = pairs.join(names.withColumnRenamed("group_no", "a"), "a").join(item, "b")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_rank = F.row_number().over(order)
    pair_part = pairs.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", pair_rank.alias("rank")
    )

    whole = named.groupBy("lang", "term_no").agg(F.sum("count").alias("count"))
    language = groups.groupBy("lang", "kept").agg(F.sum("total").alias("total"))
    whole = whole.join(language, "lang").select(
        "term_no", _probability(F.col("count"), F.col("total"), F.col("kept")).alias("q")
    )
    excess = (
        own.join(whole, "term_no")
        .filter("p > q")
        .join(vocabulary.select("term_no", F.col("term").alias("item")), "term_no")
        .select("lang", "source", "item", (F.col("p") - F.col("q")).alias("value"))
    )
    best = top_per_group(excess, ["lang", "source"], [F.desc("value"), F.asc("item")], top_terms)
    term_part = best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pair_part.unionByName(term_part)
