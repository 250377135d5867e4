"""BPE encoding and decoding over a table of distinct words.

Texts are normalised and split into words in the tasks that read them. The distinct words
are counted; those that occur most often (``table_words`` at most, which bounds the table's
size) are encoded once each, and their ids looked up at every place where they stand. Any
other word is encoded where it stands, once per block of text: most of these occur in one
document only, so that this is their one encoding. Decoding looks ids up in the id-to-piece
table, as large as the vocabulary.

Both tables are small and go to the tasks that hold the texts: a join by shuffle would send
every word of the corpus, with its place, over the network twice.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.llm.words import CHUNK_BYTES, bounded_batches, chunks, mix, span_hashes
from reelrank.sources.durable import durable, release

#: Words in the broadcast table; 262,144 words of some 20 bytes with their ids: 10 MB.
TABLE_WORDS = 1 << 18
#: Size classes of word counts, to a doubling.
COUNT_CLASSES = 16
#: Bytes of text that are encoded at once.
ENCODE_BYTES = 1 << 19
#: Bytes of text in a batch that a worker holds.
BATCH_BYTES = 2 << 20
#: Longest word in the table, in bytes.
TABLE_WORD_BYTES = 64

_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
#: Texts with other characters are normalised and split by the tokenizer itself. Below this
#: code point nothing is composed, and lower case is a matter of single characters.
_PLAIN_LIMIT = 0x180
#: The dotted capital I has a lower case of two characters, one of them beyond.
_NOT_PLAIN = re.compile(f"[^\x00-{chr(_PLAIN_LIMIT - 1)}]|\u0130")
#: What may follow an apostrophe as one word with it, in the order of preference.
_SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
#: Stands between texts; white space that no rule touches.
_BREAK = "\n"


def load_tokenizer(content: str):
    """The tokenizer of a JSON file's content, without truncation and padding."""
    # Spark has the cores; threads of the library's own would each keep memory.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encode_words(tokenizer, words: list[str]) -> Iterator[list[int]]:
    """The ids of each word; a bounded number of the library's large results at a time."""
    for start in range(0, len(words), 512):
        part = tokenizer.encode_batch(words[start : start + 512], add_special_tokens=False)
        yield from (one.ids for one in part)


def _classes() -> np.ndarray:
    """Class of each plain character: white space, letter, number or other."""
    kinds = np.full(_PLAIN_LIMIT, _OTHER, dtype=np.uint8)
    for code in range(_PLAIN_LIMIT):
        char = chr(code)
        if char.isspace() and code not in (0x1C, 0x1D, 0x1E, 0x1F):
            kinds[code] = _SPACE
        elif char.isalpha():
            kinds[code] = _LETTER
        elif char.isnumeric():
            kinds[code] = _DIGIT
    return kinds


_CLASSES = _classes()


def _values(codes: np.ndarray) -> np.ndarray:
    """Numbers that stand for code points in hashes."""
    return mix((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


_CODE = _values(np.arange(_PLAIN_LIMIT))


def _spans(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in lowered plain text.

    Words are runs of letters, single numbers and runs of other characters; an apostrophe
    that begins a run and is followed by one of the suffixes forms a word with it.
    """
    kinds = _CLASSES[codes]
    change = np.ones(len(kinds) + 1, dtype=bool)
    change[1:-1] = kinds[1:] != kinds[:-1]
    change[:-1] |= kinds == _DIGIT
    # Apostrophes that stand alone as a run, right before a letter.
    lone = (codes == ord("'")) & change[:-1] & change[1:]
    lone[:-1] &= kinds[1:] == _LETTER
    lone[-1:] = False
    for place in np.flatnonzero(lone):
        after = codes[place + 1 : place + 3]
        for suffix in _SUFFIXES:
            if len(after) >= len(suffix) and all(
                after[k] == ord(char) for k, char in enumerate(suffix)
            ):
                change[place + 1] = False
                change[place + 1 + len(suffix)] = True
                break
    cuts = np.flatnonzero(change)
    starts, ends = cuts[:-1], cuts[1:]
    solid = kinds[starts] != _SPACE
    return starts[solid], ends[solid]


class _Splitter:
    """Splits texts into words, the same ones the tokenizer encodes one by one."""

    def __init__(self, content: str):
        self.tokenizer = load_tokenizer(content)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {token.content: number for number, token in added.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, names))) if names else None

    def is_plain(self, text: str) -> bool:
        return not _NOT_PLAIN.search(text) and not (self.cut and self.cut.search(text))

    def words(self, text: str) -> list[str]:
        """The words of any text; special tokens are words of their own."""
        out, at = [], 0
        for found in self.cut.finditer(text) if self.cut else ():
            out += self._ordinary(text[at : found.start()])
            out.append(found.group())
            at = found.end()
        return out + self._ordinary(text[at:])

    def _ordinary(self, text: str) -> list[str]:
        split = self.tokenizer.pre_tokenizer
        normal = self.tokenizer.normalizer
        text = normal.normalize_str(text) if normal else text
        # The last step of the split turns words into byte symbols; the offsets undo that.
        return [text[a:b] for _, (a, b) in split.pre_tokenize_str(text)]


class Block:
    """Consecutive texts as numbers into the block's distinct words."""

    def __init__(self, texts: list[str], splitter: _Splitter):
        plain = [splitter.is_plain(text) for text in texts]
        lowered = [text.lower() if ok else "" for text, ok in zip(texts, plain, strict=True)]
        sizes = np.array([len(text) + 1 for text in lowered], dtype=np.int64)
        joined = _BREAK.join(lowered) + _BREAK
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        starts, ends = _spans(codes)
        hashes = span_hashes(_CODE[codes], starts, ends)
        distinct, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        self.hashes = distinct
        self.words = [joined[a:b] for a, b in zip(starts[first], ends[first], strict=True)]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        cuts = np.searchsorted(starts, bounds)
        self.rows = [number[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        if not all(plain):
            self._add([(i, splitter.words(texts[i])) for i, ok in enumerate(plain) if not ok])

    def _add(self, others: list[tuple[int, list[str]]]) -> None:
        known = {word: i for i, word in enumerate(self.words)}
        for row, words in others:
            numbers = [known.setdefault(word, len(known)) for word in words]
            self.rows[row] = np.array(numbers, dtype=np.int64)
        self.words = list(known)
        fresh = self.words[len(self.hashes) :]
        self.hashes = np.concatenate([self.hashes, word_hashes(fresh)])


def word_hashes(words: list[str]) -> np.ndarray:
    """Hashes of words, the same as in :class:`Block`."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum(np.array([len(word) for word in words], dtype=np.int64))
    starts = np.concatenate(([0], ends))[:-1]
    return span_hashes(_values(codes), starts, ends)


def _blocks(
    column: pa.Array, splitter: _Splitter, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, Block]]:
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)
    bounds = bounds[column.offset : column.offset + len(column) + 1]
    for start, end in chunks(bounds, limit):
        yield start, Block(column.slice(start, end - start).to_pylist(), splitter)


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(hash, word, n)``: the distinct words of all texts and how often they occur.

    Words of over 64 bytes are left to be encoded where they stand, as are words that share
    their hash with another one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _Splitter(tokenizer)
        for batch in batches:
            for _, block in _blocks(batch.column("text"), splitter):
                every = np.concatenate([np.zeros(0, np.int64), *block.rows])
                n = np.bincount(every, minlength=len(block.words))
                words = pa.array(block.words, pa.string())
                fit = pa.compute.less_equal(pa.compute.binary_length(words), TABLE_WORD_BYTES)
                out = pa.record_batch(
                    [block.hashes.view(np.int64), words, n.astype(np.int64)],
                    names=["hash", "word", "n"],
                )
                yield out.filter(fit)

    rows = docs.select("text").mapInArrow(count, "hash long, word string, n long")
    return (
        rows.groupBy("hash")
        .agg(F.min("word").alias("word"), F.max("word").alias("other"), F.sum("n").alias("n"))
        .filter("word = other")
        .select("hash", "word", "n")
    )


def least_count(counts: DataFrame, table_words: int) -> int:
    """The least count of the words that go into a table of ``table_words`` at most.

    From how many words have counts of each size class: a few hundred rows, whatever the
    number of words.
    """
    size = F.floor(F.log2("n") * COUNT_CLASSES).cast("int")
    classes = counts.filter("n > 1").groupBy(size.alias("c")).agg(
        F.count(F.lit(1)).alias("words"), F.min("n").alias("least")
    )
    least, room = 1 << 62, table_words
    for row in sorted(classes.collect(), key=lambda row: -row.c):
        room -= row.words
        if room < 0:
            break
        least = row.least
    return least


def word_table(
    docs: DataFrame, tokenizer: str, table_words: int = TABLE_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, numbers of ids, and ids end to end, of the most frequent words, each encoded
    once; by hash.

    ``table_words`` at most, and none that occurs once in the corpus: all words of at least
    some count. What comes back are three arrays a task, of some 20 bytes a word.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load_tokenizer(tokenizer)
        for batch in batches:
            found = list(encode_words(own, batch.column("word").to_pylist()))
            sizes = np.array([len(ids) for ids in found], dtype=np.int32)
            flat = np.array([i for ids in found for i in ids], dtype=np.int32)
            hashes = batch.column("hash").to_numpy()
            parts = [pa.array([part.tobytes()], pa.binary()) for part in (hashes, sizes, flat)]
            yield pa.record_batch(parts, names=["hashes", "sizes", "ids"])

    counts = durable(word_counts(docs, tokenizer), "words")
    frequent = counts.filter(F.col("n") >= least_count(counts, table_words))
    spread = frequent.repartition("hash")
    rows = spread.mapInArrow(encode, "hashes binary, sizes binary, ids binary").collect()
    release(counts)
    read = lambda name, kind: np.concatenate(
        [np.zeros(0, kind), *(np.frombuffer(row[name], kind) for row in rows)]
    )
    hashes, sizes = read("hashes", np.int64), read("sizes", np.int32).astype(np.int64)
    ids = read("ids", np.int32)
    order = np.argsort(hashes)
    starts = np.cumsum(sizes) - sizes
    inside = np.arange(len(ids)) - np.repeat(np.cumsum(sizes[order]) - sizes[order], sizes[order])
    return hashes[order], sizes[order], ids[np.repeat(starts[order], sizes[order]) + inside]


class _Ragged:
    """Lists of ids end to end."""

    def __init__(self, lists: list):
        self.sizes = np.array([len(ids) for ids in lists], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        self.flat = np.concatenate([np.zeros(0, np.int32), *map(np.asarray, lists)]).astype(
            np.int32
        )

    def take(self, rows: np.ndarray) -> np.ndarray:
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.starts[rows] - (ends - sizes), sizes)
        return self.flat[shift + np.arange(total)]


def encode(
    docs: DataFrame,
    tokenizer: str,
    table_words: int = TABLE_WORDS,
    columns: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``ids array<int>``: what the tokenizer gives for each whole text,
    without special tokens of its own. Of ``docs`` only ``columns`` are returned, if given.

    ``tokenizer`` is the content of its JSON file. A null or empty text has no ids; rows may
    repeat. A column named ``ids`` gives way to the result.
    """
    bounded_batches(docs.sparkSession, BATCH_BYTES)
    plain = docs.drop("ids")
    names = [name for name in columns or plain.columns if name in plain.columns]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(word_table(plain, tokenizer, table_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _Splitter(tokenizer)
        known, sizes, flat = shared.value
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        special = splitter.special
        for batch in batches:
            for start, block in _blocks(
                batch.column("text"), splitter, ENCODE_BYTES
            ):
                hashes = block.hashes.view(np.int64)
                place = np.searchsorted(known, hashes)
                place[place == len(known)] = 0
                hit = known[place] == hashes if len(known) else np.zeros(len(hashes), bool)
                lists: list = [None] * len(hashes)
                for i in np.flatnonzero(hit):
                    at = starts[place[i]]
                    lists[i] = flat[at : at + sizes[place[i]]]
                missing = [int(i) for i in np.flatnonzero(~hit)]
                found = encode_words(splitter.tokenizer, [block.words[i] for i in missing])
                for i, ids in zip(missing, found, strict=True):
                    lists[i] = np.array(ids, dtype=np.int32)
                for i, word in enumerate(block.words) if special else ():
                    if word in special:
                        lists[i] = [special[word]]
                words = _Ragged(lists)
                rows = [words.take(row) for row in block.rows]
                ends = np.cumsum([0, *map(len, rows)])
                ids = pa.LargeListArray.from_arrays(
                    pa.array(ends, pa.int64()),
                    pa.array(np.concatenate([np.zeros(0, np.int32), *rows])),
                ).cast(pa.list_(pa.int32()))
                part = batch.slice(start, len(rows)).select(names)
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*names, "ids"])

    ids = T.StructField("ids", T.ArrayType(T.IntegerType()))
    schema = T.StructType([*plain.select(*names).schema.fields, ids])
    return plain.mapInArrow(run, schema)


def pieces(spark, tokenizer: str) -> DataFrame:
    """``(id, piece)``: the vocabulary with the special tokens, from the tokenizer's file."""
    content = json.loads(tokenizer)
    vocabulary = {number: piece for piece, number in content["model"]["vocab"].items()}
    vocabulary |= {token["id"]: token["content"] for token in content.get("added_tokens", ())}
    return spark.createDataFrame(sorted(vocabulary.items()), "id int, piece string")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` with ``decoded``: the text that the tokenizer makes of ``ids``, special
    tokens included.

    The tokenizer has no decoder of its own, so its pieces are put together with a space
    between them. The id-to-piece table is joined by position in an array of the
    vocabulary's size. Null ids give a null text, no ids an empty one.
    """
    table = pieces(encoded.sparkSession, tokenizer).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("id", "piece"))), lambda row: row["piece"]
        ).alias("pieces")
    )
    return (
        encoded.drop("decoded")
        .withColumn("_pieces", table.scalar())
        .withColumn(
            "decoded",
            F.array_join(
                F.transform("ids", lambda number: F.get(F.col("_pieces"), number)), " "
            ),
        )
        .drop("_pieces")
    )


def digests(encoded: DataFrame) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of what :func:`decode` gives."""
    return (
        encoded.withColumn("n_tokens", F.size("ids").cast("long"))
        .withColumn("ids_sha256", F.sha2(F.array_join("ids", " "), 256))
        .withColumn("decoded_sha256", F.sha2("decoded", 256))
    )


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()
