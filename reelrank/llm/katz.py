"""Language-model scores: Katz backoff over words, learnt from part of the documents.

A text is its words, A-Z lowered, and one end; before the first word stands a start, which is
only ever a context. The probability of a word after a context is the discounted share of
their bigram; for a bigram not seen in training it is the context's backoff weight times
the word's own probability, which is its discounted share, or for an unknown word what the
discounts leave. Counts up to ``KATZ_LIMIT`` are discounted by Good-Turing. Backoff weights
are normalised exactly: what they divide by is summed, as whole numbers, over the words *not*
seen after the context, so the probabilities after any context add up to 1.

How it is computed. Sending every token to its n-gram's count and back would move the corpus
several times, so tokens travel in blocks and ask as blocks:

1. Consecutive texts form blocks of about ``BLOCK_TOKENS`` tokens. A block holds its tokens as
   numbers into its distinct words, and asks for these words: one message to each share of
   the words.
2. Each share adds up its words' counts, numbers its words, the most frequent first, keeps
   them as the table of unigrams, and answers each block with numbers and counts.
3. A block, knowing its words, asks for its distinct bigrams, by context. A context that holds
   many tokens is spread over the shares. Each share adds up its bigrams, keeps them as the
   table of bigrams, and answers with counts and what each context's weight is made of.
4. A block scores its texts: bigram, or backoff weight and unigram, token by token.

All steps are shuffles by block or by share, whose sizes do not depend on the corpus; messages
are whole-number arrays, packed. Tables lie in the shared folder, partitioned by kind.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.streams import group_bounds, whole_groups
from reelrank.llm.words import bounded_batches, mix, words_of
from reelrank.sources.durable import work_dir

#: Counts up to this are discounted by Good-Turing.
KATZ_LIMIT = 5
#: Tokens of a block, unless one text has more, and those that a share of the bigrams or of
#: the words answers for, about.
BLOCK_TOKENS, BIGRAM_TOKENS, WORD_TOKENS = 2_000_000, 2_000_000, 8_000_000
#: A context of more tokens is spread over the shares; at most ``MAX_SPREAD`` contexts are,
#: whose sums go to every task (under 20 MB).
SPREAD_TOKENS, MAX_SPREAD = 500_000, 100_000
#: Bytes of text in a batch, and of a token on average, for the number of shares.
BATCH_BYTES, TOKEN_BYTES = 4 << 20, 6

# Kinds of rows: a block's texts; a message and its answer; tables; sums of spread contexts.
TEXTS, ASK_WORDS, WORDS, UNIGRAMS, BIGRAM_COUNTS, BIGRAMS, SPREAD = range(7)
_ROWS = "to long, block long, ids array<long>, data binary, kind int"
# Stand for the start and the end of a text; any other words share them by chance only.
_START, _END = np.uint64(0x5DEECE66D1CE4E5B), np.uint64(0xC2B2AE3D27D4EB4F)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers (or of doubles, by their bits) as compressed byte planes."""
    head, planes = [len(arrays)], []
    for array in arrays:
        raw = np.ascontiguousarray(array)
        raw = raw.view(np.uint64) if raw.dtype.itemsize == 8 else raw.astype(np.uint64)
        width = max(1, (int(raw.max()).bit_length() + 7) // 8) if len(raw) else 1
        planes.append(raw.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
        head += [len(raw), width]
    body = b"".join(planes)
    return np.array([*head, len(body)]).tobytes() + pa.compress(body, "zstd", asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    count = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 2 * count + 2)
    body = pa.decompress(data[head.nbytes :], int(head[-1]), "zstd", asbytes=True)
    out, at = [], 0
    for n, width in head[1:-1].reshape(-1, 2).tolist():
        raw = np.zeros((n, 8), dtype=np.uint8)
        raw[:, :width] = np.frombuffer(body, np.uint8, n * width, at).reshape(width, n).T
        out.append(raw.view(np.int64).ravel())
        at += n * width
    return out


def _row(kind: int, to, block=0, ids=None, data: bytes | None = None) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array([int(to)], pa.int64()),
            pa.array([int(block)], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([data], pa.binary()),
            pa.array([kind], pa.int32()),
        ],
        names=["to", "block", "ids", "data", "kind"],
    )


def _deltas(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values, prepend=sorted_values.dtype.type(0))


@dataclass(frozen=True)
class Discounts:
    """Factors of the counts 1 to ``KATZ_LIMIT``; what is taken off larger ones."""

    factors: tuple[float, ...]
    taken: float

    def shares(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts; 0 stays 0."""
        table = np.array([0.0, *(r * f for r, f in enumerate(self.factors, 1))])
        large = counts - self.taken
        return np.where(counts <= KATZ_LIMIT, table[np.minimum(counts, KATZ_LIMIT)], large)

    def left(self, small: np.ndarray, large: np.ndarray) -> np.ndarray:
        """What is taken off ``small[..., r - 1]`` counts of r and ``large`` larger ones."""
        each = np.array([r * (1 - f) for r, f in enumerate(self.factors, 1)])
        return small @ each + large * self.taken


def discounts(frequencies: list[int]) -> Discounts:
    """Katz's discounts from how many n-grams occur 1, 2, ... ``KATZ_LIMIT + 1`` times.

    Small or odd corpora can give factors that are no discounts; then the same amount is
    taken off every count.
    """
    n = [0, *map(int, frequencies)]
    k = KATZ_LIMIT
    if all(n[1 : k + 2]):
        spare = (k + 1) * n[k + 1] / n[1]
        if spare != 1:
            found = [
                ((r + 1) * n[r + 1] / (r * n[r]) - spare) / (1 - spare) for r in range(1, k + 1)
            ]
            if all(0 < factor < 1 for factor in found):
                return Discounts(tuple(found), 0.0)
    amount = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return Discounts(tuple((r - amount) / r for r in range(1, k + 1)), amount)


@dataclass(frozen=True)
class Unigrams:
    """What is known of all words together: tokens, and kinds by count (1 to limit, more)."""

    tokens: int
    kinds: int
    small: tuple[int, ...]
    large: int
    large_tokens: int
    discounts: Discounts

    @property
    def unknown(self) -> float:
        """Probability of a word that training has not seen."""
        if not self.tokens:
            return 1.0
        return float(self.discounts.left(np.array(self.small), self.large)) / self.tokens

    def probability(self, counts: np.ndarray) -> np.ndarray:
        shares = self.discounts.shares(counts) / max(1, self.tokens)
        return np.where(counts > 0, shares, self.unknown)

    def unseen(self, sums: np.ndarray) -> np.ndarray:
        """Probability of all words but those that ``sums`` are over: tokens and number of
        the frequent ones, numbers of those that occur 1, 2, ... times."""
        each = np.array([r * f for r, f in enumerate(self.discounts.factors, 1)])
        tokens, large = self.large_tokens - sums[:, 0], self.large - sums[:, 1]
        rest = tokens - large * self.discounts.taken + (np.array(self.small) - sums[:, 2:]) @ each
        return rest / max(1, self.tokens) + self.unknown


def _emit_blocks(
    batches: Iterator[pa.RecordBatch], shares: int, block_tokens: int
) -> Iterator[pa.RecordBatch]:
    """The texts of each block, and its questions for words, one to each share."""
    partition = TaskContext.get().partitionId()
    number, held = 0, []

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal number, held
        block = (partition << 32) + number
        number, parts, held = number + 1, held, []
        sizes = np.concatenate([p[0] for p in parts])
        out = np.concatenate([p[1] for p in parts])
        ids = [i for p in parts for i in p[2]]
        hashes = np.concatenate([np.array([_START, _END]), *(p[3] for p in parts)])
        words, at = np.unique(hashes, return_inverse=True)
        train = np.repeat(~out, sizes)
        counts = np.bincount(at[2:][train], minlength=len(words))
        counts[at[:2]] = int((~out).sum())
        yield _row(TEXTS, block, 0, ids, pack(sizes, out, at[:2], at[2:]))
        share = ((words >> np.uint64(32)) * np.uint64(shares)) >> np.uint64(32)
        cuts = np.searchsorted(share, np.arange(shares + 1))
        for to, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                yield _row(ASK_WORDS, to, block, None, pack(_deltas(words[a:b]), counts[a:b]))

    tokens = 0
    for batch in batches:
        ids = batch.column("doc_id")
        out = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
        for words in words_of(batch.column("text"), lower=True):
            rows = slice(words.first, words.first + words.texts)
            own = ids.slice(words.first, words.texts).to_pylist()
            held.append((words.counts, out[rows], own, words.hashes))
            tokens += len(words.hashes) + words.texts
            if tokens >= block_tokens:
                yield from flush()
                tokens = 0
    if held:
        yield from flush()


def _by_target(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """The rows to each share or block, from rows sorted by ``to``."""
    for table in whole_groups(batches, "to"):
        bounds = group_bounds(table.column("to").to_numpy())
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            rows = table.slice(a, b - a).to_pylist()
            yield rows[0]["to"], rows


def _by_count(counts: np.ndarray) -> np.ndarray:
    """How many of ``counts`` are 1, 2, ... ``KATZ_LIMIT + 1``."""
    return np.bincount(counts[(counts > 0) & (counts <= KATZ_LIMIT + 1)],
                       minlength=KATZ_LIMIT + 2)[1:]


def _answer_words(batches: Iterator[pa.RecordBatch], shares: int) -> Iterator[pa.RecordBatch]:
    """Counts and numbers of a share's words, to itself and to the blocks that asked."""
    for to, rows in _by_target(batches):
        asked = [unpack(row["data"]) for row in rows]
        hashes = np.concatenate([np.cumsum(deltas.view(np.uint64)) for deltas, _ in asked])
        words, at = np.unique(hashes, return_inverse=True)
        counts = np.zeros(len(words), dtype=np.int64)
        np.add.at(counts, at, np.concatenate([n for _, n in asked]))
        number = np.empty(len(words), dtype=np.int64)
        number[np.argsort(-counts, kind="stable")] = np.arange(len(words)) * shares + to
        own = counts * (words != _START)
        large = own > KATZ_LIMIT
        sums = [own.sum(), (own > 0).sum(), large.sum(), own[large].sum(), *_by_count(own)]
        yield _row(UNIGRAMS, to, 0, list(map(int, sums)), pack(_deltas(words), number, own))
        start = 0
        for row, (deltas, _) in zip(rows, asked, strict=True):
            part = at[start : start + len(deltas)]
            start += len(deltas)
            yield _row(WORDS, row["block"], to, None, pack(number[part], counts[part]))


class Block:
    """A block's texts and the words' answers: its distinct bigrams, in asking order."""

    def __init__(self, rows: list[dict], shares: int, spread_above: int):
        texts = next(row for row in rows if row["kind"] == TEXTS)
        self.ids = texts["ids"]
        sizes, out, (start, end), tokens = unpack(texts["data"])
        self.out = out.astype(bool)
        answers = sorted((r for r in rows if r["kind"] == WORDS), key=lambda r: r["block"])
        answers = [unpack(row["data"]) for row in answers]
        number, count = (np.concatenate(part) for part in zip(*answers, strict=True))
        # Every text's words, then its end; the word before each, or the start.
        self.bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
        word = np.full(self.bounds[-1], end, dtype=np.int64)
        inside = np.ones(len(word), dtype=bool)
        inside[self.bounds[1:] - 1] = False
        word[inside] = tokens
        before = np.concatenate(([start], word[:-1]))
        before[self.bounds[:-1]] = start
        self.unigrams = count[word]
        pairs, at = np.unique(before * len(number) + word, return_inverse=True)
        first, second = pairs // len(number), pairs % len(number)
        spread = count[first] > spread_above
        share = mix(number[first].astype(np.uint64))
        share[spread] = mix(share[spread] ^ number[second][spread].astype(np.uint64))
        share = (share % np.uint64(shares)).astype(np.int64)
        order = np.lexsort((number[second], number[first], share))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        #: For each token, its bigram.
        self.at = place[at]
        first, second = first[order], second[order]
        self.share, self.spread = share[order], spread[order]
        self.first, self.second = number[first], number[second]
        self.first_count, self.second_count = count[first], count[second]
        train = np.repeat(~self.out, np.diff(self.bounds))
        self.train = np.bincount(self.at[train], minlength=len(order))
        #: Where a context begins within a share, and the context of each bigram.
        self.opens = np.ones(len(order), dtype=bool)
        self.opens[1:] = (np.diff(self.first) != 0) | (np.diff(self.share) != 0)


def _ask_bigrams(
    batches: Iterator[pa.RecordBatch], shares: int, spread_above: int
) -> Iterator[pa.RecordBatch]:
    for name, rows in _by_target(batches):
        block = Block(rows, shares, spread_above)
        cuts = np.flatnonzero(np.diff(block.share, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(block.share)), strict=True):
            part = slice(a, b)
            known = np.where(block.train[part] > 0, block.second_count[part], 0)
            opens = block.opens[part]
            sizes = np.diff(np.append(np.flatnonzero(opens), b - a))
            data = pack(
                _deltas(block.first[part][opens]), sizes, block.first_count[part][opens],
                block.second[part], block.train[part], known,
            )
            yield _row(ASK_WORDS, block.share[a], name, None, data)


def _sums_by(group: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    np.add.at(out, group, values)
    return out


def _answer_bigrams(
    batches: Iterator[pa.RecordBatch], unigrams: Unigrams, spread_above: int
) -> Iterator[pa.RecordBatch]:
    """Counts of a share's bigrams and what the weights of its contexts are made of."""
    for to, rows in _by_target(batches):
        asked = [unpack(row["data"]) for row in rows]
        contexts = [np.cumsum(a[0]) for a in asked]
        first = np.concatenate([np.repeat(c, a[1]) for c, a in zip(contexts, asked, strict=True)])
        second, train, known = (np.concatenate([a[i] for a in asked]) for i in (3, 4, 5))
        order = np.lexsort((second, first))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
        lead = np.flatnonzero(new)
        counts = np.add.reduceat(train[order], lead)
        known = np.maximum.reduceat(known[order], lead)
        first_of, second_of = first[order][lead], second[order][lead]
        at = np.empty(len(order), dtype=np.int64)
        at[order] = np.cumsum(new) - 1

        seen = counts > 0
        context, group = np.unique(first_of, return_inverse=True)
        n, own, c1, c2 = len(context), group[seen], known[seen], counts[seen]
        sums = np.stack(
            [
                _sums_by(own, n, c1 * (c1 > KATZ_LIMIT)),
                *(_sums_by(own, n, c1 > KATZ_LIMIT) if r == 0 else _sums_by(own, n, c1 == r)
                  for r in range(KATZ_LIMIT + 1)),
                *(_sums_by(own, n, c2 > KATZ_LIMIT) if r == 0 else _sums_by(own, n, c2 == r)
                  for r in range(KATZ_LIMIT + 1)),
            ],
            axis=1,
        )
        unseen = unigrams.unseen(sums[:, : KATZ_LIMIT + 2])
        left = sums[:, KATZ_LIMIT + 2 :]
        total = np.zeros(n, dtype=np.int64)
        for c, a in zip(contexts, asked, strict=True):
            total[np.searchsorted(context, c)] = a[2]
        spread = total > spread_above
        for i in np.flatnonzero(spread):
            yield _row(SPREAD, context[i], to, sums[i].tolist())
        frequencies = list(map(int, _by_count(counts)))
        table = pack(_deltas(first_of[seen]), second_of[seen], c2)
        yield _row(BIGRAMS, to, 0, frequencies, table)
        start = 0
        for row, c, a in zip(rows, contexts, asked, strict=True):
            part = at[start : start + len(a[3])]
            start += len(a[3])
            # A spread context has its sums from all shares together.
            own = np.searchsorted(context, c)
            own = own[~spread[own]]
            answer = pack(counts[part], unseen[own], left[own].ravel())
            yield _row(BIGRAM_COUNTS, row["block"], to, None, answer)


def _logs(
    block: Block,
    rows: list[dict],
    unigrams: Unigrams,
    bigrams: Discounts,
    spread: dict[int, list[int]],
) -> tuple[np.ndarray, np.ndarray]:
    """log10 of each distinct bigram's probability, and of each token's as the base has it."""
    answers = sorted((r for r in rows if r["kind"] == BIGRAM_COUNTS), key=lambda r: r["block"])
    answers = [unpack(row["data"]) for row in answers]
    counts = np.concatenate([a[0] for a in answers])
    opens = np.flatnonzero(block.opens)
    spread_out = block.spread[opens]
    width = KATZ_LIMIT + 1
    unseen = np.zeros(len(opens))
    left = np.zeros((len(opens), width), dtype=np.int64)
    unseen[~spread_out] = np.concatenate([a[1].view(np.float64) for a in answers])
    left[~spread_out] = np.concatenate([a[2] for a in answers]).reshape(-1, width)
    if spread_out.any():
        names, own = np.unique(block.first[opens[spread_out]], return_inverse=True)
        sums = np.array([spread[int(name)] for name in names])
        unseen[spread_out] = unigrams.unseen(sums[:, : width + 1])[own]
        left[spread_out] = sums[:, width + 1 :][own]
    context = np.cumsum(block.opens) - 1
    total = block.first_count[opens]
    mass = bigrams.left(left[:, 1:], left[:, 0])
    # Where nothing is discounted, one more token stands for the unseen words.
    short = mass <= 0
    scale = np.where(short, total / (total + 1), 1.0) / np.maximum(1, total)
    mass = np.where(short, 1 / (total + 1), mass / np.maximum(1, total))
    weight = np.where(total > 0, mass / unseen, 1.0)
    lower = unigrams.probability(block.second_count)
    seen = bigrams.shares(counts) * scale[context]
    probability = np.where(counts > 0, seen, weight[context] * lower)
    base = (block.unigrams + 1) / (unigrams.tokens + unigrams.kinds + 1)
    return np.log10(probability), np.log10(base)


def _score(
    batches: Iterator[pa.RecordBatch],
    shares: int,
    spread_above: int,
    unigrams: Unigrams,
    bigrams: Discounts,
    spread: dict[int, list[int]],
) -> Iterator[pa.RecordBatch]:
    for _, rows in _by_target(batches):
        block = Block(rows, shares, spread_above)
        logs, base = _logs(block, rows, unigrams, bigrams, spread)
        cuts = block.bounds[:-1]
        yield pa.record_batch(
            [
                pa.array(block.ids, pa.int64()),
                pa.array(block.out),
                pa.array(np.diff(block.bounds)),
                pa.array(np.add.reduceat((block.unigrams > 0).astype(np.int64), cuts)),
                pa.array(np.add.reduceat(base, cuts)),
                pa.array(np.add.reduceat(logs[block.at], cuts)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows as a table partitioned by kind."""
    path = work_dir(rows.sparkSession, name)
    rows.write.partitionBy("kind").parquet(path)
    return rows.sparkSession.read.schema(_ROWS).parquet(path)


def _sums(rows: DataFrame, by: str | None = None) -> list:
    """Lists of ``ids`` added up by position, over all rows or by a column."""
    places = rows.select(*([by] if by else []), F.posexplode("ids").alias("place", "n"))
    keys = [*([by] if by else []), "place"]
    return places.groupBy(*keys).agg(F.sum("n").alias("n")).orderBy(*keys).collect()


def score(
    docs: DataFrame,
    block_tokens: int = BLOCK_TOKENS,
    bigram_tokens: int = BIGRAM_TOKENS,
    word_tokens: int = WORD_TOKENS,
    spread_tokens: int = SPREAD_TOKENS,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    ``docs`` is ``(doc_id long, text, held_out boolean)``, read twice; pass a stored table,
    as a block's name rests on its task's place in the input. Rows not ``held_out`` are
    learnt from. ``score`` is the model's log10 probability of the whole text, ``base_score``
    that of an add-one model of single words. Null texts are empty, a null flag is false;
    rows that repeat an id or a text all count; null ids are kept. An empty table gives an
    empty result; without anything to learn from, every word has the probability of an
    unknown one. Other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_BYTES)
    held = F.coalesce("held_out", F.lit(False)).alias("held")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held)
    size = texts.agg(F.sum(F.octet_length("text")) + F.count(F.lit(1))).first()[0] or 0
    tokens = size // TOKEN_BYTES
    word_shares, shares = 1 + tokens // word_tokens, 1 + tokens // bigram_tokens
    limit = spread_tokens

    def dealt(rows: DataFrame, n: int) -> DataFrame:
        return rows.repartition(n, "to").sortWithinPartitions("to", "block")

    emitted = texts.mapInArrow(lambda b: _emit_blocks(b, word_shares, block_tokens), _ROWS)
    emitted = _stored(emitted, "blocks")
    asked = emitted.filter(F.col("kind") == ASK_WORDS)
    words = dealt(asked, word_shares).mapInArrow(lambda b: _answer_words(b, word_shares), _ROWS)
    words = _stored(words, "unigrams")
    found = [row.n for row in _sums(words.filter(F.col("kind") == UNIGRAMS))]
    n, kinds, large, large_tokens, *frequencies = found or [0] * (KATZ_LIMIT + 5)
    known = discounts(frequencies)
    unigrams = Unigrams(n, kinds, tuple(frequencies[:KATZ_LIMIT]), large, large_tokens, known)
    spread_above = max(limit, n // MAX_SPREAD)

    numbered = emitted.filter(F.col("kind") == TEXTS).unionByName(
        words.filter(F.col("kind") == WORDS)
    )
    questions = dealt(numbered, shares).mapInArrow(
        lambda b: _ask_bigrams(b, shares, spread_above), _ROWS
    )
    bigrams = dealt(questions, shares).mapInArrow(
        lambda b: _answer_bigrams(b, unigrams, spread_above), _ROWS
    )
    bigrams = _stored(bigrams, "bigrams")
    counts = [row.n for row in _sums(bigrams.filter(F.col("kind") == BIGRAMS))]
    discounted = discounts(counts or [0] * (KATZ_LIMIT + 1))
    spread: dict[int, list[int]] = {}
    # One row of sums for each spread context, of which MAX_SPREAD bounds the number.
    for row in _sums(bigrams.filter(F.col("kind") == SPREAD), "to"):
        spread.setdefault(row.to, []).append(row.n)

    answered = numbered.unionByName(bigrams.filter(F.col("kind") == BIGRAM_COUNTS))
    scored = dealt(answered, shares).mapInArrow(
        lambda b: _score(b, shares, spread_above, unigrams, discounted, spread),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
        "score double",
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        "base_score", "score",
    )


def split(docs: DataFrame, parts: int = 7, part: int = 2) -> DataFrame:
    """``docs`` with ``held_out``: the CRC-32 of the id as text leaves ``part``; a null id
    does not."""
    rest = F.crc32(F.col("doc_id").cast("string")) % parts
    return docs.withColumn("held_out", F.coalesce(rest == part, F.lit(False)))
