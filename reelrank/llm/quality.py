"""Quality rules: base rules, then a log-likelihood ratio of hashed word n-grams.

Two multinomials over ``buckets`` hashed n-grams (single words and pairs of neighbours) are estimated: one from trusted documents, one from the whole corpus. A document's score is
the sum of log(target / raw) over its n-grams divided by their number; every document is
kept or not by comparing the score with a fixed threshold, so reruns agree. DataFrame
functions only: texts never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.words import split_words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
BUCKETS = 10_000
#: Counts added to every bucket of either multinomial.
SMOOTHING = 1.0
#: Least mean log-ratio per n-gram. The corpus holds the trusted text too, so ordinary text
#: scores near 0; text whose n-grams are twice as common in the corpus as in trusted
#: documents scores -0.69. Labelled good text stays over -0.1, labelled junk lies mostly below -0.16.
THRESHOLD = -0.15


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(ordered: Column) -> Column:
    """Words covered by the windows that have an equal neighbour in ``ordered``."""

    def twin(window: Column, at: Column) -> Column:
        before = F.get(ordered, at - 1)["h"] == window["h"]
        after = F.get(ordered, at + 1)["h"] == window["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    places = F.sort_array(F.transform(F.filter(ordered, twin), lambda window: window["i"]))
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-REPEAT_WINDOW).alias("at")),
        lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(REPEAT_WINDOW), at - acc["at"])).alias("n"),
            at.alias("at"),
        ),
        lambda acc: acc["n"].cast("long"),
    )


def _joined(hashes: Column, distance: int) -> Column:
    """Hash of each item with the one ``distance`` places on; shorter by ``distance``."""
    count = F.greatest(F.size(hashes) - distance, F.lit(0))
    pairs = F.zip_with(
        F.slice(hashes, 1, count),
        F.slice(hashes, distance + 1, count),
        lambda a, b: F.xxhash64(a, b),
    )
    return pairs


def _repeated_words(pairs: Column) -> Column:
    """Words inside windows of 8 words that occur twice or more in the text.

    ``pairs`` has the hashes of neighbouring words. Windows are compared by 64-bit hash.
    Only texts with a repeat sort their windows.
    """
    none = F.lit(0).cast("long")
    windows = _let(_let(pairs, lambda two: _joined(two, 2)), lambda four: _joined(four, 4))

    def counted(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeats, _let(F.sort_array(placed), _covered)).otherwise(none)

    return F.when(
        F.size(pairs) >= REPEAT_WINDOW, _let(windows, counted)
    ).otherwise(none)


def hashed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``words`` and the hashes ``_one`` of words, ``_two`` of word pairs."""
    return (
        docs.withColumn("words", split_words(F.col("text")))
        .withColumn("_one", F.transform("words", lambda word: F.xxhash64(word)))
        .withColumn("_two", _joined(F.col("_one"), 1))
    )


def base_rules(docs: DataFrame) -> DataFrame:
    """What :func:`hashed` gives, with the base measures; a null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(
        F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit("[^\\x20\\x09-\\x0D]"))
    )
    symbols = F.regexp_replace(text, f"[^{SYMBOLS}]+", "")
    repeated = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return (
        docs.withColumn("n_words", F.size("words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
        .withColumn("n_symbols", F.length(symbols).cast("long"))
        .withColumn("n_dup_lines", repeated.cast("long"))
        .withColumn("n_repeat_words", _repeated_words(F.col("_two")))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
    )


def _ngrams() -> Column:
    """Hashes of all words and word pairs."""
    return F.concat("_one", "_two")


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row, ``ratios array<double>``: log(target / raw) of each bucket.

    ``docs`` comes from :func:`hashed`. The raw counts cover all words of all documents,
    added up in each task before ``buckets`` rows at most leave it. ``trusted`` (``doc_id``)
    names the trusted documents, which all count. To meet them a document travels as its
    buckets, two bytes each; ids of either side are dealt by hash, so neither is bounded.
    """
    ids = trusted.select("doc_id").filter("doc_id is not null").distinct()
    kind = "short" if buckets <= 1 << 15 else "int"
    placed = F.transform(_ngrams(), lambda h: F.pmod(h, F.lit(buckets)).cast(kind))
    known = docs.select("doc_id", placed.alias("placed")).join(
        ids.hint("shuffle_hash"), "doc_id", "left_semi"
    )
    raw = (
        docs.select(F.explode(_ngrams()).alias("h"))
        .groupBy(F.pmod("h", F.lit(buckets)).cast("int").alias("b"))
        .agg(F.count(F.lit(1)).alias("raw"))
    )
    target = (
        known.select(F.explode("placed").alias("b"))
        .groupBy(F.col("b").cast("int").alias("b"))
        .agg(F.count(F.lit(1)).alias("target"))
    )
    counts = raw.join(target, "b", "left")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    filled = every.join(F.broadcast(counts), "b", "left").select(
        "b",
        (F.coalesce("raw", F.lit(0)) + SMOOTHING).alias("raw"),
        (F.coalesce("target", F.lit(0)) + SMOOTHING).alias("target"),
    )
    rows = filled.agg(
        F.sort_array(F.collect_list(F.struct("b", "raw", "target"))).alias("rows"),
        F.log(F.sum("raw") / F.sum("target")).alias("shift"),
    )
    return rows.select(
        F.transform(
            "rows", lambda row: F.log(row["target"] / row["raw"]) + F.col("shift")
        ).alias("ratios")
    )


def accepted(judged: DataFrame) -> DataFrame:
    """The rows of what :func:`quality` gives that are kept.

    An explode of one flag instead of a filter: Catalyst would push a filter below the
    measures and compute each of them again wherever the verdict uses it.
    """
    flags = F.filter(F.array("kept"), lambda kept: kept)
    return judged.select("*", F.explode(flags).alias("_flag")).drop("_flag")


def quality(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
) -> DataFrame:
    """All columns of ``docs`` with the measures, ``base_failed``, ``score`` and ``kept``.

    ``docs`` has ``doc_id`` and ``text``; rows may repeat and each gets its own result.
    ``kept`` is false where a base rule fails, else it tells whether ``score`` reaches
    ``threshold``. A text without words scores 0 and fails the base rules. Without trusted
    documents the target is uniform. Columns that share a name with a result give way to it.
    """
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    plain = docs.drop("words", "_one", "_two", *results, "base_failed", "score", "kept")
    grams = hashed(plain)
    ratios = log_ratios(grams, trusted, buckets).scalar()
    total = F.aggregate(
        _ngrams(),
        F.lit(0.0),
        lambda acc, h: acc + F.get(F.col("_ratios"), F.pmod(h, F.lit(buckets)).cast("int")),
    )
    score = total / (F.size("_one") + F.size("_two"))
    return (
        base_rules(grams)
        .withColumn("_ratios", ratios)
        .withColumn(
            "score", F.when(F.col("n_words") > 0, F.round(score, 9)).otherwise(F.lit(0.0))
        )
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
        .drop("_ratios", "words", "_one", "_two")
    )
