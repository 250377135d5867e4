"""Mixing sources to target weights by capped water-filling.

Each source's target is its weight's share of the budget, but at most ``max_epochs`` times
its size; what a clamped source cannot take is shared among the rest by weight, again and
again until no source is above its cap. A source's target is then met by whole repetitions
of all its documents and a fractional one: documents in seeded hash order up to the point
where the target is reached.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.llm.words import word_count

#: Weights of the sources in code point order, repeating; null comes last.
WEIGHTS = (5.0, 2.0, 1.0)
#: The mix as a share of all sizes.
BUDGET = 1.5
MAX_EPOCHS = 2.0
SEED = 20_240_601
#: A source's documents fall into 4096 ranges of their seeded hash. Sizes are summed by range
#: first, and documents are put in order within a range only: no hot source is sorted whole.
RANGE_SHIFT = 52


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """``(_name, source, source_size, target)`` from ``sizes (_name, source, source_size)``.

    The loop is closed by one ordering: sources fill up in order of cap / weight, so the
    clamped ones are a prefix of that order. A source is clamped when, with all before it
    at their caps, its share of what is left still exceeds its own cap. The windows run
    over one row per source, never over documents. Sources are ordered by code point.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    share = (F.col("_budget") - F.col("_before")) * F.col("_w") / F.col("_rest")
    marked = (
        sizes.withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_budget", F.sum("source_size").over(everything) * budget)
        .withColumn("_before", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_rest", F.sum("_w").over(onward))
        .withColumn("_full", share >= F.col("_cap"))
    )
    full, free = F.col("_full"), ~F.col("_full")
    left = F.max("_budget").over(everything) - F.coalesce(
        F.sum(F.when(full, F.col("_cap"))).over(everything), F.lit(0.0)
    )
    level = left / F.sum(F.when(free, F.col("_w"))).over(everything)
    return marked.withColumn(
        "target",
        F.when(full, F.col("_cap")).otherwise(F.least("_cap", F.col("_w") * level)),
    ).select("_name", "source", "source_size", "target")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    budget: float = BUDGET,
    max_epochs: float = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats
    counted).

    Every document is taken ``floor(target / source_size)`` times whole. The rest of the
    target goes to documents in the order of a seeded hash of ``doc_id`` and text, ties by
    ``doc_id``; the last of them is taken in part, so that a source's words come to its
    target rounded down. Rows that are equal in both share their place in the order and are
    taken alike as far as the target goes. Null text has size 0; null is a source of its
    own; empty sources have target 0. Columns named like a result give way to it.
    """
    plain = docs.drop("size", "source_size", "target", "taken")
    sized = (
        plain.withColumn("size", word_count(F.col("text")))
        .withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "text"))
        .withColumn("_range", F.shiftrightunsigned("_order", RANGE_SHIFT).cast("int"))
        .withColumn("_name", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    )
    ranges = sized.groupBy("_name", "_range").agg(
        F.sum("size").alias("_words"), F.first("source").alias("source")
    )
    sizes = ranges.groupBy("_name").agg(
        F.sum("_words").alias("source_size"), F.first("source").alias("source")
    )
    targets = source_targets(sizes, weights, budget, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = targets.withColumn("_whole", F.coalesce(whole, F.lit(0)).cast("long")).withColumn(
        "_part", F.floor("target").cast("long") - F.col("_whole") * F.col("source_size")
    )
    # Words that each range may give to the fractional repetition.
    earlier = (
        Window.partitionBy("_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    shares = (
        ranges.withColumn("_start", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
        .join(targets.drop("source"), "_name")
        .withColumn("_give", F.greatest(F.lit(0), F.col("_part") - F.col("_start")))
        .select("_name", "_range", "source_size", "target", "_whole", "_give")
    )
    running = (
        Window.partitionBy("_name", "_range")
        .orderBy("_order", "doc_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    left = F.col("_give") - F.coalesce(F.sum("size").over(running), F.lit(0))
    extra = F.greatest(F.lit(0), F.least("size", left))
    return (
        sized.join(shares, ["_name", "_range"])
        .withColumn("taken", (F.col("_whole") * F.col("size") + extra).cast("long"))
        .select(*plain.columns, "size", "source_size", "target", "taken")
    )


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: one row per repetition, with ``columns``.

    A document taken in part is given whole if at least half of it is taken.
    """
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5))
    return mixed.withColumn("_times", F.coalesce(times, F.lit(0)).cast("int")).select(
        *columns, F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_copy")
    ).drop("_copy")
