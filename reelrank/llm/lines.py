"""Line dedup: boilerplate lines that occur on many distinct sites.

Each line is hashed; one HyperLogLog sketch of its sites per hash is built in the map tasks
and merged by aggregation, so a line costs a few bytes however often it occurs. Sketches are
estimates: lines near the threshold get an exact count of distinct sites before anything is
removed. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.sources.durable import durable

#: Distinct sites from which a line is boilerplate.
MIN_SITES = 10
#: log2 of the sketch's registers; sketches of few sites are short lists of coupons.
LG_K = 6
#: Estimates within this share of the threshold are replaced by exact counts: four
#: standard errors (1.04 / sqrt(2**LG_K) each).
MARGIN = 0.52


def _solid(line: Column) -> Column:
    return F.rlike(line, F.lit("[^\\x20\\x09-\\x0D]"))


def _line_keys(text: Column) -> Column:
    """Keys of the distinct lines of ``text`` that have a word."""
    lines = F.filter(F.split(text, "\n", -1), _solid)
    return F.array_distinct(F.transform(lines, lambda line: F.xxhash64(line)))


def boilerplate_lines(
    docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, margin: float = MARGIN
) -> DataFrame:
    """``(line, n_sites)``: keys of the lines on ``min_sites`` distinct sites or more.

    Rows whose site is null add no site. ``n_sites`` is exact for lines near the threshold
    and the sketch's estimate beyond it.
    """
    sited = docs.filter(F.col(site).isNotNull()).select(
        F.xxhash64(site).alias("site"), F.explode(_line_keys(F.col("text"))).alias("line")
    )
    sketches = sited.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    spread = durable(
        sketches.withColumn("sites", F.hll_sketch_estimate("sketch"))
        .filter(F.col("sites") >= min_sites * (1 - margin))
        .select("line", "sites"),
        "line-sites",
    )
    near = spread.filter(F.col("sites") <= min_sites * (1 + margin)).select("line")
    exact = (
        sited.join(near, "line", "left_semi")
        .distinct()
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("n_sites"))
        .filter(F.col("n_sites") >= min_sites)
    )
    wide = spread.filter(F.col("sites") > min_sites * (1 + margin))
    return exact.unionByName(wide.select("line", F.col("sites").alias("n_sites")))


def line_dedup(
    docs: DataFrame,
    site: str = "source",
    min_sites: int = MIN_SITES,
    margin: float = MARGIN,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``.

    A line is what ``\\n`` separates; lines count as equal when all their characters are.
    Lines without a word stay. Of each boilerplate line, what stands in the document with the
    smallest ``doc_id`` stays too, so that no text is lost to the corpus; a null ``doc_id``
    is never the smallest. Adds ``n_lines`` (lines with a word), ``n_removed`` and, for
    ``n_chars`` if present, the new length. A null text stays null; an empty table gives an
    empty result; rows with one ``doc_id`` are cleaned alike. Columns named like a result give
    way.
    """
    plain = docs.drop("n_lines", "n_removed")
    found = durable(boilerplate_lines(plain, site, min_sites, margin), "boilerplate")
    keyed = plain.select("doc_id", F.explode(_line_keys(F.col("text"))).alias("line"))
    hits = durable(keyed.join(found.select("line"), "line"), "hits")
    firsts = hits.groupBy("line").agg(F.min("doc_id").alias("first_doc"))
    per_doc = (
        hits.join(firsts, "line")
        .filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
    )
    return _clean(plain, per_doc)


def _clean(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """``docs`` without the lines ``drops (doc_id, line)``."""
    lists = drops.groupBy("doc_id").agg(F.collect_set("line").alias("_drop"))
    joined = docs.join(lists, docs["doc_id"].eqNullSafe(lists["doc_id"]), "left").drop(
        lists["doc_id"]
    )
    lines = F.split("text", "\n", -1)
    drop = F.coalesce("_drop", F.array().cast("array<bigint>"))
    kept = F.filter(lines, lambda line: ~(_solid(line) & F.array_contains(drop, F.xxhash64(line))))
    has = F.size(drop) > 0
    text = F.when(has, F.array_join(kept, "\n")).otherwise(F.col("text"))
    solid = lambda x: F.coalesce(F.size(F.filter(x, _solid)), F.lit(0)).cast("long")
    out = (
        joined.withColumn("n_lines", solid(lines))
        .withColumn("_text", text)
        .withColumn("n_removed", F.col("n_lines") - solid(F.split("_text", "\n", -1)))
        .withColumn("text", F.col("_text"))
        .drop("_text", "_drop")
    )
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("text").cast(kind)
        chars = F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", chars)
    return out.select(*docs.columns, "n_lines", "n_removed")
