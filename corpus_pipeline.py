"""From raw documents to token ids: the stages of a training corpus, in order.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame. All stages but the last return the columns of ``docs``. ``run`` writes
what a stage returns as Parquet in the shared folder and gives it, read again, to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import bpe, jaccard, lines, mixing, quality
from reelrank.llm.queries import tokenizer, trusted_documents
from reelrank.sources.durable import durable


def _apart(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that an operator uses, and all others in one, so that no name of theirs can
    meet one of the operator's own."""
    others = [name for name in docs.columns if name not in used]
    kept = [name for name in docs.columns if name in used]
    return docs.select(*kept, F.struct(*others).alias("others")) if others else docs


def _together(rows: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(
        *(name if name in used else F.col("others").getField(name).alias(name)
          for name in docs.columns)
    )


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the labelled good ones are the target."""
    used = ("doc_id", "text")
    judged = quality.quality(_apart(docs, *used), trusted_documents(spark, sf_dir))
    return _together(quality.accepted(judged), docs, *used)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that many sources share."""
    used = ("doc_id", "text", "source", "n_chars")
    return _together(lines.line_dedup(_apart(docs, *used)), docs, *used)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that with the least ``doc_id``."""
    return jaccard.keep_one(docs).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document has one row for each time it is taken."""
    used = ("doc_id", "text", "source")
    parted = _apart(docs, *used)
    return _together(mixing.repeated(mixing.mix(parted), parted.columns), docs, *used)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the text decoded from them."""
    content = tokenizer()
    kept = ["doc_id", "lang", "source"]
    encoded = bpe.encode(docs.select(*kept, "text"), content, columns=kept)
    return bpe.digests(bpe.decode(encoded, content)).drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("bpe_tokens", bpe_tokens),
]

#: SQL has none of the hashes, normal forms and merges that the stages rest on.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
