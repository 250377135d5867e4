"""Repeated and negative ids, clashing columns: the cases that were lost once."""

import hashlib
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelrank.llm import jaccard, neardup, substring

from .conftest import make

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_substring_dedup_of_rows_that_share_an_id(spark):
    passage = " ".join(f"p{n}" for n in range(20))
    rows = [
        (1, passage + " one"),
        (2, "short"),
        (2, "a b c " + passage + " tail"),
        (2, passage),
        (2, None),
        (2, "a b c " + passage + " tail"),
        (-3, "front " + passage),
        (5, ""),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(tuple(r) for r in substring.substring_dedup(frame).collect())

    windows = {}
    for doc, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - 12):
            key = tuple(words[i : i + 13])
            windows[key] = min(windows.get(key, doc), doc)
    expected = []
    for doc, text in rows:
        words = WORD.findall(text or "")
        gone = {
            i + k
            for i in range(len(words) - 12)
            if windows[tuple(words[i : i + 13])] < doc
            for k in range(13)
        }
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        expected.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert found == sorted(expected)


def test_equal_documents_with_negative_ids_link(spark):
    text = "one two three four five six seven"
    rows = [(-5, text), (-3, text), (-1, text.upper()), (-2, "other words"), (-1000, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(frame).collect()}
    assert found == {-5: -5, -3: -5, -1: -5, -2: -2, -1000: -1000}


def test_vectors_that_share_an_id_have_a_row_each(spark):
    rows = [(1, [1.0, 0.0], 0), (1, None, 0), (1, [0.0, 0.0], 0), (2, [1.0, 0.01], 0), (2, [1.0, 0.0], None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted(tuple(r) for r in neardup.near_duplicates(frame).collect())
    assert found == [(1, 0, 1, True), (1, 0, 1, True), (1, 1, 1, True), (2, 0, 2, True), (2, 1, 1, False)]


@pytest.mark.parametrize("stage", range(4))
def test_stages_leave_clashing_columns_alone(spark, stage):
    names = ["words", "_one", "_two", "score", "kept", "_flag", "_drop", "n_lines", "n_removed",
             "_text", "size", "target", "taken", "_order", "_name", "component_id", "others"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(120)
    odd = docs.select("*", *[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in names])
    _, function = corpus_pipeline.STAGES[stage]
    plain = function(spark, docs, DATA)
    found = function(spark, odd, DATA)
    assert found.columns == odd.columns
    assert found.filter(" or ".join(f"{n} <> '{n}-' || doc_id" for n in names)).count() == 0
    assert sorted(found.select(*docs.columns).collect()) == sorted(plain.collect())
    empty = function(spark, odd.limit(0), DATA)
    assert empty.collect() == [] and empty.columns == odd.columns


def test_the_last_stage_on_nothing(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    assert corpus_pipeline.bpe_tokens(spark, docs, DATA).collect() == []


def test_substring_dedup_keeps_no_shuffle_files(spark, texts):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    folders = [Path(str(folder)) for folder in manager.diskBlockManager().localDirs()]
    shuffled = lambda: {f.name for d in folders for f in d.rglob("shuffle_*.data")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, value = shuffled(), spark.conf.get(setting, None)
    repeats = substring.repeated_windows(make(spark, texts).repartition(3))
    until = time.time() + 20
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert repeats.count() > 0 and spark.conf.get(setting, None) == value
