"""The document source: collections by option, upserts by id, commits in two phases."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from reelrank.jobs import load
from reelrank.operators import search_docs
from reelrank.sources import documents, schemas
from reelrank.sources import store as stores

SCHEMA = "mid int, name string, recs array<struct<mid:int,r:double>>"
DOCS = [(n, f"n{n}", [(n + 1, 0.5)] if n % 3 else None) for n in range(50)]


@pytest.fixture
def sink(spark, tmp_path):
    spark.dataSource.register(documents.DocumentSource)
    return stores.TableStore("", documents.FORMAT, {"path": str(tmp_path), "shares": "4"}, "resource")


def read(spark, sink, table="Things"):
    frame = spark.createDataFrame([], SCHEMA)
    return {row.mid: (row.name, row.recs) for row in sink.read(spark, table, frame.schema).collect()}


def test_overlapping_upserts(spark, sink):
    frame = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    keyed = {"id": "mid"}
    assert read(spark, sink) == {}
    sink.upsert(frame, "Things", keyed)
    sink.upsert(frame.filter("mid < 20").withColumn("name", F.lit("second")), "Things", keyed)
    more = spark.createDataFrame([(10, "third", None), (77, "new", [(1, 2.0)])], SCHEMA)
    sink.upsert(more, "Things", keyed)
    found = read(spark, sink)
    assert len(found) == 51
    assert found[10] == ("third", None) and found[5][0] == "second" and found[30][0] == "n30"
    assert found[77][1][0].r == 2.0 and found[4][1][0].mid == 5
    # The same upsert again changes nothing.
    sink.upsert(more, "Things", keyed)
    assert read(spark, sink) == found
    with pytest.raises(Exception, match="keyed by mid"):
        sink.upsert(more, "Things", {"id": "name"})
    # An overwrite replaces all; other collections are not touched.
    sink.upsert(frame, "Others", keyed)
    stores.TableStore("", sink.format, {**sink.options, **keyed}, "resource").replace(more, "Things")
    assert set(read(spark, sink)) == {10, 77} and len(read(spark, sink, "Others")) == 50


def test_writes_that_fail_are_not_seen(spark, sink, tmp_path):
    frame = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    sink.upsert(frame, "Things", {"id": "mid"})

    def broken(batches):
        for number, batch in enumerate(batches):
            yield batch
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        sink.upsert(frame.mapInArrow(broken, frame.schema), "Things", {"id": "mid"})
    assert len(read(spark, sink)) == 50
    # Files that no commit lists, as of a task that ran twice, are not read.
    commit = next(name for name in os.listdir(tmp_path / "Things") if name.isdigit())
    (tmp_path / "Things" / commit / "0-again.jsonl").write_text('{"mid": 999, "name": "x"}\n')
    (tmp_path / "Things" / "pending-x").mkdir()
    assert set(read(spark, sink)) == set(range(50))


def test_load_job_writes_the_search_index(spark, sink, tmp_path):
    (tmp_path / "m").write_text("1^a^^^^^^Drama^^\n2^b^^^^^^War^^\n")
    (tmp_path / "r").write_text("1,1,2.0,3\n")
    (tmp_path / "t").write_text("1,2,fun,3\n1,2,old,4\n")
    tables = stores.TableStore(str(tmp_path / "store"))
    for _ in range(2):
        load.run(spark, *(str(tmp_path / n) for n in "mrt"), tables, sink, "id")
    found = sink.read(spark, schemas.SEARCH_TABLE, schemas.SEARCH_DOCUMENT)
    expected = search_docs.search_documents(stores.movies(spark, tables), stores.tags(spark, tables))
    assert rows(found.fillna("-")) == rows(expected.fillna("-"))
    assert {row.mid: row.tags for row in found.collect()} == {1: None, 2: "fun|old"}
