import corpus_pipeline
from reelrank.llm import queries

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, DATA)
        assert docs.columns == columns, name
        sizes.append(docs.count())
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
    assert sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[3] < sizes[2]


def test_run(spark):
    out = corpus_pipeline.run(spark, DATA)
    rows = out.collect()
    assert rows and all(row.n_tokens == len(row.ids) for row in rows)


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())
