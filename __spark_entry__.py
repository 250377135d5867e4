"""

Each query runs over whole tables; the SQL gives the same result from the same files. Model
training starts from random factors, so the queries that train one have no SQL.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank import fixtures
from reelrank.functions.text import encode_recs
from reelrank.functions.vectors import is_finite
from reelrank.jobs import statistics as statistics_job
from reelrank.operators import (
    evaluate,
    factors,
    ingest,
    scoring,
    search_docs,
    similarity,
    stats,
    topn,
)
from reelrank.sources import documents as document_source
from reelrank.sources import events as event_sources
from reelrank.sources import schemas, store
from reelrank.sources.durable import durable, work_dir
from reelrank.streaming import recents
from reelrank.streaming.rescoring import Rescoring
from reelrank.streaming.upsert import latest_recs

# The test embeddings are less alike than trained factors: none reaches the default.
EMBEDDING_THRESHOLD = 0.3
# Events before this moment form the first of two batches.
SECOND_BATCH = "2024-01-16 00:00:00"
# Buckets of the stored tables that batches read; by their size there would be one.
BUCKETS = 8
# Micro-batches of the stream over all events, and files of each.
MICRO_BATCHES, BATCH_FILES = 2, 4


def _from_text(spark: SparkSession, rows: DataFrame, separator: str, parse) -> DataFrame:
    """Write rows as text files, then read and parse those."""
    path = work_dir(spark, "text")
    fixtures.as_lines(rows, separator).write.text(path)
    return parse(store.read_lines(spark, path))


def ingest_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_text(spark, fixtures.movies(spark, sf_dir), "^", ingest.parse_movies)


def ingest_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_text(spark, fixtures.ratings(spark, sf_dir), ",", ingest.parse_ratings)


def ingest_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_text(spark, fixtures.tags(spark, sf_dir), ",", ingest.parse_tags)


def store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables written and read back, as one table."""
    target = store.TableStore(work_dir(spark, "store"))
    store.store_tables(
        target,
        fixtures.movies(spark, sf_dir),
        fixtures.ratings(spark, sf_dir),
        fixtures.tags(spark, sf_dir),
    )

    def rows(name: str, df: DataFrame, **columns: str) -> DataFrame:
        picked = {
            "uid": ("int", "-1"),
            "mid": ("int", "-1"),
            "text": ("string", "''"),
            "num": ("double", "0"),
            "ts": ("int", "-1"),
        }
        return df.select(
            F.lit(name).alias("tbl"),
            *[
                F.expr(columns.get(column, empty)).cast(kind).alias(column)
                for column, (kind, empty) in picked.items()
            ],
        )

    return (
        rows("Movie", store.movies(spark, target), mid="mid", text="concat(name, '^', genres)")
        .unionByName(
            rows("Rating", store.ratings(spark, target), uid="uid", mid="mid", num="score",
                 ts="timestamp")
        )
        .unionByName(
            rows("Tag", store.tags(spark, target), uid="uid", mid="mid", text="tag",
                 ts="timestamp")
        )
    )


def movie_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_docs.movie_tags(fixtures.tags(spark, sf_dir))


def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_docs.search_documents(
        fixtures.movies(spark, sf_dir), fixtures.tags(spark, sf_dir)
    )


def search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search documents as the sink holds them, in a document format."""
    sink = store.TableStore(work_dir(spark, "search"), "json")
    store.write_search_documents(search_documents(spark, sf_dir), sink)
    return sink.read(spark, schemas.SEARCH_TABLE, schemas.SEARCH_DOCUMENT)


def document_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search documents in a document store, after two overlapping upserts by ``mid``."""
    spark.dataSource.register(document_source.DocumentSource)
    keyed = {"path": work_dir(spark, "documents")}
    sink = store.TableStore("", document_source.FORMAT, keyed, "resource")
    docs = durable(search_documents(spark, sf_dir), "search")
    store.write_search_documents(docs, sink, id_option="id")
    for every, language in ((3, "French"), (5, "German")):
        changed = docs.filter(F.col("mid") % every == 0).withColumn("language", F.lit(language))
        sink.upsert(changed, schemas.SEARCH_TABLE, {"id": "mid"})
    return sink.read(spark, schemas.SEARCH_TABLE, schemas.SEARCH_DOCUMENT)


def rate_more_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rate_more_movies(fixtures.ratings(spark, sf_dir))


def rate_more_recently(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rate_more_recently(fixtures.ratings(spark, sf_dir))


def average_movie_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.average_movie_score(fixtures.ratings(spark, sf_dir))


def genres_top_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per listed movie, which SQL can compare; the nested form is in the tests."""
    return stats.genres_top_flat(
        fixtures.movies(spark, sf_dir), average_movie_score(spark, sf_dir)
    )


def statistics_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four statistics tables as their job stores them, as one table."""
    target = store.TableStore(work_dir(spark, "statistics"))
    store.store_tables(
        target,
        fixtures.movies(spark, sf_dir),
        fixtures.ratings(spark, sf_dir),
        fixtures.tags(spark, sf_dir),
    )
    statistics_job.run(spark, target)

    def rows(table: str, schema, value: str, of: str = "''", month: str = "0L") -> DataFrame:
        return target.read(spark, table, schema).select(
            F.lit(table).alias("tbl"),
            F.expr(of).alias("genres"),
            "mid",
            F.expr(month).alias("yearmonth"),
            F.col(value).cast("double").alias("value"),
        )

    best = target.read(spark, schemas.GENRES_TOP_TABLE, schemas.GENRES_RECS)
    best = best.select(
        F.lit(schemas.GENRES_TOP_TABLE).alias("tbl"), "genres", F.inline("recs")
    ).select("tbl", "genres", "mid", F.lit(0).cast("long").alias("yearmonth"), F.col("r").alias("value"))
    return (
        rows(schemas.RATE_MORE_TABLE, schemas.RATE_MORE_MOVIES, "count")
        .unionByName(rows(schemas.RATE_MORE_RECENTLY_TABLE, schemas.RATE_MORE_RECENTLY, "count",
                          month="yearmonth"))
        .unionByName(rows(schemas.AVERAGE_TABLE, schemas.AVERAGE_MOVIES, "avg"))
        .unionByName(best)
    )


def recents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's newest ratings as one text of ``mid:score`` entries."""
    newest = scoring.recent_ratings(fixtures.event_ratings(spark, sf_dir))
    entry = F.struct("pos", "mid", F.col("score").alias("r"))
    lists = newest.groupBy("uid").agg(F.sort_array(F.collect_list(entry)).alias("recs"))
    return lists.select("uid", encode_recs(F.col("recs")).alias("recs_text"))


def load_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rating lines, some made unreadable, loaded permissively: good rows and bad lines."""
    number, score = F.col("mid") % 50, F.col("score").cast("string")
    rows = fixtures.ratings(spark, sf_dir).select(
        F.when(number == 0, F.concat(F.lit("u"), "uid")).otherwise(F.col("uid").cast("string")).alias("uid"),
        "mid",
        F.when(number == 1, F.lit("NaN")).otherwise(score).alias("score"),
        "timestamp",
    )
    path = work_dir(spark, "text")
    fixtures.as_lines(rows, ",").write.text(path)
    parsed = ingest.parse_ratings(store.read_lines(spark, path), "permissive")
    bad = ingest.bad_lines({"ratings": parsed}).select("line")
    good = ingest.good_rows(parsed)
    blank = [F.lit(-1).cast(f.dataType).alias(f.name) for f in schemas.RATING.fields]
    return good.withColumn("line", F.lit("")).unionByName(bad.select(*blank, "line"))


def _model(spark: SparkSession, sf_dir: str):
    rows = factors.training_rows(fixtures.ratings(spark, sf_dir))
    return factors.train_als(rows, stored=True), rows


def als_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _model(spark, sf_dir)
    item = factors.item_factors(model).select(F.lit("item").alias("kind"), "mid", "features")
    user = factors.user_factors(model).select(F.lit("user").alias("kind"), "uid", "features")
    return item.toDF("kind", "id", "features").unionByName(user.toDF("kind", "id", "features"))


def als_user_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _model(spark, sf_dir)
    return factors.user_recs(model, fixtures.movies(spark, sf_dir))


def als_item_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _model(spark, sf_dir)
    edges = similarity.item_similarity(factors.item_factors(model))
    return similarity.movie_recs(durable(edges, "edges"))


def als_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, rows = _model(spark, sf_dir)
    return evaluate.model_rmse(model, rows)


def als_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.als_grid(fixtures.ratings(spark, sf_dir))


def als_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(name, n)``: counts over one trained model that have to be as SQL says."""
    model, rows = _model(spark, sf_dir)
    movies = fixtures.movies(spark, sf_dir)
    users = durable(factors.user_factors(model), "users")
    items = durable(factors.item_factors(model), "items")
    recs = durable(topn.user_topn_flat(users, items, movies), "recs")
    edges = durable(similarity.item_similarity(items), "edges")
    own = model.recommendForAllUsers(topn.USER_TOP).select("uid", F.explode("recommendations"))
    own = own.select("uid", "col.mid", "col.rating").filter("rating > 0")
    error = evaluate.model_rmse(model, rows)
    predicted = model.transform(rows).select("uid", "mid", F.col("prediction").cast("double"))
    gap = F.col("score").cast("double") - F.col("prediction")
    plain = rows.join(predicted, ["uid", "mid"]).agg(F.sqrt(F.avg(gap * gap)).alias("rmse"))
    means = rows.groupBy("mid").agg(F.avg("score").alias("mean"))
    by_mean = rows.join(means, "mid").agg(
        F.sqrt(F.avg((F.col("score") - F.col("mean")) ** 2)).alias("rmse")
    )
    ranked = recs.join(own, ["uid", "mid"], "left")
    before = recs.select("uid", (F.col("rank") + 1).alias("rank"), F.col("r").alias("before"))
    turned = edges.select(F.col("mid2").alias("mid"), F.col("mid").alias("mid2"), "r")

    grid = evaluate.als_grid(
        fixtures.ratings(spark, sf_dir), store=store.TableStore(work_dir(spark, "grid"))
    )
    combinations = [F.col("rank").isin(*evaluate.GRID_RANKS)]
    combinations.append(F.col("reg").isin(*evaluate.GRID_REGULARIZATIONS))

    def finite(df: DataFrame) -> DataFrame:
        return df.filter(is_finite(F.col("features")) & (F.size("features") == factors.RANK))

    counts = {
        "users": finite(users),
        "items": finite(items),
        "recommendations that are not positive or too many": recs.filter("rank > 10 or r <= 0"),
        "recommendations outside the catalogue": recs.join(movies, "mid", "left_anti"),
        "recommendations out of order": recs.join(before, ["uid", "rank"]).filter("r > before"),
        "recommendations unlike Spark ML's": ranked.filter(
            F.col("rating").isNull() | (F.abs(F.col("rating") - F.col("r")) > 1e-3)
        ),
        "edges at or below the threshold": edges.filter("r <= 0.6 or mid = mid2"),
        "edges one way only": edges.join(turned, ["mid", "mid2", "r"], "left_anti"),
        "errors unlike the plain join's": error.join(
            plain, F.abs(error["rmse"] - plain["rmse"]) > 1e-6
        ),
        "errors above the item mean's": error.join(by_mean, error["rmse"] > by_mean["rmse"]),
    }
    counts |= {
        "combinations with a finite error": grid.filter(
            combinations[0] & combinations[1] & (F.col("rmse") >= 0) & (F.col("rmse") < float("inf"))
        ).select("rank", "reg").distinct(),
        "errors of the grid unlike the model's": grid.filter(
            f"rank = {factors.RANK} and reg = {factors.REGULARIZATION}"
        ).join(error.withColumnRenamed("rmse", "own"), F.abs(F.col("rmse") - F.col("own")) > 1e-3),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in counts.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def user_topn_from_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings as users against the embeddings as items."""
    best = topn.user_topn_flat(
        fixtures.embedding_factors(spark, sf_dir, "uid"),
        fixtures.embedding_factors(spark, sf_dir),
    )
    return best.withColumn("r", F.round("r", 6))


def user_topn_unrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without the items that a user has rated."""
    best = topn.user_topn_flat(
        fixtures.embedding_factors(spark, sf_dir, "uid"),
        fixtures.embedding_factors(spark, sf_dir),
        exclude=fixtures.event_ratings(spark, sf_dir),
    )
    return best.withColumn("r", F.round("r", 6))


def item_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = similarity.item_similarity(durable(fixtures.month_factors(spark, sf_dir)))
    return edges.withColumn("r", F.round("r", 6))


def _embedding_edges(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    return similarity.item_similarity(
        fixtures.embedding_factors(spark, sf_dir), EMBEDDING_THRESHOLD, whole=whole
    )


def _stored_recs(spark: SparkSession, sf_dir: str) -> store.TableStore:
    """A store with the similar items of the embeddings, in buckets of the item."""
    target = store.TableStore(work_dir(spark, "similar"))
    items = fixtures.table(spark, sf_dir, "embeddings").count()
    edges = _embedding_edges(spark, sf_dir, whole=True)
    recs = similarity.movie_recs(edges, items=items, whole=True)
    store.store_movie_recs(target, recs, BUCKETS, dealt=True)
    return target


def _recs_near(spark: SparkSession, sf_dir: str):
    """Reads the lists of given items from such a store."""
    return store.movie_recs_reader(_stored_recs(spark, sf_dir)).near


def item_similarity_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embedding_edges(spark, sf_dir).withColumn("r", F.round("r", 6))


def similarity_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to stored lists and back."""
    recs = store.movie_recs(spark, _stored_recs(spark, sf_dir))
    return similarity.similarity_edges(recs).withColumn("r", F.round("r", 6))


def rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of the item mean as the predictor."""
    ratings = fixtures.ratings(spark, sf_dir).select("uid", "mid", "score")
    ratings = durable(ratings, "ratings")
    averages = stats.average_movie_score(ratings)
    predicted = ratings.select("uid", "mid").join(averages, "mid")
    predicted = durable(predicted.withColumnRenamed("avg", "prediction"), "predicted")
    return evaluate.rmse(ratings, predicted).select(
        F.round("rmse", 6).alias("rmse")
    )


def parse_rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ingest.parse_rating_events(fixtures.event_lines(spark, sf_dir))
    return parsed.filter(F.col(ingest.CORRUPT).isNull()).drop(ingest.CORRUPT)


def recent_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.recent_ratings(fixtures.event_ratings(spark, sf_dir))


def recent_from_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest ratings from stored lists of ``mid:score`` entries."""
    newest = scoring.recent_ratings(fixtures.event_ratings(spark, sf_dir), 30)
    entry = F.concat_ws(":", "mid", "score")
    lists = newest.groupBy("uid").agg(
        F.sort_array(F.collect_list(F.struct("pos", entry.alias("entry")))).alias("sorted")
    )
    path = work_dir(spark, "recents")
    lists.select("uid", F.col("sorted.entry").alias("entries")).write.parquet(path)
    stored = spark.read.schema(schemas.RECENT_LISTS).parquet(path)
    return scoring.recent_from_lists(stored)


def candidate_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = durable(fixtures.event_ratings(spark, sf_dir), "events")
    last = durable(scoring.last_event_per_user(events))
    return scoring.candidate_items(
        last, _recs_near(spark, sf_dir), events, rated_rows=events.count()
    )


def stream_scores_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = durable(fixtures.event_ratings(spark, sf_dir), "events")
    scores = scoring.score_events(
        durable(scoring.last_event_per_user(events)),
        _recs_near(spark, sf_dir),
        events,
        threshold=EMBEDDING_THRESHOLD,
    )
    return scores.withColumn("r", F.round("r", 6))


def stream_scores_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring with its default settings, over all ratings."""
    ratings = durable(fixtures.ratings(spark, sf_dir))
    edges = durable(
        similarity.item_similarity(durable(fixtures.month_factors(spark, sf_dir))), "edges"
    )
    scores = scoring.score_events(
        durable(scoring.last_event_per_user(ratings)),
        durable(similarity.movie_recs(edges)),
        ratings,
    )
    return scores.withColumn("r", F.round("r", 6))


def _rescoring(spark: SparkSession, sf_dir: str) -> Rescoring:
    """A stream over stored tables, of which a batch opens the buckets it needs."""
    tables = _stored_recs(spark, sf_dir)
    ratings = fixtures.event_ratings(spark, sf_dir)
    tables.overwrite(
        store.ratings_layout(ratings, BUCKETS), schemas.RATING_TABLE, store.BY_USER.columns
    )
    return Rescoring(
        recs=None,
        lists=store.movie_recs_reader(tables).near,
        ratings=store.ratings_reader(tables).near,
        sink=store.TableStore(work_dir(spark, "recs")),
        threshold=EMBEDDING_THRESHOLD,
    )


def _exploded(recs: DataFrame) -> DataFrame:
    """One row per recommendation, and one with item -1 for a user with an empty list."""
    return recs.select("uid", F.explode_outer("recs").alias("rec")).select(
        "uid",
        F.coalesce("rec.mid", F.lit(-1)).alias("mid"),
        F.coalesce(F.round("rec.r", 6), F.lit(0.0)).alias("r"),
    )


def stream_recs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second one twice, then the current record of every user."""
    job = _rescoring(spark, sf_dir)
    early = F.col("timestamp") < F.unix_seconds(F.lit(SECOND_BATCH).cast("timestamp"))
    events = fixtures.event_ratings(spark, sf_dir)
    first = fixtures.as_lines(events.filter(early), "|")
    second = fixtures.as_lines(events.filter(~early), "|")
    for number, lines in ((0, first), (1, second), (1, second)):
        job.process_batch(lines, number)
    return _exploded(latest_recs(spark, job.sink))


def stream_micro_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as a stream of text files, in several micro-batches in the order of time,
    through to the current records."""
    path = work_dir(spark, "events")
    events = durable(fixtures.event_ratings(spark, sf_dir), "ratings")
    event_sources.write_in_order(events, path, MICRO_BATCHES, BATCH_FILES)
    job = _rescoring(spark, sf_dir)
    query = job.start(
        event_sources.file_events(spark, path, max_files_per_trigger=BATCH_FILES),
        work_dir(spark, "progress"),
        interval=None,
    )
    query.awaitTermination()
    return _exploded(latest_recs(spark, job.sink))


def stream_recents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest ratings as a stream of all events keeps them, in several batches."""
    path = work_dir(spark, "events")
    events = durable(fixtures.event_ratings(spark, sf_dir), "ratings")
    event_sources.write_in_order(events, path, MICRO_BATCHES, BATCH_FILES)
    sink = store.TableStore(work_dir(spark, "recents"))
    lines = event_sources.file_events(spark, path, max_files_per_trigger=BATCH_FILES)
    query = recents.start(lines, sink, work_dir(spark, "progress"), interval=None)
    query.awaitTermination()
    return scoring.recent_from_lists(recents.latest(spark, sink))


_QUERIES = (
    ingest_movies,
    ingest_ratings,
    ingest_tags,
    store_roundtrip,
    movie_tags,
    search_documents,
    search_index,
    document_upserts,
    rate_more_movies,
    rate_more_recently,
    average_movie_score,
    genres_top_movies,
    statistics_tables,
    recents_text,
    als_factors,
    als_user_recs,
    als_item_similarity,
    als_rmse,
    als_grid,
    als_checks,
    load_quarantine,
    recent_from_lists,
    user_topn_from_factors,
    user_topn_unrated,
    item_similarity,
    item_similarity_embeddings,
    similarity_edges,
    rmse,
    parse_rating_events,
    recent_ratings,
    candidate_items,
    stream_scores_batch,
    stream_scores_ratings,
    stream_recs,
    stream_micro_batches,
    stream_recents,
)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: scored recommendations for every user with an event."""
    return stream_scores_batch(spark, "/root/testdata/sf0.001")


def _training_data():
    """The module of the training-data queries; None where that subpackage is absent."""
    try:
        return importlib.import_module("reelrank.llm.queries")
    except ImportError:  # no folder, one without modules, or without what these need
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {query.__name__: query for query in _QUERIES}
    more = _training_data()
    if more is None:
        return own
    pipeline = importlib.import_module("corpus_pipeline").run
    return own | more.queries() | {"pipeline": pipeline}


# --- SQL -----------------------------------------------------------------------------------

_RATINGS = """
ratings as (
  select cast(o_custkey as int) as uid, cast(l_partkey as int) as mid,
         cast(ceil(l_quantity / 5) / 2 as double) as score,
         cast(floor(epoch(l_shipdate)) as int) as "timestamp"
  from lineitem join orders on l_orderkey = o_orderkey
)"""

_GENRE_LIST = "[" + ", ".join(f"'{name}'" for name in fixtures.GENRE_NAMES) + "]"

_MOVIES = f"""
movies as (
  select cast(p_partkey as int) as mid, p_name as name, '' as descri,
         p_size || ' minutes' as timelong, '' as issue, '1995' as shoot,
         'English' as language,
         {_GENRE_LIST}[cast(p_partkey % 20 + 1 as int)] || '|' ||
         {_GENRE_LIST}[cast(p_size % 20 + 1 as int)] as genres,
         p_brand as actors, p_type as directors
  from part
)"""

_TAGS = """
tags as (
  select cast(user_id as int) as uid,
         cast(regexp_extract(props, '"k": *([0-9]+)', 1) as int) as mid,
         event_type as tag, cast(floor(epoch(ts)) as int) as "timestamp"
  from events
)"""

_EVENTS = """
ev as (
  select cast(user_id as int) as uid,
         cast(regexp_extract(props, '"k": *([0-9]+)', 1) as int) as mid,
         cast(least(10, ceil(value / 10)) / 2 as double) as score,
         cast(floor(epoch(ts)) as int) as "timestamp"
  from events
)"""

_TAG_INDEX = """
tag_index as (
  select mid, string_agg(tag, '|' order by tag) as tags
  from (select distinct mid, tag from tags where tag is not null) group by mid
)"""

_DOCUMENTS = f"""
with {_MOVIES}, {_TAGS}, {_TAG_INDEX}
select m.*, t.tags from movies m left join tag_index t on m.mid = t.mid"""

_AVERAGES = "averages as (select mid, avg(score) as avg from ratings group by mid)"

_EMBEDDINGS = """
vectors as (
  select cast(vec_id as int) as mid, cast(embedding as double[]) as f from embeddings
)"""

_MONTH_COUNTS = ", ".join(
    f"cast(count(*) filter (where m = {number}) as double)" for number in range(fixtures.MONTHS)
)
_MONTH_VECTORS = f"""
vectors as (
  select mid, [{_MONTH_COUNTS}] as f
  from (
    select cast(l_partkey as int) as mid,
           (year(l_shipdate) * 12 + month(l_shipdate)) % {fixtures.MONTHS} as m
    from lineitem
  ) group by mid
)"""


def _edges(threshold: float) -> str:
    return f"""
lengths as (select mid, f, sqrt(list_dot_product(f, f)) as n from vectors),
edges as (
  select a.mid as mid, b.mid as mid2, list_dot_product(a.f, b.f) / (a.n * b.n) as r
  from lengths a join lengths b on a.mid <> b.mid
  where a.n > 0 and b.n > 0 and list_dot_product(a.f, b.f) / (a.n * b.n) > {threshold}
)"""


def _similar(vectors: str, threshold: float) -> str:
    return f"""
with {vectors}, {_edges(threshold)}
select mid, mid2, round(r, 6) as r from edges"""


def _scoring(events: str, threshold: float) -> str:
    return f"""
last_event as (
  select uid, mid from {events}
  qualify row_number() over (
    partition by uid order by "timestamp" desc, mid desc, score desc) = 1
),
recents as (
  select uid, mid, score from {events}
  qualify row_number() over (
    partition by uid order by "timestamp" desc, mid desc, score desc) <= 20
),
candidates as (
  select l.uid, e.mid2 as cand,
         row_number() over (partition by l.uid order by e.r desc, e.mid2) as "rank"
  from last_event l join edges e on l.mid = e.mid
  where not exists (select 1 from {events} x where x.uid = l.uid and x.mid = e.mid2)
  qualify "rank" <= 20
),
scores as (
  select c.uid, c.cand as mid,
         avg(e.r * s.score)
         + log2(greatest(count(*) filter (where s.score > 3), 1))
         - log2(greatest(count(*) filter (where s.score <= 3), 1)) as r
  from candidates c
  join recents s on s.uid = c.uid
  join edges e on e.mid = c.cand and e.mid2 = s.mid
  where e.r > {threshold}
  group by c.uid, c.cand
)"""


_EMBEDDING_SCORING = (
    f"with {_EVENTS}, {_EMBEDDINGS}, {_edges(EMBEDDING_THRESHOLD)}, "
    f"{_scoring('ev', EMBEDDING_THRESHOLD)}"
)
_CURRENT_RECS = f"""
{_EMBEDDING_SCORING}
select u.uid, coalesce(s.mid, -1) as mid, coalesce(round(s.r, 6), 0) as r
from (select distinct uid from ev) u left join scores s on s.uid = u.uid"""



def _top_of(kept: str) -> str:
    return f"""
with {_EMBEDDINGS}, scored as (
  select u.mid as uid, i.mid as mid, list_dot_product(u.f, i.f) as p
  from vectors u cross join vectors i
)
select uid, cast(row_number() over (partition by uid order by p desc, mid) as int) as "rank",
       mid, round(p, 6) as r
from scored where {kept}
qualify "rank" <= 10"""


_RECENTS = f"""
with {_EVENTS}
select uid, mid, score,
       cast(row_number() over (
         partition by uid order by "timestamp" desc, mid desc, score desc) as int) as pos
from ev qualify pos <= 20"""

_GENRE_VALUES = ", ".join(f"('{name}')" for name in stats.GENRES)


def oracle_sql() -> dict[str, str]:
    more = _training_data()
    return _own_sql() if more is None else _own_sql() | more.oracle_sql()


def _own_sql() -> dict[str, str]:
    return {
        "ingest_movies": f"with {_MOVIES} select * from movies",
        "ingest_ratings": f"with {_RATINGS} select * from ratings",
        "ingest_tags": f"with {_TAGS} select * from tags",
        "store_roundtrip": f"""
with {_MOVIES}, {_RATINGS}, {_TAGS}
select 'Movie' as tbl, cast(-1 as int) as uid, mid, name || '^' || genres as text,
       cast(0 as double) as num, cast(-1 as int) as ts from movies
union all
select 'Rating', uid, mid, '', score, "timestamp" from ratings
union all
select 'Tag', uid, mid, tag, 0, "timestamp" from tags""",
        "movie_tags": f"with {_TAGS}, {_TAG_INDEX} select mid, tags from tag_index",
        "search_documents": _DOCUMENTS,
        "search_index": _DOCUMENTS,
        "document_upserts": f"""
select * replace (case when mid % 5 = 0 then 'German' when mid % 3 = 0 then 'French'
  else language end as language)
from ({_DOCUMENTS})""",
        "rate_more_movies": f"""
with {_RATINGS}
select mid, count(*) as count from ratings group by mid order by count desc, mid""",
        "rate_more_recently": f"""
with {_RATINGS}
select mid, count(*) as count,
       cast(strftime(to_timestamp("timestamp") at time zone 'UTC', '%Y%m') as bigint)
         as yearmonth
from ratings group by all order by yearmonth desc, count desc, mid""",
        "average_movie_score": f"with {_RATINGS}, {_AVERAGES} select mid, avg from averages",
        "genres_top_movies": f"""
with {_RATINGS}, {_MOVIES}, {_AVERAGES}, names(genres) as (values {_GENRE_VALUES})
select n.genres,
       cast(row_number() over (partition by n.genres order by a.avg desc, m.mid) as int)
         as "rank",
       m.mid, a.avg as r
from names n join movies m on contains(lower(m.genres), lower(n.genres))
join averages a on a.mid = m.mid
qualify "rank" <= 10""",
        "user_topn_from_factors": _top_of("p > 0"),
        "user_topn_unrated": f"""
with {_EVENTS}, {_top_of("""p > 0 and not exists (
  select 1 from ev x where x.uid = scored.uid and x.mid = scored.mid)""").strip()[len("with "):]}""",
        "item_similarity": _similar(_MONTH_VECTORS, similarity.SIMILARITY_THRESHOLD),
        "item_similarity_embeddings": _similar(_EMBEDDINGS, EMBEDDING_THRESHOLD),
        "similarity_edges": _similar(_EMBEDDINGS, EMBEDDING_THRESHOLD),
        "rmse": f"""
with {_RATINGS}, {_AVERAGES},
predicted as (select uid, r.mid, avg as p from ratings r join averages a on r.mid = a.mid)
select round(sqrt(avg((score - p) * (score - p))), 6) as rmse
from ratings r join predicted q on r.uid = q.uid and r.mid = q.mid""",
        "parse_rating_events": f"with {_EVENTS} select * from ev",
        "recent_ratings": _RECENTS,
        "recents_text": f"""
select uid, string_agg(mid || ':' || score, '|' order by pos) as recs_text
from ({_RECENTS}) group by uid""",
        "statistics_tables": f"""
with {_RATINGS}, {_MOVIES}, {_AVERAGES}, names(genres) as (values {_GENRE_VALUES})
select 'RateMoreMovies' as tbl, '' as genres, mid, cast(0 as bigint) as yearmonth,
       cast(count(*) as double) as value
from ratings group by mid
union all
select 'RateMoreMoviesRecently', '', mid,
       cast(strftime(to_timestamp("timestamp") at time zone 'UTC', '%Y%m') as bigint) as month,
       cast(count(*) as double)
from ratings group by mid, month
union all
select 'AverageMoviesScore', '', mid, 0, avg from averages
union all
select * from (
  select 'GenresTopMovies', n.genres, m.mid, 0, a.avg
  from names n join movies m on contains(lower(m.genres), lower(n.genres))
  join averages a on a.mid = m.mid
  qualify row_number() over (partition by n.genres order by a.avg desc, m.mid) <= 10
)""",
        "recent_from_lists": _RECENTS,
        "stream_recents": _RECENTS,
        "load_quarantine": f"""
with {_RATINGS}
select uid, mid, score, "timestamp", '' as line
from ratings where mid % 50 > 1
union all
select -1, -1, -1, -1,
       case when mid % 50 = 0 then 'u' else '' end || uid || ',' || mid || ','
       || case when mid % 50 = 1 then 'NaN' else cast(score as varchar) end
       || ',' || "timestamp"
from ratings where mid % 50 <= 1""",
        "als_checks": f"""
with {_RATINGS}
select 'users' as name, count(distinct uid) as n from ratings
union all select 'items', count(distinct mid) from ratings
union all select 'combinations with a finite error', 15
union all select unnest([
  'recommendations that are not positive or too many', 'recommendations outside the catalogue',
  'recommendations out of order', 'recommendations unlike Spark ML''s',
  'edges at or below the threshold', 'edges one way only',
  'errors unlike the plain join''s', 'errors above the item mean''s',
  'errors of the grid unlike the model''s']), 0""",
        "candidate_items": f"""
{_EMBEDDING_SCORING}
select uid, cand, cast("rank" as int) as "rank" from candidates""",
        "stream_scores_batch": f"""
{_EMBEDDING_SCORING} select uid, mid, round(r, 6) as r from scores""",
        "stream_scores_ratings": f"""
with {_RATINGS}, {_MONTH_VECTORS}, {_edges(scoring.SIMILARITY_THRESHOLD)},
{_scoring("ratings", scoring.SIMILARITY_THRESHOLD)}
select uid, mid, round(r, 6) as r from scores""",
        "stream_recs": _CURRENT_RECS,
        "stream_micro_batches": _CURRENT_RECS,
    }
