import pytest
from conftest import rows
from pyspark.sql import functions as F

from reelrank.functions.time import year_month
from reelrank.operators import search_docs, stats

RATING = "uid int, mid int, score double, timestamp int"


@pytest.fixture
def ratings(spark):
    return spark.createDataFrame(
        [
            (1, 10, 4.0, 1260759144),
            (2, 10, 2.0, 1260759145),
            (3, 10, 3.0, 1577836799),
            (1, 11, 5.0, 1577836800),
            (2, 12, 5.0, 1577836801),
        ],
        RATING,
    )


@pytest.fixture
def movies(spark):
    return spark.createDataFrame(
        [
            (10, "Action|Crime"),
            (11, "musical|ACTION"),
            (12, "Action"),
            (13, "Action"),
            (14, None),
        ],
        "mid int, genres string",
    )


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/Los_Angeles"])
def test_months_are_utc(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = [1260759144, 1577836799, 1577836800, 0, -1]
        frame = spark.createDataFrame([(s,) for s in seconds], "t int")
        months = [row[0] for row in frame.select(year_month(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert months == [200912, 201912, 202001, 197001, 196912]


def test_counts(ratings):
    assert [tuple(r) for r in stats.rate_more_movies(ratings).collect()] == [
        (10, 3),
        (11, 1),
        (12, 1),
    ]
    assert [tuple(r) for r in stats.rate_more_recently(ratings).collect()] == [
        (11, 1, 202001),
        (12, 1, 202001),
        (10, 1, 201912),
        (10, 2, 200912),
    ]
    assert rows(stats.rate_more_movies(ratings, ordered=False)) == [(10, 3), (11, 1), (12, 1)]


def test_best_per_genre(ratings, movies):
    averages = stats.average_movie_score(ratings)
    assert rows(averages) == [(10, 3.0), (11, 5.0), (12, 5.0)]
    flat = stats.genres_top_flat(movies, averages)
    assert rows(flat) == [
        ("Action", 1, 11, 5.0),
        ("Action", 2, 12, 5.0),
        ("Action", 3, 10, 3.0),
        ("Crime", 1, 10, 3.0),
        ("Music", 1, 11, 5.0),
    ]
    nested = {r.genres: [tuple(x) for x in r.recs] for r in
              stats.genres_top_movies(movies, averages, top=2).collect()}
    assert nested == {
        "Action": [(11, 5.0), (12, 5.0)],
        "Crime": [(10, 3.0)],
        "Music": [(11, 5.0)],
    }


def test_other_genre_list(ratings, movies):
    averages = stats.average_movie_score(ratings)
    assert rows(stats.genres_top_flat(movies, averages, genres=["Ccrime", "MUSICAL"])) == [
        ("MUSICAL", 1, 11, 5.0)
    ]


def test_genre_ranking_limits_before_the_shuffle(ratings, movies, capsys):
    stats.genres_top_flat(movies, stats.average_movie_score(ratings)).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.fixture
def tags(spark):
    data = [(1, 10, "b", 1), (2, 10, "a", 2), (3, 10, "b", 3), (1, 11, "z", 4), (1, 12, None, 5)]
    return spark.createDataFrame(data, "uid int, mid int, tag string, timestamp int")


def test_tag_index(tags):
    assert rows(search_docs.movie_tags(tags)) == [(10, "a|b"), (11, "z")]


def test_a_movie_of_very_many_tags_has_one_document(spark):
    from reelrank.sources import schemas

    many = spark.range(120_000).selectExpr(
        "1 as uid", "1 as mid", "format_string('t%06d', id) as tag", "0 as timestamp"
    )
    movies = spark.createDataFrame([(1, *[""] * 9), (2, *[""] * 9)], schemas.MOVIE)
    documents = search_docs.search_documents(movies, many.unionByName(many)).collect()
    assert sorted(row.mid for row in documents) == [1, 2]
    tags = next(row.tags for row in documents if row.mid == 1).split("|")
    assert tags == [f"t{n:06d}" for n in range(120_000)]


def test_search_documents(spark, tags):
    movie = [(mid, f"n{mid}", *[""] * 8) for mid in (10, 11, 13)]
    from reelrank.sources import schemas

    movies = spark.createDataFrame(movie, schemas.MOVIE)
    documents = search_docs.search_documents(movies, tags)
    assert documents.columns == [*schemas.MOVIE.names, "tags"]
    assert {r.mid: r.tags for r in documents.collect()} == {10: "a|b", 11: "z", 13: None}
