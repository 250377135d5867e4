"""Fixed schemas of the stored tables, and their names in the store."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


INT, LONG, DOUBLE, STRING = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()

MOVIE = _struct(
    mid=INT,
    name=STRING,
    descri=STRING,
    timelong=STRING,
    issue=STRING,
    shoot=STRING,
    language=STRING,
    genres=STRING,
    actors=STRING,
    directors=STRING,
)
RATING = _struct(uid=INT, mid=INT, score=DOUBLE, timestamp=INT)
TAG = _struct(uid=INT, mid=INT, tag=STRING, timestamp=INT)
SEARCH_DOCUMENT = T.StructType([*MOVIE.fields, T.StructField("tags", STRING)])

RECOMMENDATIONS = T.ArrayType(_struct(mid=INT, r=DOUBLE))
GENRES_RECS = _struct(genres=STRING, recs=RECOMMENDATIONS)
USER_RECS = _struct(uid=INT, recs=RECOMMENDATIONS)
# ``part`` numbers the lists of one item; see plans.lists.
MOVIE_RECS = _struct(mid=INT, part=INT, recs=RECOMMENDATIONS)
# Newest first, each entry ``mid:score``.
RECENT_LISTS = _struct(uid=INT, entries=T.ArrayType(STRING))
STREAM_RECS = _struct(uid=INT, recs=RECOMMENDATIONS, recs_text=STRING)

RATE_MORE_MOVIES = _struct(mid=INT, count=LONG)
RATE_MORE_RECENTLY = _struct(mid=INT, count=LONG, yearmonth=LONG)
AVERAGE_MOVIES = _struct(mid=INT, avg=DOUBLE)

MOVIE_TABLE = "Movie"
RATING_TABLE = "Rating"
TAG_TABLE = "Tag"
RATE_MORE_TABLE = "RateMoreMovies"
RATE_MORE_RECENTLY_TABLE = "RateMoreMoviesRecently"
AVERAGE_TABLE = "AverageMoviesScore"
GENRES_TOP_TABLE = "GenresTopMovies"
USER_RECS_TABLE = "UserRecs"
MOVIE_RECS_TABLE = "MovieRecs"
STREAM_RECS_TABLE = "StreamRecs"
LOAD_QUARANTINE_TABLE = "LoadQuarantine"
SEARCH_TABLE = "MovieSearch"
