"""Tag index and search documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.sources import schemas


def movie_tags(tags: DataFrame) -> DataFrame:
    """``(mid, tags)``: the distinct tags of each movie, sorted, joined by ``|``.

    Copies of a tag go away before anything is grouped by movie, in a shuffle on
    ``(mid, tag)`` that no popular movie can make uneven. A movie's tags are one string at
    any size, so only its distinct tags meet in a task.
    """
    distinct = tags.select("mid", "tag").filter(F.col("tag").isNotNull()).distinct()
    lists = distinct.groupBy("mid").agg(F.sort_array(F.collect_list("tag")).alias("items"))
    return lists.select("mid", F.concat_ws("|", "items").alias("tags"))


def search_documents(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Movies with their tags, 11 columns, one document per movie; ``tags`` is null for
    movies without any."""
    index = movie_tags(tags)
    return movies.join(index, "mid", "left").select(*schemas.MOVIE.names, "tags")
