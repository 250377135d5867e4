"""Write the four statistics tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from reelrank.jobs import common
from reelrank.operators import stats
from reelrank.session import spark_session
from reelrank.sources import schemas
from reelrank.sources import store as stores
from reelrank.sources.durable import clear


def run(spark: SparkSession, store: stores.TableStore) -> None:
    """Each statistic reads only its columns of the ratings, so nothing is cached.

    The tables are written unordered: a stored table keeps no order.
    """
    ratings = stores.ratings(spark, store)
    store.overwrite(stats.rate_more_movies(ratings, ordered=False), schemas.RATE_MORE_TABLE)
    store.overwrite(
        stats.rate_more_recently(ratings, ordered=False), schemas.RATE_MORE_RECENTLY_TABLE
    )
    store.overwrite(stats.average_movie_score(ratings), schemas.AVERAGE_TABLE)
    averages = store.read(spark, schemas.AVERAGE_TABLE, schemas.AVERAGE_MOVIES)
    store.overwrite(
        stats.genres_top_movies(stores.movies(spark, store), averages), schemas.GENRES_TOP_TABLE
    )


def main() -> None:
    args = common.parser(__doc__).parse_args()
    spark = spark_session("reelrank statistics")
    run(spark, common.table_store(args))
    clear(spark)
    spark.stop()


if __name__ == "__main__":
    main()
