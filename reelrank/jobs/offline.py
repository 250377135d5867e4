"""Train the factors; write each user's best movies and each movie's similar ones."""

from __future__ import annotations

from pyspark.sql import SparkSession

from reelrank.jobs import common
from reelrank.operators import factors, similarity, topn
from reelrank.session import spark_session
from reelrank.sources import schemas
from reelrank.sources import store as stores
from reelrank.sources.durable import clear, durable


def run(
    spark: SparkSession,
    store: stores.TableStore,
    rank: int = factors.RANK,
    iterations: int = factors.ITERATIONS,
    reg: float = factors.REGULARIZATION,
    seed: int = factors.SEED,
    top: int = topn.USER_TOP,
    threshold: float = similarity.SIMILARITY_THRESHOLD,
    blocks: int = factors.BLOCKS,
    item_buckets: int | None = None,
    leave_out_rated: bool = False,
) -> None:
    ratings = stores.ratings(spark, store)
    model = factors.train_als(ratings, rank, iterations, reg, seed, blocks)
    # Stored once, so that neither product depends on the trained model's cached blocks.
    items = durable(factors.item_factors(model), "item-factors")
    users = durable(factors.user_factors(model), "user-factors")
    store.overwrite(
        topn.user_topn(
            users,
            items,
            stores.movies(spark, store),
            top,
            exclude=ratings.select("uid", "mid") if leave_out_rated else None,
        ),
        schemas.USER_RECS_TABLE,
    )
    edges = durable(similarity.item_similarity(items, threshold), "edges")
    stores.store_movie_recs(store, similarity.movie_recs(edges), item_buckets)


def main() -> None:
    parser = common.parser(__doc__)
    parser.add_argument("--rank", type=int, default=factors.RANK)
    parser.add_argument("--iterations", type=int, default=factors.ITERATIONS)
    parser.add_argument("--reg", type=float, default=factors.REGULARIZATION)
    parser.add_argument("--seed", type=int, default=factors.SEED)
    parser.add_argument("--top", type=int, default=topn.USER_TOP)
    parser.add_argument("--threshold", type=float, default=similarity.SIMILARITY_THRESHOLD)
    parser.add_argument("--blocks", type=int, default=factors.BLOCKS)
    parser.add_argument(
        "--item-buckets",
        type=int,
        help="partitions of the similar items, by item; by their number if not given",
    )
    parser.add_argument(
        "--leave-out-rated", action="store_true", help="no rated movies among a user's best"
    )
    args = parser.parse_args()
    spark = spark_session("reelrank offline")
    run(
        spark,
        common.table_store(args),
        args.rank,
        args.iterations,
        args.reg,
        args.seed,
        args.top,
        args.threshold,
        args.blocks,
        args.item_buckets,
        args.leave_out_rated,
    )
    clear(spark)
    spark.stop()


if __name__ == "__main__":
    main()
