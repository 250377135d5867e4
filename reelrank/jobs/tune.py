"""Search the training parameters; print the best rank, regularisation and error."""

from __future__ import annotations

from pyspark.sql import SparkSession

from reelrank.jobs import common
from reelrank.operators import evaluate, factors
from reelrank.session import spark_session
from reelrank.sources import store as stores
from reelrank.sources.durable import clear


def run(
    spark: SparkSession,
    store: stores.TableStore,
    ranks=evaluate.GRID_RANKS,
    regs=evaluate.GRID_REGULARIZATIONS,
    iterations: int = factors.ITERATIONS,
) -> tuple[int, float, float]:
    """Fits that an earlier run has committed to the store are not repeated."""
    ratings = stores.ratings(spark, store)
    kept = None if store.table_option else store
    grid = evaluate.als_grid(ratings, ranks, regs, iterations, store=kept)
    return tuple(evaluate.best_parameters(grid).first())


def main() -> None:
    parser = common.parser(__doc__)
    parser.add_argument("--ranks", type=int, nargs="+", default=evaluate.GRID_RANKS)
    parser.add_argument("--regs", type=float, nargs="+", default=evaluate.GRID_REGULARIZATIONS)
    parser.add_argument("--iterations", type=int, default=factors.ITERATIONS)
    args = parser.parse_args()
    spark = spark_session("reelrank tune")
    print(run(spark, common.table_store(args), args.ranks, args.regs, args.iterations))
    clear(spark)
    spark.stop()


if __name__ == "__main__":
    main()
