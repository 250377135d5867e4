"""Fold the stored batches of recommendations into one snapshot."""

from __future__ import annotations

import argparse

from reelrank.session import spark_session
from reelrank.sources.tables import TableStore
from reelrank.streaming import upsert


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--recs", required=True, help="folder of the recommendation batches")
    parser.add_argument("--upto", type=int, help="last batch to fold; by default the newest")
    args = parser.parse_args()
    spark = spark_session("reelrank compact")
    store = TableStore(args.recs)
    upto = args.upto
    if upto is None:
        upto = max(upsert.finished_batches(spark, store), default=None)
    if upto is not None:
        upsert.compact(spark, store, upto)
    spark.stop()


if __name__ == "__main__":
    main()
