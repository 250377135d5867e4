"""Keep recommendations fresh from a stream of rating events."""

from __future__ import annotations

from reelrank.jobs import common
from reelrank.operators import scoring
from reelrank.session import spark_session
from reelrank.sources import events, schemas
from reelrank.sources import store as stores
from reelrank.streaming.rescoring import COMPACT_EVERY, Rescoring, refreshed


def main() -> None:
    parser = common.parser(__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--files", help="folder where text files of events arrive")
    source.add_argument("--kafka", help="bootstrap servers")
    parser.add_argument("--topic", help="required with --kafka")
    parser.add_argument(
        "--source-option",
        action="append",
        default=[],
        metavar="KEY=VALUE",
        help="event source option: starting offsets, security",
    )
    parser.add_argument("--max-offsets", type=int, help="pace of a batch, from Kafka")
    parser.add_argument("--max-files", type=int, help="pace of a batch, from files")
    parser.add_argument("--recs", required=True, help="folder of the recommendation batches")
    parser.add_argument("--recs-format", help="Spark format that takes each batch as well")
    parser.add_argument("--recs-option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--progress", required=True, help="folder of the stream's progress")
    parser.add_argument("--interval", default="2 seconds", help="time between batches")
    parser.add_argument("--once", action="store_true", help="handle what is there, then stop")
    parser.add_argument("--refresh", type=float, default=600, help="seconds to hold MovieRecs without buckets")
    parser.add_argument("--compact-every", type=int, default=COMPACT_EVERY, help="batches")
    parser.add_argument("--recent-lists", help="table of stored recent ratings, uid and entries")
    parser.add_argument("--max-recent", type=int, default=scoring.MAX_RECENT)
    args = parser.parse_args()

    spark = spark_session("reelrank live")
    store = common.table_store(args)

    def recents(session):
        lists = store.read(session, args.recent_lists, schemas.RECENT_LISTS)
        return scoring.recent_from_lists(lists, args.max_recent).drop("pos")

    def forward(recs):
        writer = recs.write.format(args.recs_format).mode("append")
        writer.options(**common.options(args.recs_option)).save()

    # Kept for the whole stream: what they have listed of a version holds for it.
    ratings, lists = stores.ratings_reader(store), stores.movie_recs_reader(store)
    bucketed = lists.buckets(spark)
    job = Rescoring(
        recs=refreshed(lambda session: stores.movie_recs(session, store), args.refresh),
        lists=lists.near if bucketed else None,
        ratings=ratings.near,
        sink=stores.TableStore(args.recs),
        recents=recents if args.recent_lists else None,
        max_recent=args.max_recent,
        compact_every=args.compact_every,
        forward=forward if args.recs_format else None,
    )
    found = ratings.buckets(spark)
    print(f"ratings in {found} user buckets" if found else "ratings not bucketed: read whole")
    print(f"similar items in {bucketed} buckets" if bucketed else "similar items held in memory")
    source = common.options(args.source_option)
    if args.kafka:
        if not args.topic:
            parser.error("--kafka needs --topic")
        lines = events.kafka_events(
            spark, args.kafka, args.topic, max_offsets_per_trigger=args.max_offsets, **source
        )
    else:
        lines = events.file_events(spark, args.files, args.max_files)
    query = job.start(lines, args.progress, None if args.once else args.interval)
    query.awaitTermination()
    spark.stop()


if __name__ == "__main__":
    main()
