"""Load movies, ratings and tags from text files; build the search documents."""

from __future__ import annotations

from pyspark.sql import SparkSession

from reelrank.jobs import common
from reelrank.operators import ingest, search_docs
from reelrank.session import spark_session
from reelrank.sources import schemas
from reelrank.sources import store as stores
from reelrank.sources.durable import clear


def run(
    spark: SparkSession,
    movies_path: str,
    ratings_path: str,
    tags_path: str,
    store: stores.TableStore,
    search: stores.TableStore | None = None,
    search_id_option: str | None = None,
    user_buckets: int | None = None,
    mode: str = "failfast",
) -> None:
    """Parse and store the tables, then build the documents from what was stored.

    ``failfast`` stops on a bad line. ``permissive`` sets bad lines apart in the table
    ``LoadQuarantine`` and loads the others.
    """
    parsed = {
        "movies": ingest.parse_movies(stores.read_lines(spark, movies_path), mode),
        "ratings": ingest.parse_ratings(stores.read_lines(spark, ratings_path), mode),
        "tags": ingest.parse_tags(stores.read_lines(spark, tags_path), mode),
    }
    if mode == "permissive":
        store.overwrite(ingest.bad_lines(parsed), schemas.LOAD_QUARANTINE_TABLE)
        parsed = {name: ingest.good_rows(rows) for name, rows in parsed.items()}
    stores.store_tables(
        store, parsed["movies"], parsed["ratings"], parsed["tags"], user_buckets
    )
    documents = search_docs.search_documents(
        stores.movies(spark, store), stores.tags(spark, store)
    )
    stores.write_search_documents(documents, search or store, search_id_option)


def main() -> None:
    parser = common.parser(__doc__)
    for name in ("movies", "ratings", "tags"):
        parser.add_argument(f"--{name}", required=True, help=f"text files of {name}")
    parser.add_argument(
        "--user-buckets",
        type=int,
        help="partitions of the ratings, by user; by their number if not given, 0 for none",
    )
    parser.add_argument("--mode", choices=("failfast", "permissive"), default="failfast")
    parser.add_argument("--search-location", help="where the search documents go")
    parser.add_argument("--search-format", default="json")
    parser.add_argument("--search-option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--search-table-option")
    parser.add_argument("--search-id-option", help="connector option that names the id field")
    args = parser.parse_args()
    search = None
    if args.search_location or args.search_table_option:
        search = stores.TableStore(
            args.search_location or "",
            args.search_format,
            common.options(args.search_option),
            args.search_table_option,
        )
    spark = spark_session("reelrank load")
    run(
        spark,
        args.movies,
        args.ratings,
        args.tags,
        common.table_store(args),
        search,
        args.search_id_option,
        args.user_buckets,
        args.mode,
    )
    clear(spark)
    spark.stop()


if __name__ == "__main__":
    main()
