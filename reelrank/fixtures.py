"""The base tables as views over the driver's test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.operators.stats import GENRES
from reelrank.sources import schemas

# Genres of the test movies: the report's names, some within longer ones that contain them.
_LONGER = {"Music": "Musical", "Science": "Science Fiction", "Tv": "TV Movie"}
GENRE_NAMES = tuple(_LONGER.get(name, name) for name in GENRES)

# Months of all years fall on this many places, by their number modulo it.
MONTHS = 84


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch(column: str) -> Column:
    return F.unix_seconds(F.col(column).cast("timestamp")).cast("int")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("score"),
        _epoch("l_shipdate").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(name) for name in GENRE_NAMES])

    def genre(number: str) -> Column:
        return F.element_at(names, (F.col(number) % len(GENRE_NAMES) + 1).cast("int"))

    columns = {
        "mid": F.col("p_partkey").cast("int"),
        "name": F.col("p_name"),
        "descri": F.lit(""),
        "timelong": F.concat(F.col("p_size").cast("string"), F.lit(" minutes")),
        "issue": F.lit(""),
        "shoot": F.lit("1995"),
        "language": F.lit("English"),
        "genres": F.concat_ws("|", genre("p_partkey"), genre("p_size")),
        "actors": F.col("p_brand"),
        "directors": F.col("p_type"),
    }
    return table(spark, sf_dir, "part").select(
        *[columns[name].alias(name) for name in schemas.MOVIE.names]
    )


def _item_of_event() -> Column:
    return F.regexp_extract("props", '"k": *([0-9]+)', 1).cast("int").alias("mid")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("uid"),
        _item_of_event(),
        F.col("event_type").alias("tag"),
        _epoch("ts").alias("timestamp"),
    )


def event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings that arrive as a stream."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("int").alias("uid"),
        _item_of_event(),
        (F.least(F.lit(10), F.ceil(F.col("value") / 10)) / 2).cast("double").alias("score"),
        _epoch("ts").alias("timestamp"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`event_ratings` as stream text."""
    return as_lines(event_ratings(spark, sf_dir), "|")


def as_lines(rows: DataFrame, separator: str) -> DataFrame:
    """Rows as delimited text in a ``value`` column."""
    return rows.select(
        F.concat_ws(separator, *[F.col(name).cast("string") for name in rows.columns]).alias(
            "value"
        )
    )


def embedding_factors(spark: SparkSession, sf_dir: str, key: str = "mid") -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("int").alias(key),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def month_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item vectors made of the number of ratings in each month, at any date."""
    shipped = F.col("l_shipdate")
    month = F.pmod(F.year(shipped) * 12 + F.month(shipped), F.lit(MONTHS))
    counts = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_partkey").cast("int").alias("mid"), month.alias("m"))
        .groupBy("mid", "m")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    by_month = F.map_from_entries(F.collect_list(F.struct("m", "n"))).alias("by_month")
    months = F.sequence(F.lit(0), F.lit(MONTHS - 1))
    return (
        counts.groupBy("mid")
        .agg(by_month)
        .select(
            "mid",
            F.transform(
                months, lambda m: F.coalesce(F.try_element_at("by_month", m), F.lit(0.0))
            ).alias("features"),
        )
    )
