"""Best rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, with their ``rank`` from 1.

    Catalyst turns the rank filter into a group limit on both sides of the shuffle, so each
    map task sends at most ``k`` rows of a group, however large the group is.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
