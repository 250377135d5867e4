"""Time expressions over epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def year_month(epoch_seconds: Column) -> Column:
    """``yyyyMM`` as a long, in UTC whatever the session time zone.

    Goes through a date rather than a formatted string: no time zone lookup and
    no string per row.
    """
    day = F.date_from_unix_date(F.floor(epoch_seconds / SECONDS_PER_DAY).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("long")
