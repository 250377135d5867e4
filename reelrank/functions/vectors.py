"""Vector expressions on ``array<double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x
    )


def is_finite(a: Column) -> Column:
    """True for vectors whose parts are all there and finite."""
    good = F.forall(a, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(good, F.lit(False))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))
