"""Distances of vectors stored as arrays, as JVM-side expressions summed from left to right in double."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _sum(products: Column) -> Column:
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def squared_l2(a: Column, b: Column) -> Column:
    def square(x: Column, y: Column) -> Column:
        d = x.cast("double") - y.cast("double")
        return d * d

    return _sum(F.zip_with(a, b, square))


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """null where one of the vectors is zero."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def distance_score(d: Column) -> Column:
    """1 / (1 + distance), rounded to 4 places."""
    return F.round(1 / (1 + d), 4)
