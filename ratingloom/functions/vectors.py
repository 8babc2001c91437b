"""Vector expressions over array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, v: total + v)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, v: total + v * v))


def unit(a: Column) -> Column:
    """The vector at length one; a zero vector stays zero."""
    length = norm(a)
    return F.when(length == 0, a).otherwise(F.transform(a, lambda v: v / length))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def zeros(dimension: int) -> Column:
    return F.array_repeat(F.lit(0.0), dimension)
