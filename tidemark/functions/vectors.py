"""Distances and vector checks as Column expressions over array<double>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("l2", "cosine", "dot", "hamming")
_ZERO = 1e-12


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)


def dot_product(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x * x)))


def check_metric(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")


def distance(metric: str, a: Column, b: Column) -> Column:
    """Squared l2; 1 - cosine (1 for a zero vector); negated dot product; count of different components."""
    if metric == "l2":
        return _sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))
    if metric == "cosine":
        n = norm(a) * norm(b)
        return F.when(n > 0, 1.0 - dot_product(a, b) / n).otherwise(F.lit(1.0))
    if metric == "dot":
        return -dot_product(a, b)
    if metric == "hamming":
        return F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda x: x)).cast("double")
    raise ValueError(f"unknown metric {metric!r}")


def normalised(a: Column) -> Column:
    n = F.greatest(norm(a), F.lit(_ZERO))
    return F.transform(a, lambda x: x / n)


def finite(a: Column) -> Column:
    """Whether all elements are there and finite."""
    return ~F.exists(a, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def of_size(a: Column, dimension: int) -> Column:
    """The vector, or null where its size is another; such rows are counted by ``wrong_size``."""
    return F.when(F.size(a) == dimension, a)


def wrong_size(a: Column, dimension: int) -> Column:
    return F.count_if(a.isNotNull() & (F.size(a) != dimension))
