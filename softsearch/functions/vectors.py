"""Vector arithmetic on ``ARRAY<FLOAT|DOUBLE>`` columns, always in doubles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: smallest squared distance, so that ratios of distances stay finite
MIN_SQUARED_DISTANCE = 1e-10
#: smallest norm divided by
MIN_NORM = 1e-8


def _vec(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_vec(a), _vec(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_vec(v), F.lit(0.0), lambda acc, x: acc + x * x))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used: an
    expression inside a lambda would be evaluated for every element again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def l2_normalize(v: Column | str) -> Column:
    """``v / max(|v|, 1e-8)``; a zero vector stays zero."""
    size = F.greatest(l2_norm(v), F.lit(MIN_NORM))
    return bound(size, lambda n: F.transform(_vec(v), lambda x: x / n))


def squared_distance(x: Column | str, v: Column | str) -> Column:
    """Squared Euclidean distance of unit vectors from their dot product, kept positive."""
    return F.greatest(2.0 - 2.0 * dot(x, v), F.lit(MIN_SQUARED_DISTANCE))


def squared_distances(x: Column | str, centroids: list[list[float]]) -> Column:
    """One distance per centroid. For wide models use ``FuzzyModel.score`` (matrix product)."""
    return F.array(*[squared_distance(x, F.lit([float(e) for e in v])) for v in centroids])
