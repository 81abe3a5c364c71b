"""Fuzzy memberships and what is read off them, as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from softsearch.config import DEFAULTS
from softsearch.functions.vectors import MIN_SQUARED_DISTANCE, bound


def ratio_exponent(m: float, exponent: str = "squared") -> float:
    """Power put on ratios of *squared* distances.

    ``squared`` is 2/(m-1), the default; ``bezdek`` is the textbook 1/(m-1).
    """
    if m <= 1.0:
        raise ValueError("fuzziness m must be greater than 1")
    if exponent not in ("squared", "bezdek"):
        raise ValueError(f"unknown exponent {exponent!r}")
    return (2.0 if exponent == "squared" else 1.0) / (m - 1.0)


def memberships(d2: Column | str, m: float = DEFAULTS.m, exponent: str = "squared") -> Column:
    """Memberships from squared distances; a point on a centroid belongs to it alone.

    Every distance is divided by the row's smallest first, which leaves the ratios as they
    are but keeps the powers within [0, 1].
    """
    d2 = F.col(d2) if isinstance(d2, str) else d2
    power = ratio_exponent(m, exponent)
    nearest = F.struct(F.array_min(d2).alias("d"), F.array_position(d2, F.array_min(d2)).alias("at"))
    hard = bound(nearest, lambda n: F.transform(d2, lambda _, i: F.when(i == n["at"] - 1, 1.0).otherwise(0.0)))
    weights = bound(nearest, lambda n: F.transform(d2, lambda d: F.pow(n["d"] / d, F.lit(power))))
    shares = lambda w, total: F.transform(w, lambda x: x / total)
    summed = lambda w: F.aggregate(w, F.lit(0.0), lambda acc, x: acc + x)
    soft = bound(weights, lambda w: bound(summed(w), lambda total: shares(w, total)))
    return F.when(F.array_min(d2) < MIN_SQUARED_DISTANCE, hard).otherwise(soft)


def _u(u: Column | str) -> Column:
    return F.col(u) if isinstance(u, str) else u


def dominant_cluster(u: Column | str) -> Column:
    """Index of the largest membership, the lowest on ties."""
    return (F.array_position(_u(u), F.array_max(_u(u))) - 1).cast("int")


def ranked(u: Column | str) -> Column:
    """``array<struct<negated membership, cluster>>`` by membership desc, cluster asc."""
    pairs = F.transform(_u(u), lambda x, i: F.struct((-x).alias("neg"), i.cast("int").alias("cluster")))
    return F.array_sort(pairs)


def nth_cluster(u: Column | str, n: int) -> Column:
    """The cluster with the n-th largest membership (1-based); null if there is none."""
    return F.get(ranked(u), F.lit(n - 1))["cluster"]


def nth_membership(u: Column | str, n: int) -> Column:
    return F.get(F.sort_array(_u(u), asc=False), F.lit(n - 1))


def is_boundary(u: Column | str, threshold: float = DEFAULTS.boundary) -> Column:
    """Is the second largest membership strictly above the threshold?"""
    return F.coalesce(nth_membership(u, 2) > threshold, F.lit(False))


def buckets(u: Column | str, threshold: float = DEFAULTS.boundary) -> Column:
    """Clusters a vector is filed under, in order: the dominant, and the second if boundary."""

    def filed(top: Column) -> Column:
        second = F.get(top, F.lit(1))
        n = F.when(-second["neg"] > threshold, 2).otherwise(1)
        return F.transform(F.slice(top, F.lit(1), n), lambda r: r["cluster"])

    return bound(ranked(u), filed)


def entropy(u: Column | str) -> Column:
    return -F.aggregate(_u(u), F.lit(0.0), lambda acc, x: acc + x * F.ln(x + 1e-12))
