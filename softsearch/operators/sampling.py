"""Exact-size samples that do not depend on the layout of the data."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from softsearch.config import cut_lineage


def sample_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def sample_fixed(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash of their key (all, if there are fewer).

    Sorting ``n`` candidates per task would move ``tasks * n`` rows to one place. So rows
    are first cut by a hash bound that leaves slightly more than ``n`` of them; only if the
    bound was too tight, which the count tells, is the uncut table sorted.
    """
    total = df.count()
    hashed = df.withColumn("_h", sample_hash(key, seed))
    order = [F.col("_h"), F.col(key)]
    if total > 4 * n:
        share = (n + 10 * math.sqrt(n) + 50) / total
        if share < 1.0:
            bound = f"{int(share * 16**12):012x}"
            near = cut_lineage(hashed.where(F.col("_h") < bound))
            if near.count() >= n:
                hashed = near
    return hashed.orderBy(*order).limit(n).drop("_h")
