"""The first rows of each group, also when one group holds most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Spark cuts groups before the shuffle up to this many rows (its default threshold)
PRUNED_RANK = 1000
_SALTS = 64


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """The ``n`` first rows of each group in a total order, numbered from 1.

    Up to ``PRUNED_RANK`` rows every map task already drops what cannot be among the first
    ``n``. Beyond, groups are first cut in salted parts, so that no task sorts a whole hot
    group.
    """
    if n > PRUNED_RANK:
        salt = F.pmod(F.xxhash64(*[c for c in df.columns if c not in by]), F.lit(_SALTS))
        part = Window.partitionBy(*by, "_salt").orderBy(*order)
        df = df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(part))
        df = df.where(F.col("_r") <= n).drop("_salt", "_r")
    whole = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(whole)).where(F.col(rank_col) <= n)
