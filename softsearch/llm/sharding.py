"""Minimax contiguous partition of ordered atomic groups into shards, by native operations.

Rows with equal texts form a group, groups are ordered by the SHA-256 of their text, and
every shard takes a contiguous run of groups, so a group is never split. The capacity is the
smallest one for which filling shard after shard greedily ends within the number of shards;
it is found by binary search over the running sums of the group sizes.

Running sums are formed by nested buckets of the (uniform) hash, no window holds more than
some thousand rows. The search itself looks at ``POINTS`` summarised intervals of the running sums at
most: an interval gives a lower and an upper answer to "how far does this capacity reach",
and only the intervals in which the two searches disagree are read again in finer pieces,
until both give the same capacity. So the driver holds a bounded number of rows for any input.

Defined results: a null text has size 1 and belongs to the group of the empty text; repeated
rows stay together and have slots of their own; an empty table gives no rows. If one group is
larger than an even share it sets the capacity and the other shards share the rest evenly.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from softsearch.llm.common import saved, table

#: Intervals of a first summary, and of each later look into a narrow part of it.
POINTS = 1 << 14
FINER = 1 << 11
#: Rows of a bucket within which running sums and slots are counted in order.
BUCKET = 4000


class Sums:
    """Running sums known by intervals ``(first, last, count)``, sorted."""

    def __init__(self, intervals: list[tuple[int, int, int]]):
        self.intervals = sorted(intervals)
        self.firsts = [x[0] for x in self.intervals]
        self.total = self.intervals[-1][1] if self.intervals else 0

    def reach(self, at: int, upper: bool = False) -> int:
        """Largest sum that is not above ``at``: exact, or a sum below it (``upper``: a bound above it)."""
        k = bisect_right(self.firsts, at) - 1
        if k < 0:
            return 0
        first, last, n = self.intervals[k]
        return last if last <= at else first if n <= 2 or not upper else at

    def cuts(self, capacity: int, shards: int, upper: bool = False) -> list[int]:
        ends = [0]
        for _ in range(shards):
            ends.append(self.reach(ends[-1] + capacity, upper))
        return ends

    def smallest(self, shards: int, upper: bool) -> int:
        low, high = -(-self.total // shards), self.total
        while low < high:
            mid = (low + high) // 2
            if self.cuts(mid, shards, upper)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def unsure(self, shards: int, low: int, high: int) -> list[tuple[int, int]]:
        """Parts, as ranges of sums, that decide between the capacities ``low`` and ``high``."""
        near, far = self.cuts(low, shards), self.cuts(high, shards, True)
        parts = []
        for a, b in zip(near, far):
            k, to = max(0, bisect_right(self.firsts, a + low) - 1), bisect_right(self.firsts, b + high)
            rough = [x for x in self.intervals[k:to] if x[2] > 2]
            if rough:
                parts.append((rough[0][0], rough[-1][1]))
        merged: list[tuple[int, int]] = []
        for a, b in sorted(parts):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged


def summary(groups: DataFrame, parts: list[tuple[int, int]], points: int) -> list[tuple[int, int, int]]:
    """Intervals of the running sums ``end`` within ``parts``, at most ``points`` for each."""
    part = F.lit(None).cast("int")
    cell = F.lit(None).cast("long")
    for i, (a, b) in enumerate(parts):
        inside = F.col("end").between(a, b)
        part = F.when(inside, i).otherwise(part)
        cell = F.when(inside, F.floor((F.col("end") - a) / max(1, (b - a + points) // points))).otherwise(cell)
    rows = groups.select("end", part.alias("part"), cell.alias("cell")).where("part is not null").groupBy("part", "cell")
    return [tuple(r) for r in rows.agg(F.min("end"), F.max("end"), F.count("*")).drop("part", "cell").collect()]


def minimax(groups: DataFrame, total: int, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the sums after which shards end."""
    sums = Sums(summary(groups, [(1, total)], POINTS))
    while True:
        sure, least = sums.smallest(shards, False), sums.smallest(shards, True)
        parts = sums.unsure(shards, least, sure) if sure > least else []
        if not parts:
            break
        inside = lambda x: any(a <= x[0] and x[1] <= b for a, b in parts)
        sums = Sums([x for x in sums.intervals if not inside(x)] + summary(groups, parts, FINER))
    even, at = [], 0  # as even as the capacity allows; else filled greedily
    for left in range(shards, 1, -1):
        share = sums.reach(at + -(-(total - at) // left))
        at = share if share > at else sums.reach(at + sure)
        even.append(at)
    if max(b - a for a, b in zip([0, *even], [*even, total])) > sure:
        even = sums.cuts(sure, shards)[1:-1]
    return sure, even


def running(df: DataFrame, order: str, size: str, buckets: int) -> DataFrame:
    """Add ``end``, the running sum of ``size`` over rows with distinct hex hashes ``order``."""
    top = F.conv(F.substring(order, 1, 3), 16, 10).cast("int")
    mid = F.floor(F.conv(F.substring(order, 4, 7), 16, 10).cast("long") * buckets / (1 << 28)).cast("int")
    placed = df.withColumn("top", top).withColumn("mid", mid)
    by_mid = placed.groupBy("top", "mid").agg(F.sum(size).alias("n"))
    by_top = by_mid.groupBy("top").agg(F.sum("n").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top_at = by_top.select("top", before(Window.orderBy("top")).alias("top_at"))  # 4,096 rows at most
    mid_at = by_mid.select("top", "mid", before(Window.partitionBy("top").orderBy("mid")).alias("mid_at"))
    at = mid_at.join(top_at, "top").select("top", "mid", (F.col("top_at") + F.col("mid_at")).alias("at"))
    inner = Window.partitionBy("top", "mid").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.withColumn("inner", F.sum(size).over(inner)).join(at, ["top", "mid"])
    return ends.withColumn("end", F.col("at") + F.col("inner")).drop("top", "mid", "at", "inner")


def shard(df: DataFrame, keep: list[str], text: str = "text", *, shards: int = 16) -> DataFrame:
    """Add ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` to ``keep``."""
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    keep = [c for c in keep if c not in added]
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = saved(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), (F.octet_length(value) + 1).cast("long").alias("size"),
            F.crc32(value).alias("text_crc32"), F.sha2(value, 256).alias("text_hash"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "shard-rows",
    )
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    groups = rows.groupBy("text_hash").agg(F.sum("size").alias("bytes"))
    groups = saved(running(groups, "text_hash", "bytes", 1 + count // (4096 * BUCKET)), "shard-groups")
    _, cuts = minimax(groups, total, shards)
    firsts = {r.end: r.text_hash for r in groups.where(F.col("end").isin(sorted({*cuts}))).select("end", "text_hash").collect()}
    number = sum(((F.col("text_hash") > firsts[c]) if c in firsts else F.lit(True)).cast("int") for c in cuts)
    subs = 1 + count // (shards * BUCKET)
    placed = rows.withColumn("shard", number).withColumn("sub", F.pmod(F.xxhash64("number"), F.lit(subs)))
    sizes = placed.groupBy("shard", "sub").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    at = sizes.select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"))
    inner = F.row_number().over(Window.partitionBy("shard", "sub").orderBy("number")) - 1
    return placed.withColumn("inner", inner).join(at, ["shard", "sub"]).select(
        "row.*", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("at") + F.col("inner")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), ["doc_id"])
