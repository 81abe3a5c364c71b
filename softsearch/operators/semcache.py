"""A cache of answers keyed by meaning, resolved for whole query logs.

A log row is ``(cache_id, seq, embedding, membership)``; ``seq`` orders the queries of a
cache and is its clock. A query looks into the buckets of its dominant cluster and, at a
boundary, of the second; the most similar entry at or above the threshold is a hit. Only
misses are stored, so whether a query hits depends on every decision before it.

``replay`` resolves that order without walking through it row by row: rounds over the whole
log settle every query whose earlier neighbours are settled, see ``_stored_queries``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from softsearch.config import DEFAULTS, broadcast_if_small, cut_lineage, scratch_path
from softsearch.functions.membership import buckets
from softsearch.functions.vectors import dot
from softsearch.operators.fcm import to_list_array, to_matrix
from softsearch.operators.ranking import top_per_group
from softsearch.operators.similarity import SIM_DECIMALS, similar_rows, similarity_topk

#: bytes of one side that every task of a search in a cache gets whole, and vector bytes of a tile where
#: both sides are larger: the rounds search the whole log in itself, so a task holds these, and no more
SENT_BYTES, CACHE_TILE_BYTES = 8 << 20, 16 << 20
#: undecided queries of a cache that one task settles at the end
TAIL_ROWS = 256
#: queries per cache and slice of the bounded replay
SLICE_ROWS = 100_000

_SEP = "\x1f"


@dataclass(frozen=True)
class Replay:
    """``decisions(cache_id, seq, cache_hit, matched_seq, similarity)`` and the
    ``entries(cache_id, seq, access_time)`` the caches hold afterwards."""

    decisions: DataFrame
    entries: DataFrame


def bucket_rows(log: DataFrame, boundary: float = DEFAULTS.boundary) -> DataFrame:
    """One row per bucket a query is filed under: ``(cache_id, seq, bucket, bucket_rank)``."""
    return log.select("cache_id", "seq", F.posexplode(buckets("membership", boundary)).alias("bucket_rank", "bucket"))


def _row_id() -> Column:
    return F.concat_ws(_SEP, "cache_id", F.col("seq").cast("string"))


def _cache_side(log: DataFrame, boundary: float) -> DataFrame:
    keys = F.transform(buckets("membership", boundary), lambda b: F.concat_ws(_SEP, "cache_id", b.cast("string")))
    return log.select(
        _row_id().alias("id"), "cache_id", "seq", F.col("seq").alias("ord"), F.col("embedding").alias("vec"), keys.alias("keys")
    )


def lookup(
    queries: DataFrame,
    entries: DataFrame,
    threshold: float = DEFAULTS.cache_threshold,
    boundary: float = DEFAULTS.boundary,
    *,
    earlier: bool = False,
    **join_options,
) -> DataFrame:
    """The best entry of each query's buckets, if it reaches the threshold.

    Read-only: nothing is stored. With ``earlier`` an entry answers only later queries.
    """
    return _match(_cache_side(queries, boundary), _cache_side(entries, boundary), threshold, earlier, **join_options)


def _bounded(join_options: dict) -> dict:
    return {"max_bytes": SENT_BYTES, "tile_bytes": CACHE_TILE_BYTES, **join_options}


def _match(queries: DataFrame, entries: DataFrame, threshold: float, earlier: bool, **join_options) -> DataFrame:
    best = similarity_topk(
        queries, entries, 1, min_sim=threshold, earlier=earlier, ranked_keys=True, **_bounded(join_options)
    ).select(F.col("left_id").alias("id"), F.col("ord").alias("matched_seq"), "similarity")
    return queries.select("id", "cache_id", "seq").join(best, "id", "left").select(
        "cache_id", "seq", F.col("matched_seq").isNotNull().alias("cache_hit"), "matched_seq", "similarity"
    )


# -- unbounded replay -------------------------------------------------------------


def _settle_block(threshold: float):
    """First-come leaders among the rows of one block: a row is stored unless an earlier
    stored row in a shared bucket is similar enough."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        x, key_lists = to_matrix(table.column("vec")), table.column("keys").to_pylist()
        code = {key: i for i, key in enumerate(sorted({k for ks in key_lists for k in ks}))}
        filed = np.zeros((len(x), len(code)), dtype=np.float32)
        for row, keys in enumerate(key_lists):
            filed[row, [code[k] for k in keys]] = 1.0
        answered, leaders = np.zeros(len(x), dtype=bool), []
        for start in range(0, len(x), 512):
            stop = min(start + 512, len(x))
            if leaders:
                near = np.round(x[start:stop] @ x[leaders].T, SIM_DECIMALS) >= threshold
                answered[start:stop] = (near & (filed[start:stop] @ filed[leaders].T > 0)).any(axis=1)
            near = np.round(x[start:stop] @ x[start:stop].T, SIM_DECIMALS) >= threshold
            near &= filed[start:stop] @ filed[start:stop].T > 0
            for row in range(start, stop):
                if not answered[row]:
                    leaders.append(row)
                    answered[row + 1 : stop] |= near[row - start, row + 1 - start :]
        return table.take(pa.array(leaders, pa.int64()))

    return run


def _first_copies(nodes: DataFrame, threshold: float) -> DataFrame:
    """One row per set of equal vectors in equal buckets, the earliest: it answers its
    copies. Vectors too short to answer their own copy are all kept."""
    own = F.round(dot("vec", "vec"), SIM_DECIMALS)
    apart = F.when(own >= threshold, F.lit(None)).otherwise(F.col("seq"))
    firsts = nodes.groupBy("cache_id", "vec", "keys", apart.alias("apart")).agg(F.min("seq").alias("seq"))
    return firsts.select(_row_id().alias("id"), "cache_id", "seq", F.col("seq").alias("ord"), "vec", "keys")


def _stored_queries(
    nodes: DataFrame, threshold: float, tail_rows: int = TAIL_ROWS, stop_after: int | None = None, **join_options
) -> tuple[DataFrame, DataFrame | None]:
    """The queries an unbounded cache stores, and the caches that store more than
    ``stop_after`` (their search is cut short).

    The stored queries are the lexicographically first independent set of the conflict graph:
    queries of a cache that share a bucket and are similar enough. A round settles, all over
    the log at once, the undecided queries without an undecided earlier neighbour (stored) and
    the neighbours of those (answered). So rounds follow the longest chain of neighbours, in
    which each waits for the one before, and not the length of the log. Only whether a query
    has such a neighbour leaves a task, never the pairs. Of a cache with at most ``tail_rows``
    undecided queries the rest of the chain is settled in one task.
    """
    spark, schema = nodes.sparkSession, nodes.schema
    undecided = cut_lineage(_first_copies(nodes, threshold))
    path, step, over = scratch_path(spark, "leaders"), 0, None
    while True:
        sizes = undecided.groupBy("cache_id").agg(F.count(F.lit(1)).alias("n"))
        largest, smallest = sizes.agg(F.max("n"), F.min("n")).first()
        if largest is None and step > 0:
            break
        last = (largest or 0) <= tail_rows
        tail, many = (undecided, None) if last else (None, undecided)
        if not last and smallest <= tail_rows:
            few = broadcast_if_small(sizes.where(F.col("n") <= tail_rows).select("cache_id"))
            tail, many = undecided.join(few, "cache_id", "left_semi"), undecided.join(few, "cache_id", "left_anti")
        leaders = tail.groupBy("cache_id").applyInArrow(_settle_block(threshold), schema) if tail is not None else None
        if many is not None:
            many = cut_lineage(many.join(_with_neighbour(many, many, threshold, **join_options), "id", "left").select(*schema.names, "waits"))
            free = many.where("waits IS NULL").select(*schema.names)
            leaders = free if leaders is None else leaders.unionByName(free)
        leaders.write.parquet(f"{path}/round={step}")
        if stop_after is not None:
            stored = spark.read.parquet(path).groupBy("cache_id").agg(F.count(F.lit(1)).alias("n"))
            over = cut_lineage(stored.where(F.col("n") > stop_after).select("cache_id"))
        if many is None:
            break
        rest = many.where("waits").select(*schema.names)
        if over is not None:
            rest = rest.join(broadcast_if_small(over), "cache_id", "left_anti")
        recent = spark.read.parquet(f"{path}/round={step}").select(*schema.names)
        answered = _with_neighbour(rest, recent, threshold, **join_options)
        undecided = cut_lineage(rest.join(answered, "id", "left_anti").select(*schema.names))
        step += 1
    return spark.read.parquet(path).select(*schema.names), over


def _with_neighbour(rows: DataFrame, others: DataFrame, threshold: float, **join_options) -> DataFrame:
    """``(id, waits)``, ``waits`` true, of the rows with an earlier neighbour among ``others``."""
    found = similar_rows(rows, others, threshold, earlier=True, **_bounded(join_options))
    return found.select(F.col("left_id").alias("id"), F.lit(True).alias("waits"))


def _access_times(leaders: DataFrame, decisions: DataFrame) -> DataFrame:
    hits = decisions.where("cache_hit").groupBy("cache_id", F.col("matched_seq").alias("seq")).agg(F.max("seq").alias("last"))
    return leaders.select("cache_id", "seq").join(hits, ["cache_id", "seq"], "left").select(
        "cache_id", "seq", F.coalesce("last", "seq").alias("access_time")
    )


@dataclass(frozen=True)
class Step:
    """What a stretch of a log adds to caches that hold entries already."""

    decisions: DataFrame
    added: DataFrame


def extend(held: DataFrame | None, log: DataFrame, threshold: float, boundary: float = DEFAULTS.boundary, **join_options) -> Step:
    """Decide the queries of ``log``, all later than what is ``held`` (the ``added`` rows of the
    steps before, or None): first the held entries answer what they can, then the rest settles
    what it stores, and the best of both answers each query."""
    nodes = cut_lineage(_cache_side(log, boundary))
    fresh = nodes
    if held is not None:
        names = broadcast_if_small(nodes.select("cache_id").distinct())
        held = cut_lineage(held.select(*nodes.columns).join(names, "cache_id", "left_semi"))
        fresh = nodes.join(_with_neighbour(nodes, held, threshold, **join_options), "id", "left_anti")
    added, _ = _stored_queries(fresh, threshold, **join_options)
    entries = added if held is None else held.unionByName(added)
    return Step(_match(nodes, entries, threshold, True, **join_options), added)


# -- bounded replay ---------------------------------------------------------------


def _in_slices(rows: DataFrame, slice_rows: int) -> DataFrame:
    """Number runs of at most ``slice_rows`` rows in the order of cache and ``seq``.

    Range partitioning splits a cache that holds most of the log over many tasks; the row
    numbers of ``monotonically_increasing_id`` grow along that order.
    """
    ordered = rows.repartitionByRange("cache_id", "seq").sortWithinPartitions("cache_id", "seq")
    return cut_lineage(ordered.withColumn("slice", F.floor(F.monotonically_increasing_id() / slice_rows)))

_STEP = (
    "kind string, cache_id string, seq long, cache_hit boolean, matched_seq long, similarity double, "
    "access_time long, vec array<double>, b1 int, b2 int"
)


def lru_step(threshold: float, max_size: int):
    """Continue one cache over one slice of its log, in order.

    Held per group: at most ``max_size`` entries and the slice. Similarities of a chunk of
    queries come from one matrix product; the walk itself only compares numbers.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        held = table.column("access_time").is_valid().to_numpy()
        cache_id = table.column("cache_id")[0].as_py()
        x = to_matrix(table.column("vec"))
        seq = table.column("seq").to_numpy()
        b = np.stack([table.column(c).fill_null(-1).to_numpy() for c in ("b1", "b2")], axis=1)
        slots, used = max_size + 1, int(held.sum())
        vec, entry, filed = np.zeros((slots, x.shape[1])), np.full(slots, -1), np.full((slots, 2), -2)
        vec[:used], entry[:used], filed[:used] = x[held], seq[held], b[held]
        times = table.column("access_time").drop_null().to_numpy()
        # slots by last use, oldest first: seq only grows, so a used slot moves to the end
        access = {int(s): int(times[s]) for s in np.argsort(times)}
        free = list(range(slots - 1, used - 1, -1))
        rows = np.flatnonzero(~held)
        hit, match, best_sim = np.zeros(len(rows), bool), np.full(len(rows), -1), np.zeros(len(rows))
        for start in range(0, len(rows), 256):
            chunk = rows[start : start + 256]
            sims = np.round(x[chunk] @ vec.T, SIM_DECIMALS)
            mutual = np.round(x[chunk] @ x[chunk].T, SIM_DECIMALS)
            near, near_mutual = (sims >= threshold) & (entry >= 0), mutual >= threshold
            for i, row in enumerate(chunk):
                at, now, own = start + i, int(seq[row]), b[row]
                found = near[i].nonzero()[0]
                if len(found):
                    first = (filed[found] == own[0]).any(axis=1)
                    second = (filed[found] == own[1]).any(axis=1) if own[1] >= 0 else np.zeros_like(first)
                    shared = first | second
                    found, first = found[shared], first[shared]
                if len(found):
                    slot = int(found[np.lexsort((entry[found], ~first, -sims[i, found]))[0]])
                    hit[at], match[at], best_sim[at] = True, entry[slot], sims[i, slot]
                    del access[slot]
                    access[slot] = now
                    continue
                slot = free.pop()
                vec[slot], entry[slot], access[slot], filed[slot] = x[row], now, now, own
                sims[:, slot], near[:, slot] = mutual[:, i], near_mutual[:, i]
                if not free:
                    oldest = next(iter(access))
                    del access[oldest]
                    entry[oldest], filed[oldest], near[:, oldest] = -1, -2, False
                    free.append(oldest)
        kept = np.array(sorted(access), dtype=int)
        last = np.array([access[s] for s in kept], dtype=np.int64)
        return _step_table(cache_id, seq[rows], hit, match, best_sim, entry[kept], last, vec[kept], filed[kept])

    return run


def _step_table(cache_id, seq, hit, match, sim, entry, access, vec, filed) -> pa.Table:
    n, e = len(seq), len(entry)
    second = np.concatenate([np.full(n, -1), filed[:, 1]])
    return pa.table(
        {
            "kind": pa.array(["decision"] * n + ["entry"] * e),
            "cache_id": pa.array([cache_id] * (n + e), pa.string()),
            "seq": pa.array(np.concatenate([seq, entry]).astype(np.int64)),
            "cache_hit": pa.array(hit.tolist() + [None] * e, pa.bool_()),
            "matched_seq": pa.array([int(m) if h else None for m, h in zip(match, hit)] + [None] * e, pa.int64()),
            "similarity": pa.array([float(s) if h else None for s, h in zip(sim, hit)] + [None] * e, pa.float64()),
            "access_time": pa.array([None] * n + access.tolist(), pa.int64()),
            "vec": pa.concat_arrays([pa.nulls(n, pa.list_(pa.float64())), to_list_array(vec).cast(pa.list_(pa.float64()))]),
            "b1": pa.array([None] * n + filed[:, 0].tolist(), pa.int32()),
            "b2": pa.array(second.astype(np.int32), pa.int32(), mask=second < 0),
        }
    )


def log_rows(log: DataFrame, boundary: float) -> DataFrame:
    """Log rows in the form the bounded step takes."""
    filed = buckets("membership", boundary)
    return log.select(
        "cache_id", "seq", F.lit(None).cast("long").alias("access_time"),
        F.col("embedding").cast("array<double>").alias("vec"),
        F.get(filed, F.lit(0)).alias("b1"), F.get(filed, F.lit(1)).alias("b2"),
    )


def replay_lru(
    log: DataFrame,
    threshold: float = DEFAULTS.cache_threshold,
    max_size: int = DEFAULTS.cache_max_size,
    boundary: float = DEFAULTS.boundary,
    slice_rows: int = SLICE_ROWS,
) -> Replay:
    """Replay with least-recently-used eviction: in order per cache, caches in parallel.

    A long log is cut into slices in the order of ``seq``, so that no task holds many
    more than ``slice_rows`` queries of a cache; between slices the entries (at most
    ``max_size`` per cache) are written to the shared folder and read back, so a lost
    executor costs at most the running slice.
    """
    spark = log.sparkSession
    rows = cut_lineage(log_rows(log, boundary))
    sizes = rows.groupBy("cache_id").agg(F.count(F.lit(1)).alias("n"))
    largest, n_slices = sizes.agg(F.max("n")).first()[0] or 0, 1
    if largest > slice_rows:
        rows = _in_slices(rows, max(1, slice_rows // 4))
        runs = rows.groupBy("cache_id", "slice").agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy("cache_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        step = F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / slice_rows).cast("int")
        steps = cut_lineage(runs.select("cache_id", "slice", step.alias("step")).where("step > 0"))
        n_slices = 1 + steps.agg(F.max("step")).first()[0]
        path = scratch_path(spark, "slices")
        placed = rows.join(broadcast_if_small(steps), ["cache_id", "slice"], "left").drop("slice")
        placed.withColumn("step", F.coalesce("step", F.lit(0))).write.partitionBy("step").parquet(path)
        rows = spark.read.parquet(path)
    out = scratch_path(spark, "replay")
    for i in range(n_slices):
        part = rows if n_slices == 1 else rows.where(F.col("step") == i).drop("step")
        if i > 0:  # its caches took part in the slice before
            state = spark.read.parquet(f"{out}/slice={i - 1}").where("kind = 'entry'").select(*part.columns)
            ids = broadcast_if_small(part.select("cache_id").distinct())
            part = state.join(ids, "cache_id", "left_semi").unionByName(part)
        step = part.groupBy("cache_id").applyInArrow(lru_step(threshold, max_size), _STEP)
        step.write.partitionBy("kind").parquet(f"{out}/slice={i}")
    done = spark.read.parquet(out)
    decisions = done.where("kind = 'decision'").select("cache_id", "seq", "cache_hit", "matched_seq", "similarity")
    return Replay(decisions, _last_entries(done))


def _last_entries(done: DataFrame) -> DataFrame:
    """Of each cache the entries held after the last slice it took part in."""
    held = done.where("kind = 'entry'").select("cache_id", "seq", "access_time", "slice")
    last = held.groupBy("cache_id").agg(F.max("slice").alias("slice"))
    return held.join(last, ["cache_id", "slice"]).select("cache_id", "seq", "access_time")


# -- replay -----------------------------------------------------------------------


def replay(
    log: DataFrame,
    threshold: float = DEFAULTS.cache_threshold,
    max_size: int | None = DEFAULTS.cache_max_size,
    boundary: float = DEFAULTS.boundary,
    *,
    tail_rows: int = TAIL_ROWS,
    slice_rows: int = SLICE_ROWS,
    **join_options,
) -> Replay:
    """Decide hit or miss for every query of the log.

    A cache whose stored queries fit ``max_size`` never evicts, so the parallel form is
    exact for it; only the caches above it (none with ``max_size=None``) are replayed in
    order by ``replay_lru``.
    """
    nodes = cut_lineage(_cache_side(log, boundary))
    leaders, over = _stored_queries(nodes, threshold, tail_rows, max_size, **join_options)
    if over is not None and over.isEmpty():
        over = None
    if over is not None:
        nodes = nodes.join(over, "cache_id", "left_anti")
        leaders = leaders.join(over, "cache_id", "left_anti")
    decisions = _match(nodes, leaders, threshold, True, **join_options)
    entries = _access_times(leaders, decisions)
    if over is not None:
        rest = replay_lru(log.join(over, "cache_id", "left_semi"), threshold, max_size, boundary, slice_rows)
        decisions, entries = decisions.unionByName(rest.decisions), entries.unionByName(rest.entries)
    return Replay(decisions, entries)


# -- upkeep -----------------------------------------------------------------------


def touch(entries: DataFrame, decisions: DataFrame) -> DataFrame:
    """Refresh ``access_time`` of the entries that were hit; the clock never runs back."""
    hits = decisions.where("cache_hit").groupBy("cache_id", F.col("matched_seq").alias("seq")).agg(F.max("seq").alias("last_hit"))
    return entries.join(hits, ["cache_id", "seq"], "left").withColumn(
        "access_time", F.greatest("access_time", F.coalesce("last_hit", "access_time"))
    ).drop("last_hit")


def evict_lru(entries: DataFrame, max_size: int = DEFAULTS.cache_max_size) -> DataFrame:
    """Keep the ``max_size`` most recently used entries of each cache."""
    order = [F.desc("access_time"), F.desc("seq")]
    return top_per_group(entries, ["cache_id"], order, max_size, "place").drop("place")


def stats(decisions: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries, hits, misses and hit rate over all caches; one row, also for empty input."""
    held = entries.agg(F.count(F.lit(1)).alias("total_entries"))
    hits, misses = F.count_if("cache_hit"), F.count_if(~F.col("cache_hit"))
    asked = decisions.agg(
        hits.alias("hit_count"), misses.alias("miss_count"),
        F.when(hits + misses == 0, 0.0).otherwise(F.round(hits / (hits + misses), 4)).alias("hit_rate"),
    )
    one = F.lit(1).alias("one")
    return held.select(one, "*").join(asked.select(one, "*"), "one").drop("one")


def stats_by_cache(decisions: DataFrame) -> DataFrame:
    hits = F.count_if("cache_hit")
    return decisions.groupBy("cache_id").agg(
        hits.alias("hit_count"),
        (F.count(F.lit(1)) - hits).alias("miss_count"),
        F.round(hits / F.count(F.lit(1)), 4).alias("hit_rate"),
    )


def flush(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The emptied cache and the report of how many entries went."""
    report = entries.agg(
        F.lit("Cache flushed successfully.").alias("message"), F.count(F.lit(1)).alias("entries_cleared")
    )
    return entries.limit(0), report


def split_by_flush(log: DataFrame, flushes: DataFrame) -> DataFrame:
    """Apply flushes to a log: every stretch between two flushes becomes a cache of its own.

    ``flushes(cache_id, seq)`` are control rows; a flush acts on the queries after it, and
    repeated ones count once. ``cache_id`` gets the number of flushes so far appended, so
    ``replay`` needs no further rule; what is held or counted after the last flush is what
    ``last_stretch`` selects. The numbers are running sums over both logs: by ranges of
    (cache, seq), so a busy cache is spread over tasks, and sums of the ranges before.
    """
    marks = flushes.select(F.col("cache_id").cast("string"), F.col("seq").cast("long")).distinct()
    columns = [F.col(c) for c in log.columns]
    both = log.select(*columns, F.lit(0).alias("_flush")).unionByName(marks.withColumn("_flush", F.lit(1)), allowMissingColumns=True)
    ranged = both.repartitionByRange("cache_id", "seq", "_flush").withColumn("_range", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    sums = ranged.groupBy("cache_id", "_range").agg(F.sum("_flush").alias("n"))
    before = Window.partitionBy("cache_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    at = sums.select(F.col("cache_id").alias("_cache"), F.col("_range").alias("_at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("cache_id", "_range").orderBy("seq", "_flush").rowsBetween(Window.unboundedPreceding, 0)
    counted = ranged.withColumn("_inner", F.sum("_flush").over(inner)).where("_flush = 0")
    numbered = counted.join(at, F.col("cache_id").eqNullSafe(F.col("_cache")) & (F.col("_range") == F.col("_at")))
    stretch = F.concat_ws("#", "cache_id", (F.col("_before") + F.col("_inner")).cast("string"))
    return numbered.withColumn("cache_id", stretch).select(*log.columns)


def last_stretch(rows: DataFrame, log: DataFrame, flushes: DataFrame) -> DataFrame:
    """The decisions or entries of a flushed log that still count: those after the last flush
    of their cache. ``log`` is the one that was split."""
    last = flushes.select("cache_id", F.col("seq").cast("long").alias("seq")).distinct().groupBy("cache_id").agg(F.count("*").alias("n"))
    held = log.select("cache_id").distinct().join(last, "cache_id", "left")
    name = F.concat_ws("#", "cache_id", F.coalesce("n", F.lit(0)).cast("string"))
    return rows.join(broadcast_if_small(held.select(name.alias("cache_id"))), "cache_id", "left_semi")


def health(table: DataFrame, entries: DataFrame, threshold: float = DEFAULTS.cache_threshold) -> DataFrame:
    one = F.lit(1).alias("one")
    docs = table.agg(F.count(F.lit(1)).alias("vector_db_docs")).select(one, "*")
    held = entries.agg(F.count(F.lit(1)).alias("cache_entries")).select(one, "*")
    return docs.join(held, "one").select(
        F.lit("ok").alias("status"), "vector_db_docs", "cache_entries", F.lit(threshold).alias("cache_threshold")
    )
