"""The semantic cache on a stream of queries, and its running counters."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from softsearch.config import DEFAULTS, cut_lineage, scratch_path
from softsearch.operators.fcm import FuzzyModel
from softsearch.operators.semcache import extend, log_rows, lru_step, split_by_flush
from softsearch.sources.commits import commit, data_folder, versions

_STATE = "seq array<long>, access_time array<long>, b1 array<int>, b2 array<int>, vec array<double>"
DECISIONS = "cache_id string, seq long, cache_hit boolean, matched_seq long, similarity double"


def _table(cache_id: str, seq, access, b1, b2, vec: list) -> pa.Table:
    n = len(seq)
    return pa.table(
        {
            "cache_id": pa.array([cache_id] * n, pa.string()),
            "seq": pa.array(seq, pa.int64()),
            "access_time": pa.array(access, pa.int64()),
            "vec": pa.array(vec, pa.list_(pa.float64())),
            "b1": pa.array(b1, pa.int32()),
            "b2": pa.array(b2, pa.int32()),
        }
    )


def stream_decisions(
    log: DataFrame,
    model: FuzzyModel,
    threshold: float = DEFAULTS.cache_threshold,
    max_size: int = DEFAULTS.cache_max_size,
    boundary: float = DEFAULTS.boundary,
) -> DataFrame:
    """Hit or miss for a streaming log ``(cache_id, seq, embedding)``.

    The state of a cache is its entries, at most ``max_size``. It has no time-out, as
    entries never expire. A micro-batch is worked through in the order of ``seq``; the
    source's trigger limits (``maxFilesPerTrigger`` and the like) bound its size.
    """
    step = lru_step(threshold, max_size)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames))
        optional = lambda s: [None if pd.isna(v) else int(v) for v in s]
        table = _table(
            key[0], rows["seq"].tolist(), [None] * len(rows), rows["b1"].astype(int).tolist(),
            optional(rows["b2"]), rows["vec"].tolist(),
        )
        if state.exists:
            seq, access, b1, b2, flat = (list(part) for part in state.get)
            vec = np.asarray(flat, dtype=np.float64).reshape(len(seq), -1).tolist()
            held = _table(key[0], seq, access, b1, [None if b < 0 else b for b in b2], vec)
            table = pa.concat_tables([held, table])
        done = step(table).to_pylist()
        entries = [r for r in done if r["kind"] == "entry"]
        state.update(
            (
                [r["seq"] for r in entries], [r["access_time"] for r in entries],
                [r["b1"] for r in entries], [-1 if r["b2"] is None else r["b2"] for r in entries],
                [x for r in entries for x in r["vec"]],
            )
        )
        columns = ["cache_id", "seq", "cache_hit", "matched_seq", "similarity"]
        out = pd.DataFrame([[r[c] for c in columns] for r in done if r["kind"] == "decision"], columns=columns)
        out["matched_seq"] = out["matched_seq"].astype("Int64")
        out["similarity"] = out["similarity"].astype("Float64")
        yield out

    rows = log_rows(model.score(log), boundary).drop("access_time")
    return rows.groupBy("cache_id").applyInPandasWithState(
        update, DECISIONS, _STATE, "append", GroupStateTimeout.NoTimeout
    )


# -- unbounded caches, batch by batch ------------------------------------------------

_COMMIT = "version long, folder string"
#: control rows of the log have a true ``flush`` and no vector
LOG = "cache_id string, seq long, embedding array<float>, flush boolean"


def _kept(spark: SparkSession, path: str, kind: str) -> DataFrame | None:
    """All committed rows of a kind: ``decision``, ``entry`` or ``flush``."""
    if not versions(spark, path):
        return None
    found = spark.read.schema(_COMMIT).json(f"{path}/commit/v-*.json").collect()  # a row per batch
    folders = [f"{path}/{r.folder}/{kind}" for r in found]
    return spark.read.parquet(*folders)


def cached_stream(
    log: DataFrame,
    model: FuzzyModel,
    path: str,
    threshold: float = DEFAULTS.cache_threshold,
    boundary: float = DEFAULTS.boundary,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Answer a streaming log ``LOG``, in the order of ``seq`` from batch to batch, by caches
    that store every miss until they are flushed.

    A micro-batch of any size is decided by ``semcache.extend`` against the stored entries of
    its caches, spread over tasks like a batch replay. Its decisions, new entries and flushes
    are written to a folder of their own and become valid together by one version file that
    can be made once: a batch that is delivered again, or that two drivers run at once, counts
    once, and one that fails half-way not at all. The order within a batch doesn't matter, so
    any split of the log into batches gives the decisions of ``replay``.
    """
    spark = log.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream")

    def settle(batch: DataFrame, batch_id: int) -> None:
        if batch_id + 1 in versions(spark, path):
            return
        rows = cut_lineage(batch.select("cache_id", "seq", "embedding", "flush"))
        flushes = rows.where("flush").select("cache_id", "seq")
        before = _kept(spark, path, "flush")
        marks = flushes if before is None else before.unionByName(flushes)
        asked = model.score(rows.where("NOT coalesce(flush, false)").drop("flush"))
        step = extend(_kept(spark, path, "entry"), split_by_flush(asked, marks), threshold, boundary)
        folder = data_folder()
        for kind, part in (("decision", step.decisions), ("entry", step.added), ("flush", flushes)):
            part.write.parquet(f"{path}/{folder}/{kind}")
        commit(spark, path, batch_id + 1, [{"version": batch_id + 1, "folder": folder}])

    return (
        log.writeStream.foreachBatch(settle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stored_decisions(spark: SparkSession, path: str) -> DataFrame:
    """The decisions of all committed batches; stretches between flushes are caches ``name#n``."""
    found = _kept(spark, path, "decision")
    return spark.createDataFrame([], DECISIONS) if found is None else found


def stored_entries(spark: SparkSession, path: str) -> DataFrame:
    """``cache_id, seq`` of the entries of all stretches."""
    found = _kept(spark, path, "entry")
    return (spark.createDataFrame([], "cache_id string, seq long") if found is None else found).select("cache_id", "seq")


def stream_stats(decisions: DataFrame) -> DataFrame:
    """Running hits and misses per cache over a stream of decisions."""
    return decisions.groupBy("cache_id").agg(
        F.count_if("cache_hit").alias("hit_count"), F.count_if(~F.col("cache_hit")).alias("miss_count")
    )
