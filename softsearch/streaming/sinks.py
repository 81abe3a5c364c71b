"""Running streams to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from softsearch.config import scratch_path
from softsearch.sources.vector_table import upsert_into


def append_to(stream: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet table, reading what is available now."""
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "stream")
    return (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def upsert_stream(
    updates: DataFrame, path: str, checkpoint: str | None = None, key: str = "doc_id", order: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Keep a stored vector table up to date from a stream of rows.

    A batch that is delivered again rewrites the same rows, so the table is right after a
    restart as well. ``once`` leaves such a batch out; use it where this stream alone
    writes to the table, as it goes by the batch number stored there.
    """
    checkpoint = checkpoint or scratch_path(updates.sparkSession, "stream")

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_into(path, batch, key=key, order=order, batch=batch_id if once else None)

    return (
        updates.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def keep_latest(stream: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Write the rows of an aggregated stream that a batch changed, each batch to its own
    folder; a repeated batch replaces its own folder."""
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_latest(spark: SparkSession, path: str, key: str = "cache_id") -> DataFrame:
    """The newest row of every key that ``keep_latest`` wrote."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (key, "batch")]
    newest = F.max_by(F.struct(*values), F.col("batch")).alias("newest")
    return rows.groupBy(key).agg(newest).select(key, "newest.*")
