"""Defaults, session builder and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Defaults:
    """Default parameters of the text, clustering and cache steps."""

    truncate_chars: int = 512
    min_chars: int = 50
    n_clusters: int = 15
    m: float = 2.0
    max_iter: int = 150
    tol: float = 1e-4
    boundary: float = 0.15
    n_results: int = 5
    snippet_chars: int = 200
    cache_threshold: float = float(os.environ.get("CACHE_SIMILARITY_THRESHOLD", "0.90"))
    cache_max_size: int = int(os.environ.get("CACHE_MAX_SIZE", "1000"))


DEFAULTS = Defaults()

#: Largest table, in bytes of vector data, that is shipped to every task.
BROADCAST_BYTES = 64 << 20
#: Vector bytes per side of one tile of a tiled similarity join.
TILE_BYTES = 32 << 20


def build_session(app: str = "softsearch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE, Arrow and UTC; anything in ``conf`` overrides it.

    ``spark.sql.shuffle.partitions`` is left to the caller: on a cluster start high and
    let AQE coalesce, in local mode use the number of cores.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    On a cluster a session that names none is refused. On a local master, where driver and
    executors are one process, a temporary folder is made and set instead.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = spark.sparkContext.getCheckpointDir()
    if named is None and current is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="softsearch-")
    if current is None:
        spark.sparkContext.setCheckpointDir(named)
    return named or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, max_rows: int = 500_000, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a narrow table for broadcast if a count of rows and bytes shows that it is small;
    else leave the join to Spark. Meant for keys and dimensions: a table with nested or binary
    columns, whose size a count does not tell, is never marked."""
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for f in df.schema):
        return df
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    size = sum(texts, F.lit(16 * len(df.columns)))
    rows, total = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    return F.broadcast(df) if rows <= max_rows and (total or 0) <= max_bytes else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
