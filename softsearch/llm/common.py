"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from softsearch.config import scratch_path

#: Rows, and bytes of text if there is more than one row, that a worker turns into Python objects at a time.
SLICE, SLICE_BYTES = 1000, 2 << 20

#: What ``saved`` writes while ``scratch`` is open.
_written: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Collects the folders that ``saved`` writes inside the block; those still listed when it
    ends are deleted. Take a folder off the list to keep it."""
    _written.append([])
    try:
        yield _written[-1]
    finally:
        for path in _written.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write below the shared folder and read again: cuts the lineage, fixes row numbers."""
    path = scratch_path(df.sparkSession, name)
    if _written:
        _written[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, for objects that are slow to load."""
    return sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state")).__dict__


def give_back() -> None:
    """Return memory that a task has freed to the system: workers and their allocators outlive tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of parts of a batch of at most ``SLICE`` rows and ``SLICE_BYTES``, or of
    one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        limit = (ends[at - 1] if at else 0) + SLICE_BYTES
        end = max(at + 1, min(at + SLICE, int(np.searchsorted(ends, limit, side="right"))))
        yield at, end - at
        at = end


def map_texts(
    df: DataFrame, text: str, keep: Sequence[str], make: Callable[[], Callable[..., list]], out: str, more: Sequence[str] = ()
) -> DataFrame:
    """Add columns computed from a text column, in Arrow batches.

    ``make()`` runs once per task and returns a function from a list of texts (``None`` for
    null), and one of each column ``more``, to one list or array per field of ``out`` (a DDL
    string). Of the input only the columns ``keep`` come back; one that has the name of a new
    column is replaced by it. A text that is kept crosses to Python once.
    """
    fields = T.StructType.fromDDL(out)
    keep = [c for c in keep if c not in fields.names]
    inside = keep.index(text) if text in keep else None
    apart = [*([] if inside is not None else [F.col(f"`{text}`").alias("text")]), *[F.col(f"`{c}`").alias(f"more{i}") for i, c in enumerate(more)]]
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), *apart)
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = ["row", *fields.names]

    def run(batches):
        func = make()
        for whole in batches:
            for at, n in slices(whole.column(0).field(inside) if inside is not None else whole.column(1)):
                batch = whole.slice(at, n)
                texts = batch.column(0).field(inside) if inside is not None else batch.column(1)
                others = batch.columns[1 if inside is not None else 2 :]
                columns = func(texts.to_pylist(), *(c.to_pylist() for c in others))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c, type=k) for c, k in zip(columns, kinds))], names=names
                )
        func = None
        give_back()

    schema = T.StructType([T.StructField("row", src.schema["row"].dataType), *fields.fields])
    return src.mapInArrow(run, schema).select("row.*", *fields.names)
