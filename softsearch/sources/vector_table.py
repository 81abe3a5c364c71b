"""The keyed vector table: build rows, upsert, fetch, count, filter."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from softsearch.config import DEFAULTS, broadcast_if_small, cut_lineage
from softsearch.functions.membership import dominant_cluster, is_boundary, nth_membership
from softsearch.sources.commits import commit, data_folder, newest, remove_unreferenced, versions


def with_metadata(scored: DataFrame, boundary: float = DEFAULTS.boundary) -> DataFrame:
    """Add dominant cluster, boundary flag and the two largest memberships (4 decimals)."""
    return scored.withColumns(
        {
            "dominant_cluster": dominant_cluster("membership"),
            "is_boundary": is_boundary("membership", boundary),
            "mem_top1": F.round(nth_membership("membership", 1), 4),
            "mem_top2": F.round(nth_membership("membership", 2), 4),
        }
    )


# -- filters ------------------------------------------------------------------

_COMPARE = {
    "$eq": lambda c, v: c == v,
    "$ne": lambda c, v: c != v,
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
    "$in": lambda c, v: c.isin(list(v)),
    "$nin": lambda c, v: ~c.isin(list(v)),
}


def where_to_column(where: dict[str, Any] | None) -> Column:
    """A nested filter dictionary as a predicate, so that it reaches the Parquet scan.

    ``{"field": value}`` and ``{"field": {"$eq": value}}`` are the same; ``$and`` and
    ``$or`` take a list of filters; ``None`` or an empty dictionary keeps every row.
    """
    if not where:
        return F.lit(True)
    parts = []
    for field, wanted in where.items():
        if field in ("$and", "$or"):
            inner = [where_to_column(w) for w in wanted]
            parts.append(reduce(Column.__and__ if field == "$and" else Column.__or__, inner))
            continue
        tests = wanted if isinstance(wanted, dict) else {"$eq": wanted}
        for op, value in tests.items():
            if op not in _COMPARE:
                raise ValueError(f"unknown filter operator {op!r}")
            parts.append(_COMPARE[op](F.col(field), value))
    return reduce(Column.__and__, parts)


def metadata_filter(table: DataFrame, where: dict[str, Any] | None) -> DataFrame:
    return table.where(where_to_column(where))


# -- reads --------------------------------------------------------------------


def get_by_ids(table: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents and metadata of the given ids; the vectors are not read."""
    return table.drop("embedding").join(ids.select(key), key, "left_semi")


def store_count(table: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return table.agg(n.alias("n_docs"), (n > 0).alias("is_populated"))


def is_populated(table: DataFrame) -> bool:
    return not table.isEmpty()


# -- writes -------------------------------------------------------------------


def last_per_key(rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row per key: the one with the highest ``order``, the greatest row on ties."""
    rest = [c for c in rows.columns if c != key]
    rank = F.struct(*([F.col(order)] if order else []), *rest)
    last = F.max_by(F.struct(*rest), rank).alias("last")
    return rows.groupBy(key).agg(last).select(key, "last.*")


def upsert(target: DataFrame, updates: DataFrame, key: str = "doc_id", order: str | None = None) -> DataFrame:
    """``target`` with the updated rows replaced and the new ones added.

    Should a key occur more than once among the updates, the row with the highest ``order``
    wins, without an order the greatest row. Applying the same updates again changes nothing.
    """
    updates = last_per_key(updates, key, order).select(*target.columns)
    changed = broadcast_if_small(updates.select(key))  # then the table is not shuffled
    return target.join(changed, key, "left_anti").unionByName(updates)


#: partition columns of the stored files, not part of the rows
ID_BUCKET, ID_VERSION = "id_bucket", "id_version"
_POINTER = "version int, id_bucket int, folder string, buckets int, batch long"
#: times that an upsert merges anew because other writers came first
ATTEMPTS = 30


class Conflict(RuntimeError):
    """Other writers have changed the same buckets at every attempt."""


def _with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(ID_BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _write_data(df: DataFrame, path: str) -> str:
    """Write rows beside what is stored, in a folder of their own: one partition per bucket,
    split or merged to the advisory size while the job runs, sorted by cluster where there is one."""
    folder = data_folder(f"{ID_VERSION}=x")
    order = [ID_BUCKET, *(["dominant_cluster"] if "dominant_cluster" in df.columns else [])]
    rows = df.hint("rebalance", ID_BUCKET).sortWithinPartitions(*order)
    rows.write.partitionBy(ID_BUCKET).parquet(f"{path}/{folder}")
    return folder


def _pointers(spark: SparkSession, path: str) -> tuple[int, list[Row]]:
    """The newest version: for each bucket that holds rows the folder it lies in."""
    return newest(spark, path, _POINTER)


def _switch(spark: SparkSession, path: str, version: int, folders: dict[int, str], buckets: int, batch: int | None) -> bool:
    """Written last, as one new file: a reader sees the old version or the new one. False if
    another writer has made this version."""
    rows = [(b, folder) for b, folder in folders.items()] or [(None, None)]
    names = ("version", "id_bucket", "folder", "buckets", "batch")
    return commit(spark, path, version, [dict(zip(names, (version, b, folder, buckets, batch))) for b, folder in rows])


def write_table(df: DataFrame, path: str, key: str = "doc_id", buckets: int = 64) -> None:
    """Write the table partitioned by a hash of its key, as a new version.

    The partition depends on the key alone, so a document that moves to another cluster
    stays in its partition. Inside the files rows are sorted by cluster, so the row-group
    statistics let a cluster filter skip data. A bucket is what an upsert rewrites at
    least: choose ``buckets`` so that one is a few gigabytes. Their number is stored with
    the table and holds for all later upserts.
    """
    spark = df.sparkSession
    folder = _write_data(_with_bucket(last_per_key(df, key), key, buckets), path)
    written = spark.read.schema(f"{ID_BUCKET} int").parquet(f"{path}/{folder}")
    held = {r[0]: folder for r in written.select(ID_BUCKET).distinct().collect()}
    while not _switch(spark, path, _pointers(spark, path)[0] + 1, held, buckets, None):
        pass


def write_lists(df: DataFrame, path: str, columns: tuple[str, ...] = ("doc_id", "embedding")) -> None:
    """The vectors laid out for search beside the keyed table: a folder per cluster, of as many
    files as its size asks for. Rewrite it after upserts that move documents."""
    df.select("dominant_cluster", *columns).hint("rebalance", "dominant_cluster").write.mode("overwrite").partitionBy("dominant_cluster").parquet(path)


def _stored(spark: SparkSession, path: str, pointers: list[Row]) -> DataFrame:
    held = [r for r in pointers if r.folder is not None]
    if not held:
        raise FileNotFoundError(f"no rows are stored at {path}")
    folders = sorted(f"{path}/{r.folder}/{ID_BUCKET}={r.id_bucket}" for r in held)
    rows = spark.read.option("basePath", f"{path}/data").parquet(*folders)
    return rows.drop(ID_VERSION)


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path, _pointers(spark, path)[1]).drop(ID_BUCKET)


def vacuum(spark: SparkSession, path: str, older_than: float = 7 * 86400, keep: int = 1) -> list[str]:
    """Remove what the ``keep`` newest versions do not refer to and is ``older_than`` seconds old."""
    return remove_unreferenced(spark, path, _POINTER, older_than, keep)


def upsert_into(
    path: str, updates: DataFrame, key: str = "doc_id", buckets: int | None = None, order: str | None = None,
    batch: int | None = None,
) -> None:
    """Upsert into a stored table, rewriting only the partitions the updates fall into.

    The merged partitions are written beside the stored ones and become valid with the version
    file, which is written last. Whatever fails before that leaves the table as it was, and the
    update can be repeated; a ``batch`` number that the table has already taken in is left out.
    If another writer has committed in between, only the buckets that it has changed as well
    are merged again, on top of its rows; what was merged for the others stands. ``buckets``
    other than the stored number is an error.
    """
    spark, fresh, merged_on, mine = updates.sparkSession, None, {}, {}
    for _ in range(ATTEMPTS):
        version, pointers = _pointers(spark, path)
        if not pointers:
            raise FileNotFoundError(f"no table at {path}; write one first")
        stored_buckets, done = pointers[0].buckets, pointers[0].batch
        if buckets not in (None, stored_buckets):
            raise ValueError(f"the table has {stored_buckets} buckets, not {buckets}")
        if batch is not None and done is not None and batch <= done:
            return
        if fresh is None or fresh[0] != stored_buckets:
            rows = cut_lineage(_with_bucket(last_per_key(updates, key, order), key, stored_buckets))
            fresh, merged_on, mine = (stored_buckets, rows), {}, {}
            touched = [r[0] for r in rows.select(ID_BUCKET).distinct().collect()]  # at most ``buckets``
        folders = {r.id_bucket: r.folder for r in pointers if r.folder is not None}
        again = [b for b in touched if b not in mine or merged_on[b] != folders.get(b)]
        if again:
            old = [r for r in pointers if r.id_bucket in again]
            part = fresh[1].where(F.col(ID_BUCKET).isin(again))
            mine |= dict.fromkeys(again, _write_data(upsert(_stored(spark, path, old), part, key) if old else part, path))
            merged_on |= {b: folders.get(b) for b in again}
        elif not touched and batch is None:
            return
        if _switch(spark, path, version + 1, folders | mine, stored_buckets, batch if batch is not None else done):
            return
    raise Conflict(f"{ATTEMPTS} versions of {path} were made by others while these rows were merged")
