"""Top-k search over the vector table: exact with bounds, by cluster, with probing and fallback."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from softsearch.config import DEFAULTS, cut_lineage
from softsearch.functions.membership import ranked
from softsearch.functions.text import NO_RESULT, fixed3, snippet
from softsearch.operators.pivots import bounded_pairs
from softsearch.operators.similarity import best_pairs, similarity_pairs
from softsearch.sources.vector_table import metadata_filter

def search_side(df: DataFrame, id_col: str, keys: Column, order: Column | str | None = None) -> DataFrame:
    """Rows in the form ``similarity_topk`` takes."""
    order = F.lit(0) if order is None else F.col(order) if isinstance(order, str) else order
    return df.select(
        F.col(id_col).cast("string").alias("id"),
        F.col("embedding").alias("vec"),
        order.cast("long").alias("ord"),
        keys.alias("keys"),
    ).where(F.col("vec").isNotNull())


def _with_types(pairs: DataFrame, queries: DataFrame, query_id: str, table: DataFrame, key: str) -> DataFrame:
    return pairs.select(
        F.col("left_id").cast(queries.schema[query_id].dataType).alias(query_id),
        F.col("rank").cast("int").alias("rank"),
        F.col("right_id").cast(table.schema[key].dataType).alias(key),
        F.round("similarity", 4).alias("similarity"),
        F.round(1.0 - F.col("similarity"), 6).alias("distance"),
    )


def _drop_self(pairs: DataFrame, k: int) -> DataFrame:
    """Of the best k+1, the best k that are not the query itself.

    The window keeps the partitioning of the ranking before it, so nothing is shuffled.
    """
    is_self = F.col("left_id") == F.col("right_id")
    own_rank = F.max(F.when(is_self, F.col("rank"))).over(Window.partitionBy("left_id"))
    moved = F.when(F.col("own_rank") < F.col("rank"), F.col("rank") - 1).otherwise(F.col("rank"))
    others = pairs.withColumn("own_rank", own_rank).where(~is_self)
    return others.withColumn("rank", moved).where(F.col("rank") <= k)


def _search_all(
    queries: DataFrame, table: DataFrame, k: int, query_id: str, key: str, order: str | None, join_options: dict
) -> DataFrame:
    none = F.array().cast("array<string>")
    return bounded_pairs(search_side(queries, query_id, none), search_side(table, key, none, order), k, **join_options)


def _included(hits: DataFrame, table: DataFrame, key: str, include: Sequence[str]) -> DataFrame:
    """Columns of the found rows, such as document and metadata, joined after the cut to k:
    the search itself reads vectors and keys only."""
    return hits.join(table.select(key, *include), key, "left").select(*hits.columns, *include) if include else hits


def knn(
    queries: DataFrame,
    table: DataFrame,
    k: int = 10,
    *,
    where: dict[str, Any] | None = None,
    query_id: str = "query_id",
    key: str = "doc_id",
    order: str | None = None,
    exclude_self: bool = False,
    include: Sequence[str] = (),
    **join_options: Any,
) -> DataFrame:
    """The ``k`` nearest rows of every query, nearest first: ``(query_id, rank, key, similarity, distance)``.

    ``order`` names a numeric column that decides between equal similarities (else the key);
    ``include`` names columns of the table that the result carries as well.
    """
    pairs = _search_all(queries, metadata_filter(table, where), k + exclude_self, query_id, key, order, join_options)
    pairs = best_pairs(pairs, k + exclude_self, unique_pairs=True)
    pairs = _drop_self(pairs, k) if exclude_self else pairs
    return _included(_with_types(pairs, queries, query_id, table, key), table, key, include)


def knn_by_cluster(
    queries: DataFrame,
    table: DataFrame,
    k: int = DEFAULTS.n_results,
    *,
    n_probe: int = 1,
    fallback: bool = True,
    query_id: str = "query_id",
    key: str = "doc_id",
    order: str | None = None,
    exclude_self: bool = False,
    include: Sequence[str] = (),
    lists: DataFrame | None = None,
    **join_options: Any,
) -> DataFrame:
    """The ``k`` nearest rows among those filed in the query's best ``n_probe`` clusters.

    ``queries`` carries ``membership``. With ``fallback``, a query none of whose clusters
    holds a row searches everything; a cluster with few rows gives few results. ``lists`` is
    the same table laid out by cluster (``vector_table.write_lists``): the clusters that the
    queries search then prune its folders while the plan runs.
    """
    wanted = F.transform(F.slice(ranked("membership"), 1, n_probe), lambda r: r["cluster"])
    filled = [r[0] for r in table.select("dominant_cluster").distinct().collect()]  # one row per cluster
    filled = sorted(c for c in filled if c is not None)
    present = F.filter(wanted, lambda c: c.isin(filled))
    names = F.transform(present, lambda c: c.cast("string"))
    asked = cut_lineage(queries.select(query_id, "embedding", names.alias("_clusters")))  # scored once
    left = search_side(asked.where(F.size("_clusters") > 0), query_id, F.col("_clusters"))
    used = left.where(F.size("keys") > 0).select(F.explode(F.col("keys").cast("array<int>")).alias("dominant_cluster")).distinct()
    if lists is not None:
        rows = lists.join(F.broadcast(used), "dominant_cluster", "left_semi")  # one row per cluster
    else:  # reaches the scan of the keyed table: pushed down
        rows = table.where(F.col("dominant_cluster").isin(sorted(r[0] for r in used.collect())))
    pairs = similarity_pairs(
        left, search_side(rows, key, F.array(F.col("dominant_cluster").cast("string")), order), k + exclude_self,
        prefer_small="left", unique_pairs=True, **join_options,
    )
    if fallback:  # the few queries without a filled cluster search everything, apart from the others
        lost = asked.where(F.size("_clusters") == 0)
        if not lost.isEmpty():
            pairs = pairs.unionByName(_search_all(lost, table, k + exclude_self, query_id, key, order, join_options))
    pairs = best_pairs(pairs, k + exclude_self, unique_pairs=True)
    pairs = _drop_self(pairs, k) if exclude_self else pairs
    return _included(_with_types(pairs, queries, query_id, table, key), table, key, include)


def format_results(
    hits: DataFrame, documents: DataFrame, queries: DataFrame, *, query_id: str = "query_id", key: str = "doc_id"
) -> DataFrame:
    """One text per query: a numbered line with similarity and snippet for each hit."""
    line = F.format_string("[%d] (sim=%s) %s", F.col("rank"), fixed3("similarity"), snippet("document"))
    lines = hits.join(documents.select(key, "document"), key).select(query_id, "rank", line.alias("line"))
    joined = lines.groupBy(query_id).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda r: r["line"]), "\n\n"
        ).alias("result")
    )  # k short lines per query
    return queries.select(query_id).join(joined, query_id, "left").select(
        query_id, F.coalesce("result", F.lit(NO_RESULT)).alias("result")
    )
