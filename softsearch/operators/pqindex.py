"""An approximate index: inverted lists of product-quantised codes, re-ranked exactly.

Centres of the lists and code books are fitted on a bounded sample (``sample`` rows, chosen by
a hash of the key); every row is encoded and stored: its list and one byte per part of the
vector, for what the centre leaves over. A search visits the lists whose centres are most
similar to the query, ranks their rows by the vectors that the codes stand for, and ranks the
best ``rerank`` of them again by their own vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from softsearch.config import cut_lineage
from softsearch.functions.vectors import dot
from softsearch.operators.fcm import to_list_array, to_matrix
from softsearch.operators.pivots import BLOCK, bounded_topk, nearest_row
from softsearch.operators.ranking import top_per_group
from softsearch.operators.similarity import SIM_DECIMALS, similarity_topk

#: rows of the index that one task of a search reads at least, if all cores are busy
TASK_ROWS = 1 << 20


def kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centres of a bounded sample, by Lloyd's rounds from evenly spread rows."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        at = nearest_row(x, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


@dataclass(frozen=True)
class CodedIndex:
    """Centres ``(lists, d)`` and books ``(parts, codes, d / parts)``; rows lie at ``path``."""

    centres: np.ndarray
    books: np.ndarray
    path: str
    key: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def fit_index(
    table: DataFrame, path: str, key: str = "doc_id", vector_col: str = "embedding", *, lists: int | None = None, parts: int | None = None,
    codes: int = 256, sample: int = 20_000,
) -> CodedIndex:
    """Fit on ``sample`` rows, encode all rows and write them by list. ``lists`` is about the
    root of the number of rows (4,096 at most), ``parts`` a quarter of the dimension."""
    rows = table.select(F.col(key).alias("key"), F.col(vector_col).alias("vec")).where(F.col(vector_col).isNotNull())
    n = rows.count()
    if n == 0:
        raise ValueError("an index needs rows")
    drawn = rows.select(F.xxhash64("key").alias("h"), "key", "vec").orderBy("h", "key").limit(sample).toArrow()
    x = to_matrix(drawn.column("vec"))
    lists = lists or max(1, min(4096, int(np.sqrt(n))))
    parts = parts or max(1, x.shape[1] // 4)
    if x.shape[1] % parts:
        raise ValueError("the dimension is not divisible by the number of parts")
    centres = kmeans(x, lists)
    left = (x - centres[nearest_row(x, centres)]).reshape(len(x), parts, -1)
    fitted = [kmeans(left[:, p], codes) for p in range(parts)]
    books = np.stack(fitted)

    def encode(batches):
        for batch in batches:
            v = to_matrix(batch.column(1))
            if len(v):
                at = nearest_row(v, centres)
                rest = (v - centres[at]).reshape(len(v), parts, -1)
                code = np.stack([nearest_row(rest[:, p], books[p]) for p in range(parts)], axis=1).astype(np.uint8)
                packed = pa.array([c.tobytes() for c in code], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), packed, pa.array(at.astype(np.int32))], names=["key", "code", "list"])

    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("code", T.BinaryType()), T.StructField("list", T.IntegerType())])
    coded = rows.mapInArrow(encode, schema)
    coded.hint("rebalance", "list").write.partitionBy("list").parquet(path)  # a large list is several files
    return CodedIndex(centres, books, path, key)


def search_index(
    index: CodedIndex, queries: DataFrame, table: DataFrame, k: int = 10, *, query_id: str = "query_id", vector_col: str = "embedding",
    n_probe: int = 8, rerank: int = 100, exclude_self: bool = False, **join_options,
) -> DataFrame:
    """``(query_id, rank, key, similarity)``: the best ``k`` among the best ``rerank`` by code."""
    centres, books, key = index.centres, index.books, index.key

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def probes(vec: pa.Array) -> pa.Array:
        x = to_matrix(vec)
        if not len(x):
            return pa.array([], pa.list_(pa.string()))
        parts = [np.argsort(-(x[i : i + BLOCK] @ centres.T), axis=1, kind="stable")[:, :n_probe] for i in range(0, len(x), BLOCK)]
        names = pa.array(np.concatenate(parts).ravel()).cast(pa.string())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * parts[0].shape[1]), names)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def decoded(at: pa.Array, code: pa.Array) -> pa.Array:
        if not len(code):
            return pa.array([], pa.list_(pa.float64()))
        c = np.frombuffer(b"".join(code.to_pylist()), np.uint8).reshape(len(code), -1)
        rest = np.stack([books[p][c[:, p]] for p in range(len(books))], axis=1).reshape(len(c), -1)
        return to_list_array(centres[at.to_numpy(zero_copy_only=False)] + rest)

    asked = queries.select(F.col(query_id).alias("query"), F.col(vector_col).alias("vec")).where(F.col(vector_col).isNotNull())
    zero = F.lit(0).cast("long").alias("ord")
    left = asked.select(F.col("query").cast("string").alias("id"), "vec", zero, probes("vec").alias("keys"))
    # each task keeps ``rerank`` winners of a query, so tasks follow rows and cores, not lists
    held = index.rows(queries.sparkSession)
    tasks = max(queries.sparkSession.sparkContext.defaultParallelism, -(-held.count() // TASK_ROWS))
    held = held.coalesce(tasks)
    right = held.select(F.col("key").cast("string").alias("id"), decoded("list", "code").alias("vec"), zero, F.array(F.col("list").cast("string")).alias("keys"))
    options = {"prefer_small": "left", "unique_pairs": True, **join_options}
    pairs = similarity_topk(left, right, rerank + exclude_self, **options).select("left_id", "right_id")
    pairs = pairs.select(F.col("left_id").cast(asked.schema["query"].dataType).alias("query"), F.col("right_id").cast(table.schema[key].dataType).alias("key"))
    if exclude_self:
        pairs = pairs.where(F.col("query").cast("string") != F.col("key").cast("string"))
    exact = pairs.join(asked, "query").join(table.select(F.col(key).alias("key"), F.col(vector_col).alias("row_vec")), "key")
    scored = exact.select("query", "key", F.round(dot("vec", "row_vec"), SIM_DECIMALS).alias("similarity"))
    return top_per_group(scored, ["query"], [F.desc("similarity"), F.asc("key")], k).select(
        F.col("query").alias(query_id), "rank", F.col("key").alias(key), "similarity"
    )


def tune(
    index: CodedIndex, table: DataFrame, k: int = 10, target: float = 0.96, *, vector_col: str = "embedding", asked: int = 64, most: int = 1 << 14
) -> tuple[int, int]:
    """``(n_probe, rerank)`` that reach ``target`` recall for ``asked`` rows chosen by a hash of
    their key against all rows: the lists are chosen so that they hold the exact neighbours,
    then the rows to rank again are doubled until the measured recall is there."""
    key, zero, none = index.key, F.lit(0).cast("long").alias("ord"), F.array().cast("array<string>").alias("keys")
    rows = table.select(F.col(key).alias("key"), F.col(vector_col).alias("vec")).where(F.col(vector_col).isNotNull())
    drawn = cut_lineage(rows.orderBy(F.xxhash64("key", F.lit("tune")), "key").limit(asked))
    side = lambda df: df.select(F.col("key").cast("string").alias("id"), "vec", zero, none)
    exact = bounded_topk(side(drawn), side(rows), k + 1).where("left_id <> right_id")
    exact = cut_lineage(exact.select(F.col("left_id").alias("query_id"), F.col("right_id").alias("key")))
    lists = index.rows(table.sparkSession).select(F.col("key").cast("string").alias("key"), "list")
    wanted = exact.join(lists, "key").join(side(drawn).select(F.col("id").alias("query_id"), "vec"), "query_id").select("vec", "list").collect()
    if not wanted:
        return 1, most
    x = np.array([r.vec for r in wanted], dtype=np.float64)
    order = np.argsort(-(x @ index.centres.T), axis=1, kind="stable")
    ranks = np.sort((order == np.array([r["list"] for r in wanted])[:, None]).argmax(axis=1))
    n_probe, rerank = int(ranks[int(np.ceil((1 + target) / 2 * len(ranks))) - 1]) + 1, 8 * k
    queries = drawn.select(F.col("key").cast("string").alias("query_id"), F.col("vec").alias(vector_col))
    while rerank < most:
        found = search_index(index, queries, table, k, vector_col=vector_col, n_probe=n_probe, rerank=rerank, exclude_self=True)
        measured = recall(found.select("query_id", F.col(key).cast("string").alias("key")), exact, key="key").first()
        if (measured.recall or 0.0) >= target:
            break
        rerank *= 2
    return n_probe, rerank


def recall(found: DataFrame, exact: DataFrame, query_id: str = "query_id", key: str = "doc_id") -> DataFrame:
    """One row: queries with exact results, and the share of those results that was found."""
    both = exact.select(query_id, key).join(found.select(query_id, key, F.lit(1).alias("hit")), [query_id, key], "left")
    return both.agg(F.count_distinct(query_id).alias("n_queries"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
