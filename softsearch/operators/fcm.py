"""Fuzzy c-means in cosine space: distributed fit, scoring, summaries."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from softsearch.config import BROADCAST_BYTES, DEFAULTS
from softsearch.functions.membership import dominant_cluster, is_boundary, ranked, ratio_exponent
from softsearch.functions.vectors import MIN_NORM, MIN_SQUARED_DISTANCE
from softsearch.operators.sampling import sample_fixed, sample_hash


def to_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column without nulls as an (n, d) matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def to_list_array(matrix: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Rows as lists; where ``valid`` is given, its false positions become nulls."""
    valid = np.ones(len(matrix), dtype=bool) if valid is None else valid
    offsets = np.concatenate([[0], np.cumsum(valid) * matrix.shape[1]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()), mask=pa.array(~valid))


def _per_row(x: pa.Array, width: int, rows: Callable[[np.ndarray], np.ndarray]) -> pa.Array:
    """Apply a matrix function to a vector column, null vectors giving null."""
    valid = x.is_valid().to_numpy(zero_copy_only=False)
    matrix = rows(to_matrix(x.drop_null())) if valid.any() else np.zeros((0, width))
    return to_list_array(matrix, valid)


def distance_matrix(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.maximum(2.0 - 2.0 * (x @ v.T), MIN_SQUARED_DISTANCE)


def membership_matrix(d2: np.ndarray, power: float) -> np.ndarray:
    """Soft memberships; distances come clamped from ``distance_matrix``."""
    weights = (d2.min(axis=1, keepdims=True) / d2) ** power
    return weights / weights.sum(axis=1, keepdims=True)


def sum_by_cluster(
    df: DataFrame, shape: tuple[int, int], partial: Callable[[pa.RecordBatch], np.ndarray]
) -> np.ndarray:
    """Sum ``partial(batch)``, a matrix of the given (small) shape, over the whole table.

    A task adds its batches up and hands on one matrix; Spark sums them by position. No row
    is shuffled, however unevenly the clusters are filled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(batch)
                total = part if total is None else total + part
        if total is not None:
            cluster, pos = np.indices(total.shape, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cluster.ravel()), pa.array(pos.ravel()), pa.array(total.ravel())],
                names=["cluster", "pos", "value"],
            )

    parts = df.mapInArrow(run, "cluster int, pos int, value double")
    rows = parts.groupBy("cluster", "pos").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros(shape)
    out[rows["cluster"].to_numpy(), rows["pos"].to_numpy()] = rows["value"].to_numpy()
    return out


@dataclass(frozen=True)
class FuzzyModel:
    """Unit-norm centroids and how they were found. Small: k vectors."""

    centroids: np.ndarray
    m: float = DEFAULTS.m
    exponent: str = "squared"
    iterations: int = 0
    objective: float = math.nan
    converged: bool = False
    history: tuple = field(default=())

    def __post_init__(self):
        if self.centroids.nbytes > BROADCAST_BYTES:
            raise ValueError("centroids exceed what is shipped to every task; use fewer clusters")

    @property
    def n_clusters(self) -> int:
        return len(self.centroids)

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    def score(self, df: DataFrame, vector_col: str = "embedding", out_col: str = "membership") -> DataFrame:
        """Add the membership array. Only the vector column visits Python, as Arrow batches."""
        v, power = self.centroids, ratio_exponent(self.m, self.exponent)

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def membership(x: pa.Array) -> pa.Array:
            return _per_row(x, len(v), lambda rows: membership_matrix(distance_matrix(rows, v), power))

        return df.withColumn(out_col, membership(F.col(vector_col)))

    def distances(self, df: DataFrame, vector_col: str = "embedding", out_col: str = "d2") -> DataFrame:
        v = self.centroids

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def squared(x: pa.Array) -> pa.Array:
            return _per_row(x, len(v), lambda rows: distance_matrix(rows, v))

        return df.withColumn(out_col, squared(F.col(vector_col)))

    def centroid_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, [float(e) for e in v]) for i, v in enumerate(self.centroids)]
        return spark.createDataFrame(rows, "cluster int, centroid array<double>")

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.history), "iteration int, objective double, delta double")


def fcm_step(
    df: DataFrame, v: np.ndarray, m: float, vector_col: str = "embedding", exponent: str = "squared"
) -> tuple[np.ndarray, float]:
    """One round: new centroids and the objective under the old ones. One Spark job."""
    return fcm_steps(df, [(v, m, exponent)], vector_col)[0]


def fcm_steps(
    df: DataFrame, models: list[tuple[np.ndarray, float, str]], vector_col: str = "embedding"
) -> list[tuple[np.ndarray, float]]:
    """One round for several models (centroids, m, exponent) in one pass over the vectors."""
    d = models[0][0].shape[1]

    def partial(batch: pa.RecordBatch) -> np.ndarray:
        x, parts = to_matrix(batch.column(0)), []
        for v, m, exponent in models:
            d2 = distance_matrix(x, v)
            um = membership_matrix(d2, ratio_exponent(m, exponent)) ** m
            parts.append(np.hstack([um.T @ x, um.sum(axis=0)[:, None], (um * d2).sum(axis=0)[:, None]]))
        return np.vstack(parts)

    vectors = df.select(vector_col).where(F.col(vector_col).isNotNull())
    stacked = sum_by_cluster(vectors, (sum(len(v) for v, _, _ in models), d + 2), partial)
    found, at = [], 0
    for v, _, _ in models:
        sums, at = stacked[at : at + len(v)], at + len(v)
        weight = sums[:, d]
        means = sums[:, :d] / np.where(weight > 0, weight, 1.0)[:, None]
        norms = np.sqrt((means * means).sum(axis=1, keepdims=True))
        found.append((means / np.maximum(norms, MIN_NORM), float(sums[:, d + 1].sum())))
    return found


def initial_centroids(df: DataFrame, k: int, key: str, vector_col: str = "embedding", seed: int = 42) -> DataFrame:
    """``k`` distinct rows in seeded hash order, numbered from 0."""
    ordered = sample_fixed(df.select(key, vector_col), k, key, seed)
    listed = ordered.agg(
        F.array_sort(F.collect_list(F.struct(sample_hash(key, seed).alias("h"), F.col(key), F.col(vector_col)))).alias("l")
    )  # k rows at most
    return listed.select(F.posexplode("l").alias("cluster", "row")).select("cluster", f"row.{key}", f"row.{vector_col}")


class FuzzyCMeans:
    """Soft clustering of unit vectors.

    All rows are fitted on; ``sample`` asks for a uniform sample of that many instead. ``tol=None`` runs exactly ``max_iter`` rounds.
    """

    def __init__(
        self,
        n_clusters: int = DEFAULTS.n_clusters,
        m: float = DEFAULTS.m,
        max_iter: int = DEFAULTS.max_iter,
        tol: float | None = DEFAULTS.tol,
        seed: int = 42,
        sample: int | None = None,
        exponent: str = "squared",
    ):
        ratio_exponent(m, exponent)
        if n_clusters < 1 or max_iter < 1:
            raise ValueError("n_clusters and max_iter must be positive")
        self.n_clusters, self.m, self.max_iter, self.tol = n_clusters, m, max_iter, tol
        self.seed, self.sample, self.exponent = seed, sample, exponent
        self.model: FuzzyModel | None = None

    def fit(self, df: DataFrame, vector_col: str = "embedding", key: str = "vec_id") -> FuzzyModel:
        return fit_all([self], df, vector_col, key)[0]

    def predict(self, df: DataFrame, vector_col: str = "embedding") -> DataFrame:
        if self.model is None:
            raise RuntimeError("fit the model before scoring with it")
        return self.model.score(df, vector_col)


def fit_all(
    estimators: list[FuzzyCMeans], df: DataFrame, vector_col: str = "embedding", key: str = "vec_id"
) -> list[FuzzyModel]:
    """Fit several estimators together: every round is one pass over the vectors for all that
    have not converged. They share the sample size and seed of the first."""
    vectors = df.select(key, vector_col).where(F.col(vector_col).isNotNull())
    if estimators[0].sample is not None:
        vectors = sample_fixed(vectors, estimators[0].sample, key, estimators[0].seed)
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        most = max(e.n_clusters for e in estimators)
        start = initial_centroids(vectors, most, key, vector_col, estimators[0].seed)
        rows = start.orderBy("cluster").select(vector_col).collect()  # as many rows as clusters
        if len(rows) < most:
            raise ValueError(f"{most} clusters asked for, {len(rows)} vectors given")
        centroids = [np.array([r[0] for r in rows[: e.n_clusters]], dtype=np.float64) for e in estimators]
        history: list[list[tuple[int, float, float]]] = [[] for _ in estimators]
        done = [False] * len(estimators)
        for iteration in range(1, max(e.max_iter for e in estimators) + 1):
            live = [i for i, e in enumerate(estimators) if not done[i] and iteration <= e.max_iter]
            if not live:
                break
            steps = fcm_steps(vectors, [(centroids[i], estimators[i].m, estimators[i].exponent) for i in live], vector_col)
            for i, (v, objective) in zip(live, steps):
                centroids[i] = v
                delta = abs((history[i][-1][1] if history[i] else math.inf) - objective)
                history[i].append((iteration, objective, delta))
                done[i] = estimators[i].tol is not None and delta < estimators[i].tol
    finally:
        vectors.unpersist()
    for e, v, h, converged in zip(estimators, centroids, history, done):
        e.model = FuzzyModel(v, e.m, e.exponent, len(h), h[-1][1], converged, tuple(h))
    return [e.model for e in estimators]


# -- summaries of scored tables -------------------------------------------------


def cluster_histogram(scored: DataFrame, n_clusters: int) -> DataFrame:
    """Documents per dominant cluster, empty clusters included."""
    counts = scored.groupBy(dominant_cluster("membership").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    every = scored.sparkSession.range(n_clusters).select(F.col("id").cast("int").alias("cluster"))
    return every.join(counts, "cluster", "left").select("cluster", F.coalesce("n", F.lit(0)).alias("n_docs"))


def boundary_rate(scored: DataFrame, threshold: float = DEFAULTS.boundary) -> DataFrame:
    flag = is_boundary("membership", threshold)
    return scored.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(flag).alias("n_boundary"),
        F.round(100.0 * F.avg(flag.cast("double")), 1).alias("boundary_pct"),
    )


def top_clusters(scored: DataFrame, key: str, n: int = 2) -> DataFrame:
    """Long form of the ``n`` strongest clusters per row: ``(key, rank, cluster, membership)``."""
    top = scored.select(key, F.posexplode(F.slice(ranked("membership"), 1, n)).alias("pos", "r"))
    return top.select(
        key, (F.col("pos") + 1).alias("rank"), F.col("r.cluster").alias("cluster"), (-F.col("r.neg")).alias("membership")
    )

