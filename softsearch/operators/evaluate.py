"""Quality of a clustering, parameter sweeps and threshold sweep."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from softsearch.config import DEFAULTS
from softsearch.functions.membership import entropy, is_boundary, nth_cluster, nth_membership, ratio_exponent
from softsearch.functions.text import snippet
from softsearch.functions.vectors import dot
from softsearch.operators.fcm import (
    FuzzyCMeans, FuzzyModel, distance_matrix, fit_all, membership_matrix, sum_by_cluster, to_matrix,
)
from softsearch.operators.sampling import sample_fixed

#: scores of a clustering that cannot be judged
DEGENERATE = (0.0, 999.0)


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(int), to_matrix(batch.column(1))


def _unit(x: np.ndarray) -> np.ndarray:
    norms = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norms > 0, norms, 1.0)


def cluster_quality(
    labelled: DataFrame, n_clusters: int, label_col: str = "dominant_cluster", vector_col: str = "embedding"
) -> tuple[float, float]:
    """Mean cosine silhouette and Euclidean Davies-Bouldin index of hard labels 0..k-1.

    Exact on the full table in two passes: the mean cosine distance from a point to a
    cluster is one minus its product with the mean unit vector, so no pairs are formed.
    Fewer than two labels, or as many as rows, cannot be judged: ``DEGENERATE``.
    """
    rows = labelled.select(F.col(label_col).cast("int"), vector_col).where(F.col(vector_col).isNotNull())
    return _judge(rows, [n_clusters], lambda batch: (lambda label, x: ([label], x))(*_read(batch)))[0]


def model_quality(df: DataFrame, models: list[FuzzyModel], vector_col: str = "embedding") -> list[tuple[float, float]]:
    """``cluster_quality`` of the dominant clusters of several models, all in the same two passes.
    The sums of a model are a block of the one matrix that a task hands on."""
    rows = df.select(vector_col).where(F.col(vector_col).isNotNull())
    known = [(m.centroids, ratio_exponent(m.m, m.exponent)) for m in models]

    def read(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
        x = to_matrix(batch.column(0))
        return [membership_matrix(distance_matrix(x, v), power).argmax(axis=1) for v, power in known], x

    return _judge(rows, [m.n_clusters for m in models], read)


def _judge(rows: DataFrame, ks: list[int], read: Callable) -> list[tuple[float, float]]:
    """Scores of several labellings: ``read(batch)`` gives their labels and the vectors."""
    head = rows.select(F.size(rows.columns[-1])).first()
    if head is None or not ks:
        return [DEGENERATE] * len(ks)
    d, blocks = head[0], np.cumsum([0, *ks])

    def totals(batch: pa.RecordBatch) -> np.ndarray:
        labels, x = read(batch)
        row = np.hstack([_unit(x), x, np.ones((len(x), 1))])
        return np.vstack([np.eye(k)[label].T @ row for k, label in zip(ks, labels)])

    sums = sum_by_cluster(rows, (blocks[-1], 2 * d + 1), totals)
    parts = [sums[a:b] for a, b in zip(blocks, blocks[1:])]
    counts = [p[:, -1] for p in parts]
    size = [np.where(n > 0, n, 1.0)[:, None] for n in counts]
    unit_mean, mean = ([p[:, i : i + d] / n for p, n in zip(parts, size)] for i in (0, d))

    def scores(batch: pa.RecordBatch) -> np.ndarray:
        labels, x = read(batch)
        at, unit, out = np.arange(len(x)), _unit(x), []
        for k, label, n, u, centre in zip(ks, labels, counts, unit_mean, mean):
            far = 1.0 - unit @ u.T
            own = far[at, label] * n[label] / np.maximum(n[label] - 1, 1)
            far[:, n == 0] = np.inf
            far[at, label] = np.inf
            other = far.min(axis=1)
            top = np.maximum(own, other)
            s = np.where((n[label] > 1) & (top > 0), (other - own) / np.where(top > 0, top, 1.0), 0.0)
            out.append(np.eye(k)[label].T @ np.stack([s, np.linalg.norm(x - centre[label], axis=1)], axis=1))
        return np.vstack(out)

    judged = [n for n in counts if 2 <= (n > 0).sum() < n.sum()]
    found = sum_by_cluster(rows, (blocks[-1], 2), scores) if judged else np.zeros((blocks[-1], 2))
    return [_scores(n, m, found[a:b]) for n, m, a, b in zip(counts, mean, blocks, blocks[1:])]


def _scores(n: np.ndarray, mean: np.ndarray, parts: np.ndarray) -> tuple[float, float]:
    full = n > 0
    if not 2 <= full.sum() < n.sum():
        return DEGENERATE
    silhouette = parts[:, 0].sum() / n.sum()
    spread, centre = parts[full, 1] / n[full], mean[full]
    gap = np.linalg.norm(centre[:, None, :] - centre[None, :, :], axis=2)
    np.fill_diagonal(gap, np.inf)
    if not spread.any() or not gap[np.isfinite(gap)].any():
        return float(silhouette), 0.0
    gap[gap == 0] = np.inf
    worst = ((spread[:, None] + spread[None, :]) / gap).max(axis=1)
    return float(silhouette), float(worst.mean())


def quality_table(labelled: DataFrame, n_clusters: int, label_col: str = "dominant_cluster") -> DataFrame:
    scores = cluster_quality(labelled, n_clusters, label_col)
    return labelled.sparkSession.createDataFrame([scores], "silhouette double, davies_bouldin double")


def select_k(
    df: DataFrame,
    ks: Iterable[int] = range(10, 26),
    m: float = DEFAULTS.m,
    max_iter: int = 100,
    *,
    key: str = "vec_id",
    tol: float | None = DEFAULTS.tol,
    sample: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """``(k, silhouette, davies_bouldin, is_best)``: fit and judge every k on the same rows, all
    fits by one pass a round and all judgements by two passes.

    The best k has the largest silhouette, the smallest k on ties.
    """
    vectors = df.select(key, "embedding")
    if sample is not None:
        vectors = sample_fixed(vectors, sample, key, seed)
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ks = list(ks)
        models = fit_all([FuzzyCMeans(k, m, max_iter, tol, seed, None) for k in ks], vectors, key=key) if ks else []
        found = [(k, *scores) for k, scores in zip(ks, model_quality(vectors, models))]
    finally:
        vectors.unpersist()
    best = min(found, key=lambda r: (-r[1], r[0]))[0] if found else None
    rows = [(k, s, db, k == best) for k, s, db in found]
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double, davies_bouldin double, is_best boolean")


def fuzziness_metrics(scored: DataFrame, m: float | Column, boundary: float = DEFAULTS.boundary) -> DataFrame:
    """Boundary share, mean entropy and mean top membership of one scored table."""
    return scored.agg(
        (m if isinstance(m, Column) else F.lit(float(m))).alias("m"),
        F.round(100.0 * F.avg(is_boundary("membership", boundary).cast("double")), 4).alias("boundary_pct"),
        F.round(F.avg(entropy("membership")), 6).alias("mean_entropy"),
        F.round(F.avg(nth_membership("membership", 1)), 6).alias("mean_top"),
    )


def _stack(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def sweep_metrics(df: DataFrame, centroids: np.ndarray, ms: Iterable[float]) -> DataFrame:
    """The fuzziness metrics for several m under the same centroids."""
    return _stack([fuzziness_metrics(FuzzyModel(centroids, m).score(df), m) for m in ms])


def m_sweep(
    df: DataFrame,
    ms: Iterable[float] = (1.2, 1.5, 2.0, 2.5),
    n_clusters: int = DEFAULTS.n_clusters,
    max_iter: int = 80,
    *,
    key: str = "vec_id",
    tol: float | None = DEFAULTS.tol,
    sample: int | None = None,
) -> DataFrame:
    """Fit once per m, then report the fuzziness metrics of that fit."""
    models = fit_all([FuzzyCMeans(n_clusters, m, max_iter, tol, sample=sample) for m in ms], df, key=key)
    return _stack([fuzziness_metrics(model.score(df), model.m) for model in models])


def boundary_examples(scored: DataFrame, key: str, text_col: str, n: int = 5) -> DataFrame:
    """The ``n`` documents with the largest second membership, both clusters and a snippet."""
    u2 = nth_membership("membership", 2)
    top = scored.select(
        key,
        nth_cluster("membership", 1).alias("cluster1"),
        F.round(nth_membership("membership", 1), 3).alias("mem1"),
        nth_cluster("membership", 2).alias("cluster2"),
        F.round(u2, 3).alias("mem2"),
        snippet(text_col).alias("snippet"),
        u2.alias("_u2"),
    )
    return top.orderBy(F.desc("_u2"), key).limit(n).drop("_u2")


def pair_similarity(pairs: DataFrame, left: str = "left_vec", right: str = "right_vec") -> DataFrame:
    return pairs.withColumn("similarity", dot(left, right))


# The thresholds tried by default.
THRESHOLDS = (0.70, 0.75, 0.80, 0.85, 0.90, 0.92, 0.95, 0.99)


def threshold_sweep(pairs: DataFrame, thresholds: Iterable[float] = THRESHOLDS) -> DataFrame:
    """Hits among pairs of same and of different intent, per threshold.

    ``pairs(similarity, same_intent)``. Precision is 1 where nothing hits. One pass; the
    thresholds are exploded in the row and combined before the shuffle.
    """
    steps = F.array(*[F.lit(float(t)) for t in thresholds])
    tried = pairs.select("similarity", "same_intent", F.explode(steps).alias("threshold"))
    hit = F.col("similarity") >= F.col("threshold")
    counts = tried.groupBy("threshold").agg(
        F.count_if(hit & F.col("same_intent")).alias("true_hits"),
        F.count_if(hit & ~F.col("same_intent")).alias("false_hits"),
        F.count_if("same_intent").alias("n_same"),
        F.count_if(~F.col("same_intent")).alias("n_diff"),
    )
    hits = F.col("true_hits") + F.col("false_hits")
    precision = F.when(hits > 0, F.col("true_hits") / hits).otherwise(1.0)
    recall = F.when(F.col("n_same") > 0, F.col("true_hits") / F.col("n_same")).otherwise(0.0)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return counts.select(
        "threshold", "true_hits", "n_same", "false_hits", "n_diff",
        F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(f1, 6).alias("f1"),
    )
