import numpy as np
import pytest
from conftest import CLUSTERS, DIM, filed_under, direction
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from softsearch.functions import membership as mem
from softsearch.functions import vectors as vx
from softsearch.operators import evaluate, fcm
from softsearch.operators.sampling import sample_fixed
from softsearch.sources.model_store import load_model, model_exists, save_model


def rows_of(spark, d2, m, exponent="squared"):
    df = spark.createDataFrame([(list(map(float, r)),) for r in d2], "d2 array<double>")
    return np.array([r[0] for r in df.select(mem.memberships("d2", m, exponent)).collect()])


def test_distances(spark):
    rows = [([1.0, 0.0], [0.0, 1.0]), ([1.0, 0.0], [1.0, 0.0])]
    got = spark.createDataFrame(rows, "x array<float>, v array<float>").select(vx.squared_distance("x", "v")).collect()
    assert got[0][0] == 2.0 and 0 < got[1][0] < 1e-5


def test_zero_vector_stays_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<float>")
    assert [list(r[0]) for r in df.select(vx.l2_normalize("v")).collect()] == [[0.0, 0.0], [0.6, 0.8]]


def test_memberships_sum_to_one_and_flatten_with_m(spark):
    d2 = np.random.default_rng(7).random((20, CLUSTERS)) + 0.1
    sharp, flat = rows_of(spark, d2, 1.5), rows_of(spark, d2, 3.0)
    assert np.allclose(sharp.sum(axis=1), 1) and (sharp >= 0).all() and (sharp <= 1).all()
    assert (flat.max(axis=1) < sharp.max(axis=1)).all()
    want = 1.0 / ((d2[:, :, None] / d2[:, None, :]) ** 4.0).sum(axis=2)
    assert np.allclose(sharp, want)
    textbook = 1.0 / ((d2[:, :, None] / d2[:, None, :]) ** 2.0).sum(axis=2)
    assert np.allclose(rows_of(spark, d2, 1.5, "bezdek"), textbook)


def test_point_on_centroid_belongs_to_it_alone(spark):
    assert rows_of(spark, [[1e-15, 1.0, 2.0]], 2.0).tolist() == [[1.0, 0.0, 0.0]]
    assert rows_of(spark, [[1.0, 1e-15, 1e-15]], 2.0).tolist() == [[0.0, 1.0, 0.0]]


def test_extreme_ratios_stay_finite(spark):
    u = rows_of(spark, [[1e-9, 2.0, 2.0]], 1.01)
    assert np.isfinite(u).all() and u[0, 0] == 1.0


def test_ties_go_to_the_lowest_cluster(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.1, 0.45, 0.45],)], "u array<double>")
    got = df.select(mem.dominant_cluster("u"), mem.nth_cluster("u", 2), mem.buckets("u")).collect()
    assert [tuple(r) for r in got] == [(0, 1, [0, 1]), (1, 2, [1, 2])]


def test_boundary_is_strict(spark):
    df = spark.createDataFrame([([0.85, 0.15],), ([0.84, 0.16],), ([1.0],)], "u array<double>")
    assert [r[0] for r in df.select(mem.is_boundary("u")).collect()] == [False, True, False]


def test_expression_and_matrix_paths_agree(spark, toy):
    model = fcm.FuzzyCMeans(3, 2.0, 5, sample=None).fit(toy)
    by_matrix = model.score(toy).select("vec_id", "membership")
    d2 = vx.squared_distances("embedding", model.centroids.tolist())
    by_columns = toy.select("vec_id", mem.memberships(d2, 2.0).alias("u"))
    both = by_matrix.join(by_columns, "vec_id").collect()
    assert len(both) == 90 and all(np.allclose(r.membership, r.u) for r in both)


def test_fit_parts_the_groups(toy):
    model = fcm.FuzzyCMeans(3, 2.0).fit(toy)
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1) and model.iterations == len(model.history)
    objectives = [h[1] for h in model.history]
    assert all(b <= a + 1e-9 for a, b in zip(objectives, objectives[1:]))
    groups = model.score(toy).groupBy("true_cluster").agg(F.collect_set(mem.dominant_cluster("membership")).alias("c")).collect()
    assert sorted(r.c[0] for r in groups) == [0, 1, 2] and all(len(r.c) == 1 for r in groups)


def test_more_rows_than_any_sample(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(5600, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = spark.createDataFrame([(i, [float(e) for e in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = evaluate.select_k(rows, [3], 1.5, 2, tol=None).first()
    model = fcm.FuzzyCMeans(3, 1.5, 2, tol=None).fit(rows)
    labelled = model.score(rows).select("embedding", mem.dominant_cluster("membership").alias("dominant_cluster"))
    assert evaluate.cluster_quality(labelled, 3) == (found.silhouette, found.davies_bouldin)
    v = np.array([list(r.embedding) for r in fcm.initial_centroids(rows, 3, "vec_id").orderBy("cluster").collect()])
    for _ in range(2):
        d2 = np.maximum(2 - 2 * x @ v.T, 1e-10)
        w = (1 / d2**4 / (1 / d2**4).sum(axis=1, keepdims=True)) ** 1.5
        v = w.T @ x
        v /= np.linalg.norm(v, axis=1)[:, None]
    assert np.allclose(model.centroids, v)


def test_vector_expressions_are_linear(spark):
    """Plans in which a norm or a sum stands once, not inside the lambda over the elements."""
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<double>")
    assert [r[0] for r in df.select(vx.l2_normalize("v")).collect()] == [[0.6, 0.8], [0.0, 0.0], None]
    assert df.select(vx.l2_normalize("v").alias("n"))._jdf.queryExecution().analyzed().toString().count("aggregate(") == 1
    u = df.select(mem.memberships("v", 2.0).alias("u"))._jdf.queryExecution().analyzed().toString()
    assert u.count("aggregate(") == 1


def test_fit_does_not_depend_on_layout(toy):
    runs = [fcm.FuzzyCMeans(3, 2.0, 10, tol=None).fit(toy.repartition(n)).centroids for n in (1, 5)]
    assert np.allclose(*runs, atol=1e-12)


def test_fit_matches_numpy(toy):
    x = np.array([r.embedding for r in toy.orderBy("vec_id").collect()], dtype=float)
    start = fcm.initial_centroids(toy, 3, "vec_id").orderBy("cluster").collect()
    v = np.array([r.embedding for r in start], dtype=float)
    for _ in range(4):
        d2 = np.maximum(2 - 2 * x @ v.T, 1e-10)
        u = 1.0 / ((d2[:, :, None] / d2[:, None, :]) ** 2.0).sum(axis=2)
        objective = (u**2 * d2).sum()
        v = (u**2).T @ x / (u**2).sum(axis=0)[:, None]
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    model = fcm.FuzzyCMeans(3, 2.0, 4, tol=None).fit(toy)
    assert np.allclose(model.centroids, v) and np.isclose(model.objective, objective)


def test_errors(toy):
    with pytest.raises(RuntimeError):
        fcm.FuzzyCMeans(3).predict(toy)
    with pytest.raises(ValueError):
        fcm.FuzzyCMeans(91).fit(toy)
    with pytest.raises(ValueError):
        fcm.FuzzyCMeans(3, m=1.0)


def test_null_vectors_score_null(spark, toy):
    model = fcm.FuzzyCMeans(3).fit(toy)
    df = spark.createDataFrame([(1, None), (2, direction(1))], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.membership for r in model.score(df).collect()}
    assert got[1] is None and np.isclose(sum(got[2]), 1)


def test_model_round_trip(spark, toy, tmp_path):
    path = str(tmp_path / "model")
    assert not model_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    model = fcm.FuzzyCMeans(3, 1.7).fit(toy)
    save_model(spark, model, path)
    again = load_model(spark, path)
    assert np.array_equal(again.centroids, model.centroids) and again.m == 1.7 and again.converged == model.converged


def test_histogram_lists_empty_clusters(spark):
    df = spark.createDataFrame([(filed_under(1),), (filed_under(1, True),), (filed_under(3),)], "membership array<double>")
    got = {r.cluster: r.n_docs for r in fcm.cluster_histogram(df, 4).collect()}
    assert got == {0: 0, 1: 2, 2: 0, 3: 1}


def test_sample_is_exact_and_stable(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    first = sorted(r[0] for r in sample_fixed(df, 500, "k").collect())
    again = sorted(r[0] for r in sample_fixed(df.repartition(13), 500, "k").collect())
    assert len(set(first)) == 500 and first == again
    whole = df.orderBy(F.md5(F.concat_ws("-", F.col("k").cast("string"), F.lit("42"))), "k").limit(500)
    assert first == sorted(r[0] for r in whole.collect())
    assert sample_fixed(df.limit(10), 500, "k").count() == 10


def brute_silhouette(x, labels):
    far = 1 - (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T
    out = []
    for i, own in enumerate(labels):
        same = (labels == own) & (np.arange(len(x)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a = far[i, same].mean()
        b = min(far[i, labels == o].mean() for o in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def brute_davies_bouldin(x, labels):
    ks = sorted(set(labels))
    c = np.array([x[labels == k].mean(axis=0) for k in ks])
    s = np.array([np.linalg.norm(x[labels == k] - c[i], axis=1).mean() for i, k in enumerate(ks)])
    return float(np.mean([max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(len(ks)) if j != i) for i in range(len(ks))]))


def test_quality_matches_brute_force_and_evaluator(spark):
    rng = np.random.default_rng(3)
    x, labels = rng.normal(size=(120, DIM)), rng.integers(0, 4, 120)
    labels[0] = 5  # a cluster of one; 4 is empty
    df = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(labels, x)], "dominant_cluster int, embedding array<double>")
    sil, db = evaluate.cluster_quality(df, 6)
    assert np.isclose(sil, brute_silhouette(x, labels)) and np.isclose(db, brute_davies_bouldin(x, labels))
    ml = df.select(array_to_vector("embedding").alias("features"), F.col("dominant_cluster").alias("prediction"))
    assert np.isclose(sil, ClusteringEvaluator(distanceMeasure="cosine").evaluate(ml))


def test_degenerate_clusterings(spark):
    df = spark.createDataFrame([(0, direction(1)), (1, direction(2))], "dominant_cluster int, embedding array<float>")
    assert evaluate.cluster_quality(df, 2) == (0.0, 999.0)
    assert evaluate.cluster_quality(df.withColumn("dominant_cluster", F.lit(0)), 1) == (0.0, 999.0)
    assert evaluate.cluster_quality(df.limit(0), 2) == (0.0, 999.0)


def test_select_k_finds_three_groups(toy):
    got = evaluate.select_k(toy, range(2, 5), max_iter=10).collect()
    assert [r.k for r in got if r.is_best] == [3]


def test_threshold_sweep(spark):
    pairs = spark.createDataFrame([(0.95, True), (0.85, True), (0.8, False), (0.1, False)], "similarity double, same_intent boolean")
    got = {r.threshold: r for r in evaluate.threshold_sweep(pairs, [0.8, 0.9, 0.99]).collect()}
    assert (got[0.8].true_hits, got[0.8].false_hits) == (2, 1) and np.isclose(got[0.8].precision, 0.666667)
    assert (got[0.9].precision, got[0.9].recall) == (1.0, 0.5) and np.isclose(got[0.9].f1, 0.666667)
    assert (got[0.99].precision, got[0.99].recall, got[0.99].f1) == (1.0, 0.0, 0.0)
