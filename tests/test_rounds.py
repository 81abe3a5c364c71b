"""Parallel replay, bounded search, the coded index, concurrent writers and streams in batches."""

import threading

import numpy as np
import pandas as pd
import pytest
from conftest import CLUSTERS, DIM, direction, filed_under
from pyspark.sql import functions as F

from softsearch.operators import embed, evaluate, fcm, pivots, pqindex, retrieve, tfidf
from softsearch.operators import semcache as sc
from softsearch.operators.similarity import similarity_topk
from softsearch.sources import commits, vector_table
from softsearch.streaming import cache as stream

# -- replay by rounds --------------------------------------------------------------


def test_one_cache_of_100_000_distinct_queries(spark):
    """The stored queries are the one set in which no two conflict and every other query has an
    earlier stored neighbour; both are checked for all rows."""
    n, k, threshold = 100_000, 24, 0.93
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, DIM)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = np.unique(x, axis=0)[rng.permutation(n)]
    centres = rng.normal(size=(k, DIM))
    model = fcm.FuzzyModel(centres / np.linalg.norm(centres, axis=1, keepdims=True), 1.2)
    rows = spark.createDataFrame(pd.DataFrame({"seq": np.arange(n), "embedding": list(x)}), "seq long, embedding array<float>").repartition(8)
    log = model.score(rows.withColumn("cache_id", F.lit("one"))).select("cache_id", "seq", "embedding", "membership")
    run = sc.replay(log, threshold, None)
    out = run.decisions.select("seq", "cache_hit", "matched_seq").toPandas().sort_values("seq")
    hit, match = out["cache_hit"].to_numpy(), out["matched_seq"].to_numpy()
    u = fcm.membership_matrix(fcm.distance_matrix(x.astype(float), model.centroids), 2 / 0.2)
    order = np.argsort(-u, axis=1, kind="stable")
    filed = np.zeros((n, k), bool)
    filed[np.arange(n), order[:, 0]] = True
    both = u[np.arange(n), order[:, 1]] > 0.15
    filed[both, order[both, 1]] = True
    stored = np.flatnonzero(~hit)
    assert 500 < len(stored) < n // 2
    answered = np.zeros(n, bool)
    for start in range(0, n, 5000):
        rows = slice(start, start + 5000)
        near = np.round(x[rows].astype(float) @ x[stored].T.astype(float), 9) >= threshold
        near &= (filed[rows].astype(np.float32) @ filed[stored].T.astype(np.float32)) > 0
        answered[rows] = (near & (stored[None, :] < np.arange(n)[rows, None])).any(axis=1)
    assert np.array_equal(answered, hit)
    assert (match[hit].astype(int) < np.flatnonzero(hit)).all() and not hit[match[hit].astype(int)].any()


def test_rounds_follow_the_longest_chain_and_not_the_length(spark, tmp_path, monkeypatch):
    """A long log of unrelated queries is settled in one round, a chain of n neighbours in n / 2."""
    written = []
    monkeypatch.setattr(sc, "scratch_path", lambda spark, name: written.append(str(tmp_path / f"{name}{len(written)}")) or written[-1])

    def rounds(rows):
        log = spark.createDataFrame([("c", i, v, filed_under(0)) for i, v in enumerate(rows)], "cache_id string, seq long, embedding array<float>, membership array<double>")
        run = sc.replay(log, 0.9, None, tail_rows=0)
        stored = run.entries.count()
        return stored, sum(p.is_dir() and p.name.startswith("round=") for p in __import__("pathlib").Path(written[-1]).iterdir())

    apart = np.eye(40).tolist()
    assert rounds(apart) == (40, 1)
    turn = [[float(np.cos(0.4 * i)), float(np.sin(0.4 * i))] for i in range(6)]  # each is near its neighbours only
    assert rounds(turn) == (3, 3)


# -- search with bounds --------------------------------------------------------------


def side(spark, x, ids):
    return spark.createDataFrame([(str(i), [float(e) for e in v], int(i), []) for i, v in zip(ids, x)], "id string, vec array<double>, ord long, keys array<string>")


@pytest.mark.parametrize("options", [{}, {"max_bytes": 0, "tile_bytes": 8 * DIM * 40}], ids=["small side", "tiles"])
def test_bounded_search_equals_brute_force(spark, options):
    rng = np.random.default_rng(2)
    groups = rng.normal(size=(12, DIM)) * 3
    x = np.vstack([groups[rng.integers(0, 12, 400)] + 0.2 * rng.normal(size=(400, DIM)), np.tile(groups[3], (150, 1)), np.zeros((2, DIM))])
    q = np.vstack([x[:30], rng.normal(size=(20, DIM)), np.zeros((1, DIM))])
    rows = side(spark, x, range(len(x)))
    found = pivots.bounded_topk(side(spark, q, range(len(q))), rows, 7, pivots.make_cells(rows, 30), **options).collect()
    got = {(r.left_id, r["rank"]): (r.right_id, round(r.similarity, 9)) for r in found}
    sims = np.round(q @ x.T, 9)
    for i, row in enumerate(sims):
        best = sorted(range(len(x)), key=lambda j: (-row[j], j))[:7]
        assert [got[str(i), n + 1] for n in range(7)] == [(str(j), round(row[j], 9)) for j in best]
    assert len(found) == 7 * len(q)


def test_bounds_leave_out_cells_and_never_a_neighbour():
    rng = np.random.default_rng(8)
    groups = np.eye(16) * 4
    x = groups[rng.integers(0, 16, 3000)] + 0.1 * rng.normal(size=(3000, 16))
    d = pivots.distances(x, groups)
    at = d.argmin(axis=1)
    near = d[np.arange(len(x)), at]
    cells = pivots.Cells(groups, np.bincount(at, minlength=16).astype(float), np.array([near[at == c].max() for c in range(16)]), np.array([(x[at == c] ** 2).sum(axis=1).max() for c in range(16)]))
    q = x[:200]
    kth = -np.sort(-(q @ x.T), axis=1)[:, 9]
    may = cells.possible(q, kth)
    assert may.mean() < 0.3
    inside = (q @ x.T) >= kth[:, None]
    assert all(may[i, at[j]] for i, j in zip(*np.nonzero(inside)))


def test_bounded_search_of_nothing(spark):
    some, none = side(spark, np.eye(DIM), range(DIM)), side(spark, np.zeros((0, DIM)), [])
    assert pivots.bounded_topk(some, none, 3).collect() == [] and pivots.bounded_topk(none, some, 3).collect() == []


def test_queries_that_fall_back_do_not_refile_the_table(spark):
    rows = spark.createDataFrame([(i, direction(i), i % 2) for i in range(40)], "doc_id long, embedding array<float>, dominant_cluster int")
    asked = spark.createDataFrame([(100 + i, direction(200 + i), filed_under(i % CLUSTERS)) for i in range(8)], "query_id long, embedding array<float>, membership array<double>")
    got = {(r.query_id, r["rank"]): r.doc_id for r in retrieve.knn_by_cluster(asked, rows, 3, order="doc_id").collect()}
    for i in range(8):
        held = [j for j in range(40) if j % 2 == i % CLUSTERS] if i % CLUSTERS < 2 else range(40)
        sims = {j: round(float(np.dot(np.float64(np.float32(direction(200 + i))), np.float64(np.float32(direction(j))))), 9) for j in held}
        assert [got[100 + i, n] for n in (1, 2, 3)] == sorted(sims, key=lambda j: (-sims[j], j))[:3]


def test_clusters_of_the_queries_prune_the_lists(spark, tmp_path):
    rows = spark.createDataFrame([(i, direction(i), i % 4) for i in range(80)], "doc_id long, embedding array<float>, dominant_cluster int")
    vector_table.write_lists(rows, str(tmp_path / "lists"))
    lists = spark.read.parquet(str(tmp_path / "lists"))
    asked = spark.createDataFrame([(100 + i, direction(200 + i), filed_under(i % 2)) for i in range(6)], "query_id long, embedding array<float>, membership array<double>")
    found = retrieve.knn_by_cluster(asked, rows, 3, order="doc_id", lists=lists, fallback=False, max_bytes=0, tile_bytes=8 * DIM * 1000)
    shown = found._jdf.queryExecution().toString()
    assert "dynamicpruning" in shown.lower()
    plain = retrieve.knn_by_cluster(asked, rows, 3, order="doc_id", fallback=False)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_index_covers_every_row_and_is_tuned_to_its_recall(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.createDataFrame([(i, [float(e) for e in v]) for i, v in enumerate(x)], "doc_id long, embedding array<float>").repartition(4).cache()
    index = pqindex.fit_index(rows, str(tmp_path / "index"), sample=1000)
    held = index.rows(spark)
    assert held.count() == 3000 and held.select("key").distinct().count() == 3000
    n_probe, rerank = pqindex.tune(index, rows, 10, asked=32)
    asked = rows.where("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id")
    found = pqindex.search_index(index, asked, rows, 10, n_probe=n_probe, rerank=rerank, exclude_self=True)
    exact = retrieve.knn(asked, rows, 10, order="doc_id", exclude_self=True)
    assert pqindex.recall(found, exact).first().recall >= 0.9
    everything = pqindex.search_index(index, asked, rows, 10, n_probe=len(index.centres), rerank=3000, exclude_self=True)
    assert pqindex.recall(everything, exact).first().recall == 1.0
    narrow = pqindex.search_index(index, asked, rows, 10, n_probe=1, rerank=20, exclude_self=True)
    assert pqindex.recall(narrow, exact).first().recall < 0.9


# -- concurrent writers ----------------------------------------------------------------

TABLE = "doc_id long, document string"


def stored(spark, path):
    return {r.doc_id: r.document for r in vector_table.read_table(spark, path).collect()}


def test_interleaved_upserts_keep_both(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    vector_table.write_table(spark.createDataFrame([(i, "old") for i in range(120)], TABLE), path, buckets=8)
    first = spark.createDataFrame([(i, "a") for i in range(50)], TABLE)
    second = spark.createDataFrame([(i, "b") for i in range(40, 100)], TABLE)
    switch, calls = vector_table._switch, []

    def interrupted(*args):
        calls.append(args[2])
        if len(calls) == 1:  # another writer commits between the merge and the commit
            vector_table.upsert_into(path, second)
        return switch(*args)

    monkeypatch.setattr(vector_table, "_switch", interrupted)
    vector_table.upsert_into(path, first)
    assert calls == [2, 2, 3]
    want = {i: "a" if i < 50 else "b" if i < 100 else "old" for i in range(120)}
    assert stored(spark, path) == want


def test_many_writers_and_readers(spark, tmp_path):
    path = str(tmp_path / "t")
    vector_table.write_table(spark.createDataFrame([(-1, "x")], TABLE), path, buckets=2)
    failed, seen = [], []

    def write(n):
        try:
            vector_table.upsert_into(path, spark.createDataFrame([(10 * n + i, f"w{n}") for i in range(5)], TABLE))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    def read():
        for _ in range(3):
            seen.append(len(stored(spark, path)) % 5)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(5)] + [threading.Thread(target=read)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and set(seen) == {1}  # readers see whole updates only
    assert stored(spark, path) == {-1: "x"} | {10 * n + i: f"w{n}" for n in range(5) for i in range(5)}


def test_vacuum_removes_only_what_is_old_and_unused(spark, tmp_path):
    path = str(tmp_path / "t")
    vector_table.write_table(spark.createDataFrame([(i, "old") for i in range(20)], TABLE), path, buckets=2)
    for text in ("one", "two"):
        vector_table.upsert_into(path, spark.createDataFrame([(i, text) for i in range(20)], TABLE))
    before = stored(spark, path)
    assert vector_table.vacuum(spark, path) == []
    gone = vector_table.vacuum(spark, path, older_than=-1)
    assert sum(g.startswith("data/") for g in gone) == 2 and stored(spark, path) == before
    assert vector_table.vacuum(spark, path, older_than=-1) == []


def test_a_version_has_one_writer(spark, tmp_path):
    path = str(tmp_path / "v")
    assert commits.newest(spark, path, "version long") == (0, [])
    assert commits.commit(spark, path, 1, [{"version": 1}]) and not commits.commit(spark, path, 1, [{"version": 9}])
    assert [r.version for r in commits.newest(spark, path, "version long")[1]] == [1]


# -- a stream in batches ----------------------------------------------------------------


@pytest.mark.parametrize("cuts", [(0, 90), (0, 7, 8, 41, 90)], ids=["one batch", "several"])
def test_stream_equals_replay_for_any_split_and_a_repeated_batch(spark, tmp_path, cuts):
    rng = np.random.default_rng(1)
    centres = np.array([direction(300 + i) for i in range(CLUSTERS)])
    model = fcm.FuzzyModel(centres / np.linalg.norm(centres, axis=1, keepdims=True), 1.5)
    rows = [("a" if i % 3 else "b", i, direction(int(rng.integers(0, 12))), False) for i in range(90)]
    rows += [("a", 20, None, True), ("a", 20, None, True), ("b", 40, None, True), ("a", 60, None, True)]
    log = spark.createDataFrame(rows, stream.LOG)
    source, path = str(tmp_path / "log"), str(tmp_path / "answers")
    for low, high in zip(cuts, cuts[1:]):
        log.where((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.mode("append").parquet(source)
    live = spark.readStream.schema(stream.LOG).option("maxFilesPerTrigger", 1).parquet(source)
    stream.cached_stream(live, model, path, 0.8).awaitTermination()
    asked = sc.split_by_flush(model.score(log.where("NOT flush").drop("flush")), log.where("flush").select("cache_id", "seq"))
    run = sc.replay(asked, 0.8, None)
    got = {tuple(r) for r in stream.stored_decisions(spark, path).collect()}
    assert got == {tuple(r) for r in run.decisions.collect()} and len(got) == 90
    assert {tuple(r) for r in stream.stored_entries(spark, path).collect()} == {tuple(r[:2]) for r in run.entries.collect()}
    again = spark.readStream.schema(stream.LOG).option("maxFilesPerTrigger", 1).parquet(source)
    stream.cached_stream(again, model, path, 0.8).awaitTermination()  # a lost checkpoint delivers all batches again
    assert {tuple(r) for r in stream.stored_decisions(spark, path).collect()} == got
    assert stream.stored_decisions(spark, path).count() == 90


# -- vectorised steps ----------------------------------------------------------------


def test_no_text_is_shuffled_for_tfidf(spark):
    docs = spark.createDataFrame([(i, f"red cat{i % 5} dog dog the {i}") for i in range(30)] + [(99, None), (98, "")], "doc_id long, text string")
    small = tfidf.tfidf_weights(docs)
    large = tfidf.tfidf_weights(docs, vocabulary_bytes=0)
    rounded = lambda df: sorted((r.doc_id, r.term, r.tf, round(r.weight, 9)) for r in df.collect())
    assert rounded(small) == rounded(large) and small.count() > 60
    plan = tfidf.term_counts(docs, "doc_id", "text", ["the"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_default_embedding_equals_word_by_word(spark):
    import hashlib

    texts = ["red cat Red", "", None, "x", "ünïcode ünïcode 12", "a bb " * 500]
    got = embed.embed(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")).orderBy("i").collect()
    for r in got:
        v = np.zeros(64)
        for w in __import__("re").findall(r"\w{2,}", (r.text or "").lower()):
            h = hashlib.md5(w.encode()).hexdigest()
            v[int(h[:8], 16) % 64] += 1 if int(h[8], 16) < 8 else -1
        assert np.allclose(r.embedding, v / max(np.linalg.norm(v), 1e-8), atol=1e-6)


def test_all_models_are_judged_together(spark, toy, monkeypatch):
    models = fcm.fit_all([fcm.FuzzyCMeans(k, 1.5, 4, None) for k in (2, 3, 5)], toy)
    passes, summed = [], evaluate.sum_by_cluster
    monkeypatch.setattr(evaluate, "sum_by_cluster", lambda *a: passes.append(1) or summed(*a))
    together = evaluate.model_quality(toy, models)
    assert len(passes) == 2
    for model, scores in zip(models, together):
        labelled = model.score(toy).withColumn("dominant_cluster", evaluate.nth_cluster("membership", 1))
        assert np.allclose(scores, evaluate.cluster_quality(labelled, model.n_clusters))
