import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from conftest import direction

from softsearch.operators import retrieve, similarity, tfidf
from softsearch.operators.similarity import similarity_topk
from softsearch.sources import vector_table as vt


@pytest.fixture(scope="module")
def rows(spark):
    """200 vectors in 4 clusters, two thirds of them in cluster 0."""
    data = [(i, direction(i), 0 if i % 3 else 1 + i % 9 // 3, f"text {i}") for i in range(200)]
    return spark.createDataFrame(data, "doc_id long, embedding array<float>, dominant_cluster int, document string").cache()


def brute(rows, queries, k, allowed):
    data = rows.collect()
    x = np.array([r.embedding for r in data], dtype=float)
    out = []
    for q in queries:
        sims = np.round(x @ np.array(q.embedding, dtype=float), 9)
        ok = [i for i, r in enumerate(data) if allowed(q, r)]
        for rank, i in enumerate(sorted(ok, key=lambda i: (-sims[i], data[i].doc_id))[:k], 1):
            out.append((q.query_id, rank, data[i].doc_id))
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.doc_id) for r in df.collect())


@pytest.fixture(scope="module")
def asked(spark):
    data = [(q, direction(1000 + q), [0.5, 0.3, 0.1, 0.1, 0.0] if q % 2 else [0.1, 0.1, 0.5, 0.3, 0.0]) for q in range(15)]
    data.append((99, direction(5), [0.0, 0.1, 0.0, 0.0, 0.9]))  # nothing is filed in cluster 4
    return spark.createDataFrame(data, "query_id long, embedding array<float>, membership array<double>").cache()


FORMS = [{}, {"max_bytes": 0}, {"max_bytes": 0, "tile_bytes": 8 * 8 * 9}, {"prefer_small": "right"}]


@pytest.mark.parametrize("options", FORMS[:3])
def test_knn_in_every_form(rows, asked, options):
    got = found(retrieve.knn(asked, rows, 7, order="doc_id", **options))
    assert got == brute(rows, asked.collect(), 7, lambda q, r: True)


def test_knn_is_the_same_for_any_layout(rows, asked):
    assert found(retrieve.knn(asked, rows.repartition(11), 7, order="doc_id")) == found(retrieve.knn(asked, rows.coalesce(1), 7, order="doc_id"))


@pytest.mark.parametrize("options", FORMS[:3])
def test_cluster_search_and_fallback(rows, asked, options):
    dominant = lambda q: int(np.argmax(q.membership))
    got = found(retrieve.knn_by_cluster(asked, rows, 5, order="doc_id", **options))
    want = brute(rows, asked.collect(), 5, lambda q, r: r.dominant_cluster == dominant(q) or q.query_id == 99)
    assert got == want
    strict = found(retrieve.knn_by_cluster(asked, rows, 5, order="doc_id", fallback=False, **options))
    assert strict == [w for w in want if w[0] != 99]


def test_few_rows_in_a_cluster_do_not_fall_back(rows, asked):
    few = rows.where("dominant_cluster <> 2 OR doc_id < 20")
    got = found(retrieve.knn_by_cluster(asked.where("query_id = 2"), few, 50, order="doc_id"))
    assert 0 < len(got) == few.where("dominant_cluster = 2").count()


def test_probing_more_clusters(rows, asked):
    got = found(retrieve.knn_by_cluster(asked, rows, 5, n_probe=2, fallback=False, order="doc_id"))
    top2 = lambda q: np.argsort(-np.array(q.membership), kind="stable")[:2]
    assert got == brute(rows, asked.collect(), 5, lambda q, r: r.dominant_cluster in top2(q))


def test_where_filter(rows, asked):
    got = found(retrieve.knn(asked, rows, 3, where={"dominant_cluster": {"$eq": 1}}, order="doc_id"))
    assert got == brute(rows, asked.collect(), 3, lambda q, r: r.dominant_cluster == 1)


def test_format(spark, rows, asked):
    hits = retrieve.knn(asked, rows, 2, order="doc_id")
    text = {r.query_id: r.result for r in retrieve.format_results(hits, rows, asked).collect()}
    best = hits.where("query_id = 0 AND rank = 1").first()
    assert text[0].startswith(f"[1] (sim={best.similarity:.3f}) text {best.doc_id}\n\n[2] (sim=")
    none = retrieve.format_results(hits.limit(0), rows, asked).first()
    assert none.result == "No relevant documents found."


def test_no_pairs_join_and_ranking_is_cut_before_the_shuffle(rows, asked):
    plan = retrieve.knn_by_cluster(asked, rows, 5)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("options", [*FORMS, {"max_bytes": 0, "tile_bytes": 8 * 8 * 20}])
@pytest.mark.parametrize("k", [1, 4])
def test_rows_with_several_keys(spark, options, k):
    keys = [["a"], ["b", "a"], ["a", "b"], ["c"]]
    data = [(str(i), direction(i % 37), i, keys[i % 4]) for i in range(120)]  # copies: many exact ties
    side = spark.createDataFrame(data, "id string, vec array<float>, ord long, keys array<string>").cache()
    x = np.array([d[1] for d in data], dtype=float)
    sims, want = np.round(x @ x.T, 9), []
    for i, a in enumerate(data):
        ok = []
        for j, b in enumerate(data):
            shared = [p for p, key in enumerate(a[3]) if key in b[3]]
            if shared and b[2] < a[2] and sims[i, j] >= 0.2:
                ok.append((-sims[i, j], shared[0], b[2], b[0]))
        want += [(a[0], b[3], n) for n, b in enumerate(sorted(ok)[:k], 1)]
    got = similarity_topk(side, side, k, min_sim=0.2, earlier=True, ranked_keys=True, **options)
    assert sorted((r.left_id, r.right_id, r["rank"]) for r in got.collect()) == sorted(want)


# -- the table ------------------------------------------------------------------------


def test_upsert_is_idempotent(spark, tmp_path):
    schema = "doc_id string, document string, dominant_cluster int, version long"
    base = spark.createDataFrame([(str(i), f"old {i}", i % 3, 0) for i in range(50)], schema)
    fresh = spark.createDataFrame([("3", "newer", 2, 2), ("3", "new", 1, 1), ("70", "added", 0, 1)], schema)
    got = vt.upsert(base, fresh, order="version")
    want = sorted(got.collect())
    assert got.count() == 51 and got.where("doc_id = '3'").first().document == "newer"
    assert sorted(vt.upsert(got, fresh, order="version").collect()) == want
    path = str(tmp_path / "table")
    vt.write_table(base, path, buckets=8)
    for _ in range(2):
        vt.upsert_into(path, fresh, buckets=8, order="version")
        assert sorted(vt.read_table(spark, path).select(*base.columns).collect()) == want
    vt.upsert_into(path, fresh.limit(0), buckets=8)
    assert vt.store_count(vt.read_table(spark, path)).first().n_docs == 51


def test_stored_table_keeps_one_row_per_key(spark, tmp_path):
    schema = "doc_id string, document string, dominant_cluster int"
    path, other = str(tmp_path / "table"), str(tmp_path / "other")
    base = spark.createDataFrame([(str(i), f"old {i}", 0) for i in range(40)] + [("3", "zzz", 1)], schema)
    vt.write_table(base, path, buckets=16)
    fresh = spark.createDataFrame([("5", "a", 0), ("5", "b", 0), ("new", "c", 1)], schema)
    with pytest.raises(ValueError):
        vt.upsert_into(path, fresh, buckets=8)
    vt.upsert_into(path, fresh, batch=0)  # the stored number of buckets holds
    rows = {r.doc_id: r.document for r in vt.read_table(spark, path).collect()}
    assert vt.read_table(spark, path).count() == len(rows) == 41 and (rows["3"], rows["5"], rows["new"]) == ("zzz", "b", "c")
    vt.upsert_into(path, spark.createDataFrame([("5", "late", 0)], schema), batch=0)  # a batch that was taken in before
    assert vt.read_table(spark, path).where("doc_id = '5'").first().document == "b"
    with pytest.raises(FileNotFoundError):
        vt.upsert_into(other, fresh)


def test_failed_upsert_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    schema = "doc_id string, document string, dominant_cluster int"
    path = str(tmp_path / "table")
    vt.write_table(spark.createDataFrame([(str(i), "old", 0) for i in range(20)], schema), path, buckets=4)
    fresh = spark.createDataFrame([("1", "new", 0), ("x", "new", 0)], schema)

    def broken(*_):
        raise OSError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(vt, "_switch", broken)
        with pytest.raises(OSError):
            vt.upsert_into(path, fresh)
    assert vt.read_table(spark, path).where("document = 'old'").count() == vt.read_table(spark, path).count() == 20
    vt.upsert_into(path, fresh)
    assert vt.read_table(spark, path).where("document = 'new'").count() == 2 and vt.read_table(spark, path).count() == 21


def test_all_terms_are_weighed(spark):
    docs = spark.createDataFrame([(i % 2, " ".join(f"term{i // 2}x{j}" for j in range(3000))) for i in range(4)], "doc_id long, text string")
    docs = docs.groupBy("doc_id").agg(F.concat_ws(" ", F.collect_list("text")).alias("text"))
    assert tfidf.tfidf_weights(docs).select("term").distinct().count() == 6000


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "table")
    vt.write_table(spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "doc_id string, document string, dominant_cluster int"), path)
    df = vt.metadata_filter(vt.read_table(spark, path), {"dominant_cluster": {"$eq": 2}})
    assert [r.doc_id for r in df.collect()] == ["b"]
    assert "EqualTo(dominant_cluster,2)" in df._jdf.queryExecution().executedPlan().toString()


def test_filter_language(spark):
    df = spark.range(10).withColumnRenamed("id", "n")
    ids = lambda w: [r.n for r in vt.metadata_filter(df, w).orderBy("n").collect()]
    assert ids(None) == ids({}) == list(range(10))
    assert ids({"n": 3}) == [3] and ids({"n": {"$ne": 3}}) == [0, 1, 2, 4, 5, 6, 7, 8, 9]
    assert ids({"n": {"$gte": 2, "$lt": 4}}) == [2, 3] and ids({"n": {"$gt": 7}}) == [8, 9]
    assert ids({"n": {"$in": [1, 12]}}) == [1] and ids({"n": {"$nin": list(range(9))}}) == [9]
    assert ids({"$or": [{"n": 1}, {"$and": [{"n": {"$lte": 6}}, {"n": {"$gt": 5}}]}]}) == [1, 6]
    with pytest.raises(ValueError):
        ids({"n": {"$like": 1}})


def test_get_by_ids_reads_no_vectors(spark, rows):
    got = vt.get_by_ids(rows, spark.createDataFrame([(3,), (3,), (777,)], "doc_id long"))
    assert got.columns == ["doc_id", "dominant_cluster", "document"] and [r.doc_id for r in got.collect()] == [3]
    assert vt.is_populated(rows) and not vt.is_populated(rows.limit(0))


# -- terms ------------------------------------------------------------------------------


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame(
        [(1, "the red cat red"), (2, "red dog"), (3, "dog cat x"), (4, "of the"), (5, None)], "doc_id long, text string"
    )
    got = {(r.doc_id, r.term): r.weight for r in tfidf.tfidf_weights(docs).collect()}
    idf = np.log(6 / 3) + 1  # every kept term is in two of five documents
    assert set(got) == {(1, "red"), (1, "cat"), (2, "red"), (2, "dog"), (3, "dog"), (3, "cat")}
    assert np.isclose(got[1, "red"], 2 * idf / np.hypot(2 * idf, idf)) and np.isclose(got[3, "dog"], np.sqrt(0.5))
    two = tfidf.tfidf_weights(docs, max_features=2)  # red 3, then cat before dog
    assert {r.term for r in two.collect()} == {"red", "cat"}


def test_profiles(spark):
    weights = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.5), (2, "b", 0.5), (3, "b", 1.0)], "doc_id long, term string, weight double")
    assigned = spark.createDataFrame([(1, 0, 0.9, 7), (2, 0, 0.6, 8), (3, 1, 0.5, 7)], "doc_id long, dominant_cluster int, mem_top1 double, label int")
    got = [(r.cluster, r["rank"], r.term, r.score) for r in tfidf.cluster_top_terms(weights, assigned).orderBy("cluster", "rank").collect()]
    assert got == [(0, 1, "a", 0.6), (0, 2, "b", 0.15), (1, 1, "b", 0.5)]
    cats = [(r.cluster, r["rank"], r.label, r.n) for r in tfidf.cluster_top_categories(assigned).orderBy("cluster", "rank").collect()]
    assert cats == [(0, 1, 7, 1), (0, 2, 8, 1), (1, 1, 7, 1)]


@pytest.mark.parametrize("k", [1, 11])
def test_a_tile_is_searched_block_by_block(k):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20_000, 4))
    x[::7] = x[0]  # a third of the queries has thousands of equal neighbours
    def tile(rows):
        n, width = len(rows), rows.shape[1]
        vec = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rows.ravel()))
        return pa.table({"id": [str(i) for i in range(n)], "vec": vec, "ord": np.arange(n), "bound": pa.nulls(n, pa.float64()), "key_rank": np.zeros(n, np.int32)})
    rule = similarity.Rule(k, unique=True)
    left, right = similarity.Side.of(tile(x[:1500])), similarity.Side.of(tile(x))
    tracemalloc.start()
    found = pa.Table.from_batches(list(similarity._all_winners(left, right, rule))).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6  # one product of 1,024 x 16,384 rows, as before, takes 134 MB, and it was copied
    sims = np.round(x[:1500] @ x.T, 9)
    want = {str(i): [str(j) for j in np.lexsort((np.arange(len(x)), -row))[:k]] for i, row in enumerate(sims)}
    got = {}
    for f in found:
        got.setdefault(f["left_id"], []).append((-f["similarity"], f["ord"], f["right_id"]))
    assert {i: [r for _, _, r in sorted(rows)] for i, rows in got.items()} == want


@pytest.mark.parametrize("room", [0, 200, 2000])
def test_a_large_vocabulary_gives_the_same_weights(spark, room):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{n}" for n in rng.zipf(1.4, 60) % 300) for _ in range(40)] + ["", None, texts_of_one_term()]
    data = [(i % 39, t) for i, t in enumerate(texts)] + [(None, "w1 w2 w2")]  # keys come twice, or are null
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3).cache()
    rows = lambda df: sorted((str(r.doc_id), r.term, r.tf, r.weight) for r in df.collect())
    weights = tfidf.tfidf_weights(docs, vocabulary_bytes=room)
    assert rows(weights) == rows(tfidf.tfidf_weights(docs))
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("explode") == 0  # the pairs of all terms are not dealt out


def texts_of_one_term():
    return "w5 " * 20


def test_weights_are_not_dealt_out_by_document(spark):
    weights = spark.range(3000).selectExpr("id % 50 doc_id", "concat('t', id % 70) term", "0.5D weight")
    assigned = spark.range(50).selectExpr("id doc_id", "cast(id % 3 as int) dominant_cluster", "0.5D mem_top1")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the documents were many
    try:
        plan = tfidf.cluster_top_terms(weights, assigned)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(doc_id" not in plan and "hashpartitioning(term" not in plan
