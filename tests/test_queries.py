"""Every named query against its SQL on the small tables, and whole-flow checks."""

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from softsearch.operators import fcm, retrieve
from softsearch.operators.embed import embed_pairs
from softsearch.plans import catalog, report
from softsearch.plans.oracles import oracles
from softsearch.plans.prepare import categories_of, prepare, publish
from softsearch.schemas import VECTOR_TABLE
from softsearch.sources.model_store import load_model
from softsearch.sources.vector_table import read_table, write_table
from softsearch.streaming import sinks

SQL = oracles()


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(SQL)
    assert set(SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, name):
    df = catalog.QUERIES[name](spark, small)
    got = (df.columns, [tuple(r) for r in df.collect()])
    assert compare.differences(got, compare.sql_rows(small, SQL[name])) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_prepare_and_stream_upsert(spark, small, tmp_path):
    raw = catalog.raw_documents(spark, small)
    table, model = prepare(raw, categories_of(raw), fcm.FuzzyCMeans(4, 1.5, 3, tol=None))
    assert table.columns == VECTOR_TABLE.names and model.n_clusters == 4
    path, source = str(tmp_path / "table"), str(tmp_path / "updates")
    write_table(table, path)
    moved = table.withColumn("dominant_cluster", F.col("dominant_cluster") + 1)
    for part in range(2):
        moved.where(F.crc32("doc_id") % 2 == part).coalesce(1).write.mode("append").parquet(source)
    live = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(source)
    sinks.upsert_stream(live, path).awaitTermination()
    stored = read_table(spark, path).select(*moved.columns)
    assert stored.count() == moved.count() and stored.exceptAll(moved).isEmpty()


def test_publish_writes_then_upserts(spark, small, tmp_path):
    raw = catalog.raw_documents(spark, small)
    table, model_path = str(tmp_path / "table"), str(tmp_path / "model")
    options = {"fcm": fcm.FuzzyCMeans(4, 1.5, 2, tol=None), "buckets": 4}
    model = publish(raw.where("src_id % 2 = 0"), categories_of(raw), table, model_path, **options)
    assert np.array_equal(load_model(spark, model_path).centroids, model.centroids)
    half = read_table(spark, table).count()
    publish(raw, categories_of(raw), table, model_path, **options)
    rows = read_table(spark, table)
    assert half < rows.count() == rows.select("doc_id").distinct().count()
    asked = model.score(rows).select(F.col("doc_id").alias("query_id"), "embedding", "membership")
    hits = retrieve.knn_by_cluster(asked, rows, 2, include=["document", "category"], exclude_self=True)
    assert hits.columns[-2:] == ["document", "category"] and hits.where("document is null").isEmpty()


def test_search_reads_no_texts_and_prunes_clusters(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(f"d{i}", f"text {i}", [1.0, float(i)], i % 3) for i in range(12)]
    write_table(spark.createDataFrame(rows, "doc_id string, document string, embedding array<float>, dominant_cluster int"), path, buckets=2)
    asked = spark.createDataFrame([("q", [1.0, 0.5], [0.1, 0.8, 0.1])], "query_id string, embedding array<float>, membership array<double>")
    plan = retrieve.knn_by_cluster(asked, read_table(spark, path), 2, fallback=False)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "embedding" in line]
    assert scans and all("document" not in line and "dominant_cluster" in line.split("PushedFilters")[1] for line in scans)


def test_report(spark, toy, tmp_path):
    words = F.array(F.lit("apple pear apple"), F.lit("stone rock"), F.lit("river lake"))
    docs = toy.select("vec_id", F.get(words, F.col("true_cluster")).alias("text"), "embedding", F.col("true_cluster").alias("label"))
    texts = spark.createDataFrame([("a red cat", "A red cat!", True), ("a red cat", "wide river", False)], "q1 string, q2 string, same_intent boolean")
    pairs = embed_pairs(texts)
    model = fcm.FuzzyCMeans(3, 1.5, 5, tol=None).fit(docs)
    sections = report.analyse(docs, model, pairs, key="vec_id", ks=range(2, 4), ms=(1.5, 2.0), max_iter=3)
    assert set(sections) == set(report.SECTION_ORDER)
    assert [r.true_hits for r in sections["thresholds"].where("threshold = 0.9").collect()] == [1]
    best = {r.term for r in sections["cluster_terms"].where("rank = 1").collect()}
    assert best == {"apple", "rock", "lake"}
    assert sections["boundary_examples"].count() == 5
    assert {r.n for r in sections["cluster_categories"].where("rank = 1").collect()} == {30}
    report.write_report(sections, str(tmp_path / "tables"))
    assert spark.read.json(str(tmp_path / "tables" / "k_selection")).count() == 2
    lines = report.report_lines(sections, report.SECTION_ORDER)
    report.write_text_report(lines, str(tmp_path / "text"))
    text = [r[0].split("  ")[:2] for r in spark.read.text(str(tmp_path / "text")).collect()]
    assert text[:4] == [["k_selection", "k=2"], ["k_selection", "k=3"], ["fuzziness", "m=1.5"], ["fuzziness", "m=2.0"]]
