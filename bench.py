"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs.
Every query is run once to warm up Python workers and code generation at the small scale,
then timed, its rows written to the ``noop`` sink; the median counts. The model, the stored
table and the prepared corpus that several queries share are steps of their own, timed once.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from statistics import median

from softsearch.config import build_session
from softsearch.plans import catalog
from softsearch.plans.catalog import QUERIES

HEADLINE = [
    "clean_text", "dedup_exact", "embed_documents", "fcm_fit_3iter", "fcm_predict", "silhouette_cosine",
    "knn_topk", "knn_cluster_filtered", "knn_nprobe2", "format_results", "cache_lookup", "cache_replay",
    "tfidf_weights", "cluster_top_terms", "vector_upsert", "prepare_vector_table",
    "answer_queries_log",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    def seconds(name: str, where: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    shared = {"shared_model": catalog.model, "shared_stored_table": catalog.stored_rows, "shared_prepared_corpus": catalog.prepared}
    catalog.forget_shared()
    for name, make in shared.items():
        if os.path.isdir(warm):
            make(spark, warm)
        start = time.perf_counter()
        make(spark, sf_dir)
        times[name] = round(time.perf_counter() - start, 3)
    for name in names:
        if os.path.isdir(warm):
            seconds(name, warm)
        times[name] = round(median(seconds(name, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
