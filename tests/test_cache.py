import numpy as np
import pytest
from conftest import CLUSTERS, DIM, filed_under, direction
from pyspark.sql import functions as F

from softsearch.operators import semcache as sc
from softsearch.operators.fcm import FuzzyModel
from softsearch.plans import catalog
from softsearch.plans.answer import answer_log, answer_queries, validate
from softsearch.streaming import cache as stream
from softsearch.streaming import sinks

LOG = "cache_id string, seq long, embedding array<float>, membership array<double>"


def log_of(spark, rows):
    """Rows (seq, vector, membership), or (cache_id, seq, vector, membership)."""
    return spark.createDataFrame([r if len(r) == 4 else ("c", *r) for r in rows], LOG)


def outcome(run):
    return {(r.cache_id, r.seq): r.matched_seq if r.cache_hit else None for r in run.decisions.collect()}


def walk(rows, threshold, max_size=None, boundary=0.15):
    """The same rules one query at a time: decisions and the entries left."""
    caches, out = {}, {}
    for cache_id, seq, x, u in sorted(rows, key=lambda r: (r[0], r[1])):
        order = sorted(range(len(u)), key=lambda c: (-u[c], c))
        mine = order[:2] if u[order[1]] > boundary else order[:1]
        held = caches.setdefault(cache_id, [])
        found = []
        for e in held:
            rank = [i for i, b in enumerate(mine) if b in e["buckets"]]
            sim = round(float(np.dot(np.array(x, dtype=float), e["x"])), 9)
            if rank and sim >= threshold:
                found.append((-sim, rank[0], e["seq"], e))
        if found:
            best = min(found, key=lambda f: f[:3])[3]
            best["used"], out[cache_id, seq] = seq, best["seq"]
            continue
        out[cache_id, seq] = None
        held.append({"seq": seq, "x": np.array(x, dtype=float), "buckets": mine, "used": seq})
        if max_size is not None and len(held) > max_size:
            held.remove(min(held, key=lambda e: e["used"]))
    return out, sorted((c, e["seq"], e["used"]) for c, held in caches.items() for e in held)


def random_log(n=160, copies=0.3, caches=("a", "b"), seed=0):
    """A log in which one vector makes up a large share and one cache most of the rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for seq in range(n):
        cache = caches[0] if rng.random() < 0.8 else caches[-1]
        v = direction(0) if rng.random() < copies else direction(int(rng.integers(1, 90)))
        c = int(np.argmax(v[:CLUSTERS]))
        rows.append((cache, seq, v, filed_under(c, boundary=seq % 3 == 0)))
    return rows


# -- lookup -----------------------------------------------------------------------------


def one_lookup(spark, query, entries, threshold=0.9):
    return sc.lookup(log_of(spark, [query]), log_of(spark, entries), threshold).first()


def test_exact_match_hits_and_orthogonal_misses(spark):
    e = [1.0] + [0.0] * 7
    hit = one_lookup(spark, (9, e, filed_under(0)), [(1, e, filed_under(0))])
    assert hit.cache_hit and hit.matched_seq == 1 and abs(hit.similarity - 1) < 1e-5
    miss = one_lookup(spark, (9, [0.0, 1.0] + [0.0] * 6, filed_under(0)), [(1, e, filed_under(0))])
    assert not miss.cache_hit and miss.matched_seq is None and miss.similarity is None


def test_threshold_zero_and_best_of_two(spark):
    v = np.array([1.0, 0.2] + [0.0] * 6)
    v = (v / np.linalg.norm(v)).tolist()
    far = [0.0, 1.0] + [0.0] * 6
    assert one_lookup(spark, (9, v, filed_under(0)), [(1, far, filed_under(0))], 0.0).matched_seq == 1
    near = [1.0] + [0.0] * 7
    assert one_lookup(spark, (9, v, filed_under(0)), [(1, far, filed_under(0)), (2, near, filed_under(0))], 0.0).matched_seq == 2


def test_buckets_limit_the_search(spark):
    v = direction(4)
    assert not one_lookup(spark, (9, v, filed_under(1)), [(1, v, filed_under(0))]).cache_hit
    for cluster in (0, 1):  # filed under 0 and 1
        assert one_lookup(spark, (9, v, filed_under(cluster)), [(1, v, filed_under(0, True))]).cache_hit
    assert one_lookup(spark, (9, v, filed_under(3, True)), [(1, v, filed_under(0))]).cache_hit  # looks into 3 and 0
    assert not one_lookup(spark, (9, v, filed_under(2)), [(1, v, filed_under(0, True))]).cache_hit


def test_ties_prefer_the_first_bucket_then_the_oldest(spark):
    v = direction(4)
    entries = [(1, v, filed_under(1)), (2, v, filed_under(0)), (3, v, filed_under(0))]
    assert one_lookup(spark, (9, v, filed_under(0, True)), entries).matched_seq == 2


def test_caches_do_not_see_each_other(spark):
    v = direction(4)
    got = sc.lookup(log_of(spark, [("x", 9, v, filed_under(0))]), log_of(spark, [("y", 1, v, filed_under(0))]), 0.9)
    assert not got.first().cache_hit


def test_bucket_rows(spark):
    got = sc.bucket_rows(log_of(spark, [(1, direction(1), filed_under(2)), (2, direction(2), filed_under(3, True))])).collect()
    assert sorted((r.seq, r.bucket_rank, r.bucket) for r in got) == [(1, 0, 2), (2, 0, 3), (2, 1, 0)]


# -- replay -----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "options",
    [{}, {"tail_rows": 0}, {"tail_rows": 20}, {"tail_rows": 0, "max_bytes": 0, "tile_bytes": 8 * DIM * 16}],
    ids=["one task", "rounds", "rounds and a tail", "rounds and tiles"],
)
def test_unbounded_replay(spark, options):
    rows = random_log()
    run = sc.replay(log_of(spark, rows), 0.8, None, **options)
    decisions, entries = walk(rows, 0.8)
    assert outcome(run) == decisions
    assert sorted(tuple(r) for r in run.entries.select("cache_id", "seq", "access_time").collect()) == entries


@pytest.mark.parametrize("slice_rows", [100_000, 40])
def test_bounded_replay(spark, slice_rows):
    rows = random_log()
    decisions, entries = walk(rows, 0.8, 6)
    for run in (
        sc.replay_lru(log_of(spark, rows), 0.8, 6, slice_rows=slice_rows),
        sc.replay(log_of(spark, rows).repartition(5), 0.8, 6, slice_rows=slice_rows),
    ):
        assert outcome(run) == decisions
        assert sorted(tuple(r) for r in run.entries.select("cache_id", "seq", "access_time").collect()) == entries


def test_large_bound_equals_no_bound(spark):
    rows = random_log(60)
    log = log_of(spark, rows)
    assert outcome(sc.replay_lru(log, 0.8, 1000)) == outcome(sc.replay(log, 0.8, None)) == walk(rows, 0.8)[0]


def test_only_some_caches_overflow(spark):
    rows = random_log(120, caches=("big", "small"))
    stored = [sum(v is None for (c, _), v in walk(rows, 0.8)[0].items() if c == name) for name in ("big", "small")]
    bound = stored[1]
    assert stored[0] > bound
    assert outcome(sc.replay(log_of(spark, rows), 0.8, bound)) == walk(rows, 0.8, bound)[0]


def test_short_vectors_do_not_answer_their_own_copy(spark):
    half = [0.5 * x for x in direction(3)]
    rows = [("c", i, half, filed_under(0)) for i in range(5)]
    assert outcome(sc.replay(log_of(spark, rows), 0.9, None)) == walk(rows, 0.9)[0] == {("c", i): None for i in range(5)}


def test_oldest_entry_goes_and_touched_entry_stays(spark):
    v = np.eye(DIM).tolist()
    rows = [("c", i, v[i], filed_under(0)) for i in range(4)] + [("c", 4, v[0], filed_under(0))]
    assert outcome(sc.replay(log_of(spark, rows), 0.9, 3))["c", 4] is None
    rows = [("c", 0, v[0], filed_under(0)), ("c", 1, v[1], filed_under(0)), ("c", 2, v[0], filed_under(0)), ("c", 3, v[2], filed_under(0)),
            ("c", 4, v[3], filed_under(0)), ("c", 5, v[0], filed_under(0)), ("c", 6, v[1], filed_under(0))]
    got = outcome(sc.replay(log_of(spark, rows), 0.9, 3))
    assert got["c", 5] == 0 and got["c", 6] is None  # 1 went, not first in its bucket


def test_boundary_entry_leaves_both_buckets(spark):
    v = np.eye(DIM).tolist()
    rows = [("c", 0, v[0], filed_under(0, True)), ("c", 1, v[1], filed_under(2)), ("c", 2, v[2], filed_under(3)),
            ("c", 3, v[0], filed_under(0)), ("c", 4, v[0], filed_under(1))]
    assert outcome(sc.replay(log_of(spark, rows), 0.9, 2)) == {("c", i): None for i in range(5)}


def test_empty_log(spark):
    run = sc.replay(log_of(spark, []), 0.9, None)
    assert run.decisions.isEmpty() and run.entries.isEmpty()
    got = sc.stats(run.decisions, run.entries).first().asDict()
    assert got == {"total_entries": 0, "hit_count": 0, "miss_count": 0, "hit_rate": 0.0}


def test_stats_touch_evict_flush(spark):
    v = direction(7)
    rows = [("c", 0, v, filed_under(0, True)), ("c", 1, v, filed_under(0)), ("c", 2, v, filed_under(1))]
    run = sc.replay(log_of(spark, rows), 0.9, None)
    assert sc.stats(run.decisions, run.entries).first().asDict() == {
        "total_entries": 1, "hit_count": 2, "miss_count": 1, "hit_rate": 0.6667,
    }
    fresh = run.entries.withColumn("access_time", F.col("seq"))
    assert sc.touch(fresh, run.decisions).first().access_time == 2
    entries = spark.createDataFrame([("c", i, 10 - i) for i in range(6)] + [("d", 1, 1)], "cache_id string, seq long, access_time long")
    kept = sorted((r.cache_id, r.seq) for r in sc.evict_lru(entries, 2).collect())
    assert kept == [("c", 0), ("c", 1), ("d", 1)]
    emptied, report = sc.flush(entries)
    assert emptied.isEmpty() and report.first().asDict() == {"message": "Cache flushed successfully.", "entries_cleared": 7}


def test_flush_between_queries(spark):
    v = direction(7)
    rows = [(name, i, v, filed_under(0)) for name in ("c", "d") for i in range(5)]
    flushes = spark.createDataFrame([("c", 2), ("c", 9)], "cache_id string, seq long")
    run = sc.replay(sc.split_by_flush(log_of(spark, rows), flushes), 0.9, None)
    assert outcome(run) == {
        ("c#0", 0): None, ("c#0", 1): 0, ("c#0", 2): 0, ("c#1", 3): None, ("c#1", 4): 3,
        **{("d#0", i): 0 if i else None for i in range(5)},
    }


def test_counters_after_the_last_flush(spark):
    v = direction(7)
    log = log_of(spark, [("c", i, v, filed_under(0)) for i in range(6)] + [("d", 0, v, filed_under(0))])
    flushes = spark.createDataFrame([("c", 0), ("c", 2), ("c", 2)], "cache_id string, seq long")
    run = sc.replay(sc.split_by_flush(log, flushes), 0.9, None)
    mine = lambda rows: sc.last_stretch(rows, log, flushes).where("cache_id like 'c%'")
    assert sc.stats(mine(run.decisions), mine(run.entries)).first().asDict() == {
        "total_entries": 1, "hit_count": 2, "miss_count": 1, "hit_rate": 0.6667,
    }
    assert {r.cache_id for r in sc.last_stretch(run.decisions, log, flushes).collect()} == {"c#2", "d#0"}


def test_hot_cache_is_cut_before_the_shuffle(spark):
    entries = spark.createDataFrame([("c", 1, 1)], "cache_id string, seq long, access_time long")
    assert "WindowGroupLimit" in sc.evict_lru(entries, 2)._jdf.queryExecution().executedPlan().toString()


# -- streams ------------------------------------------------------------------------------


def test_stream_equals_replay(spark, tmp_path):
    """Batches of one file each; the state carries over."""
    model = FuzzyModel(np.eye(DIM)[:CLUSTERS], 1.5)
    rng = np.random.default_rng(5)
    rows = [("a" if rng.random() < 0.7 else "b", i, direction(int(rng.integers(0, 40)))) for i in range(120)]
    log = spark.createDataFrame(rows, "cache_id string, seq long, embedding array<float>")
    source = str(tmp_path / "log")
    for part in range(3):
        log.where(F.floor(F.col("seq") / 40) == part).coalesce(1).write.mode("append").parquet(source)
    for max_size in (5, 1000):
        out = str(tmp_path / f"decisions{max_size}")
        live = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
        sinks.append_to(stream.stream_decisions(live, model, 0.8, max_size), out).awaitTermination()
        got = {(r.cache_id, r.seq): r.matched_seq for r in spark.read.parquet(out).collect()}
        assert got == outcome(sc.replay(model.score(log), 0.8, max_size))
    stats = str(tmp_path / "stats")
    decisions = spark.readStream.schema(stream.DECISIONS).parquet(out)
    sinks.keep_latest(stream.stream_stats(decisions), stats).awaitTermination()
    want = sorted((c, sum(v is not None for (k, _), v in got.items() if k == c), sum(v is None for (k, _), v in got.items() if k == c)) for c in "ab")
    assert sorted(tuple(r) for r in sinks.read_latest(spark, stats).collect()) == want


# -- answers ------------------------------------------------------------------------------


def test_validation(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), (" ",)], "query string")
    ok, refused = validate(df)
    assert sorted(r.query for r in ok.collect()) == [" ", "a"]
    assert {r.query: r.reason for r in refused.collect()} == {"": "empty", None: "missing"}


def test_answers(spark):
    docs = [(f"d{i}", direction(i), i % 2, f"document number {i}") for i in range(20)]
    table = spark.createDataFrame(docs, "doc_id string, embedding array<float>, dominant_cluster int, document string")
    rows = [("c", 1, "first", direction(3), filed_under(1)), ("c", 2, "again", direction(3), filed_under(1, True)), ("c", 3, "lost", direction(8), filed_under(3))]
    log = spark.createDataFrame(rows, "cache_id string, seq long, query string, embedding array<float>, membership array<double>")
    got = {r.seq: r for r in answer_log(log, table, threshold=0.9).collect()}
    assert not got[1].cache_hit and got[1].matched_query is None and got[1].similarity_score is None
    assert got[1].dominant_cluster == 1 and got[1].result.startswith("[1] (sim=1.000) document number 3")
    assert got[2].cache_hit and got[2].matched_query == "first" and got[2].similarity_score == 1.0
    assert got[2].result == got[1].result and got[2].dominant_cluster == 1
    assert got[3].result.count("(sim=") == 5  # nothing is filed in cluster 3: searched everywhere
    nothing = answer_log(log, table.limit(0), threshold=0.9).where("seq = 3").first()
    assert nothing.result == "No relevant documents found."


def test_answers_from_text(spark):
    model = FuzzyModel(np.eye(64)[:4], 2.0)
    table = spark.createDataFrame([("d", direction(1, 64), 0, "text")], "doc_id string, embedding array<float>, dominant_cluster int, document string")
    asked = spark.createDataFrame([("c", 1, "space shuttle"), ("c", 2, "Space shuttle!"), ("c", 3, ""), ("c", 4, "gun law")], "cache_id string, seq long, query string")
    got = {r.seq: r.cache_hit for r in answer_queries(asked, table, model).collect()}
    assert got == {1: False, 2: True, 4: False}


@pytest.mark.parametrize("files", [1, 3])
def test_a_table_streams_as_a_folder_and_as_a_file(spark, tmp_path, files):
    rows = spark.range(30).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows.repartition(files).write.parquet(str(tmp_path / "written"))
    if files > 1:
        (tmp_path / "written").rename(tmp_path / "documents.parquet")
    else:
        next((tmp_path / "written").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    rows.limit(5).write.parquet(str(tmp_path / "other_documents.parquet"))
    out = str(tmp_path / "out")
    sinks.append_to(catalog._stream(spark, str(tmp_path), "documents"), out, str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(out).count() == 30
