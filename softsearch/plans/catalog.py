"""Named queries over the test tables, one per operator.

Inputs: ``documents`` is the corpus (``source`` its category), ``embeddings`` the vectors
(joined to documents by number), user turns of ``conversations`` the queries. Every query
reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from softsearch.config import DEFAULTS, cut_lineage, scratch_path
from softsearch.functions import membership as mem
from softsearch.functions import text as tx
from softsearch.functions import vectors as vx
from softsearch.operators import evaluate, fcm, pqindex, retrieve, semcache, tfidf
from softsearch.operators.embed import embed, embed_pairs
from softsearch.operators.sampling import sample_fixed
from softsearch.plans.answer import answer_queries, reject_reason
from softsearch.plans.prepare import build_vector_table, prepare
from softsearch.plans.report import report_rows
from softsearch.sources import corpus, vector_table
from softsearch.sources.model_store import load_model, save_model
from softsearch.streaming import cache as stream_cache
from softsearch.streaming import sinks

K, M, ROUNDS, THRESHOLD, BOUNDARY = 10, 1.5, 3, 0.35, 0.15
STORED_BUCKETS = 8
CONVERGENCE_ROUNDS, CONVERGENCE_TOL = 6, 2.0
SAMPLE, EVICT_SIZE, LRU_SIZE = 200, 20, 15
STREAM_BATCHES = 3
INDEX_QUERIES = 100
ANSWER_THRESHOLD = 0.45
K_RANGE, SWEEP_ROUNDS = range(8, 12), 4
FUZZINESS = (1.2, 1.5, 2.0, 2.5)
PAIR_THRESHOLDS = (-0.2, -0.1, 0.0, 0.1, 0.2, 0.3, 0.35, 0.4)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- inputs -----------------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def label_of_source() -> Column:
    return F.regexp_extract("source", r"\d+", 0).cast("int")


def raw_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(F.col("doc_id").alias("src_id"), "text", "lang", label_of_source().alias("label"), F.col("source").alias("category"))


def categories(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(label_of_source().alias("label"), F.col("source").alias("category")).distinct()


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "embedding")


#: What several queries share, made once per session and folder. ``forget_shared`` drops it
#: where tables may have changed, and where a query is to be timed with all its inputs.
_models: dict[tuple, fcm.FuzzyModel] = {}


def model(spark: SparkSession, sf: str) -> fcm.FuzzyModel:
    """The fitted model the scoring queries share, fitted once per session and table."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _models:
        _models[key] = fcm.FuzzyCMeans(K, M, ROUNDS, tol=None, sample=None).fit(vectors(spark, sf))
    return _models[key]


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return model(spark, sf).score(table(spark, sf, "embeddings"))


def vector_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The vector table: embeddings with the cleaned text and category of their document."""
    docs = raw_documents(spark, sf).select(F.col("src_id").alias("doc_id"), tx.clean_text("text").alias("text"), "label")
    joined = vectors(spark, sf).withColumnRenamed("vec_id", "doc_id").join(docs, "doc_id")
    return build_vector_table(joined, categories(spark, sf), model(spark, sf))


_stored: dict[tuple, DataFrame] = {}


def stored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The vector table as searches find it: written once, then only read."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        path = scratch_path(spark, "stored")
        vector_table.write_table(vector_rows(spark, sf), path, buckets=STORED_BUCKETS)
        _stored[key] = vector_table.read_table(spark, path)
    return _stored[key]


def cache_log(spark: SparkSession, sf: str, cache_id: Column | None = None) -> DataFrame:
    """The vectors as a query log, of one cache or of one per label."""
    rows = scored(spark, sf)
    cache_id = F.lit("all") if cache_id is None else cache_id
    return rows.select(cache_id.cast("string").alias("cache_id"), F.col("vec_id").alias("seq"), "embedding", "membership", "label")


def _long(df: DataFrame, key: str, array: Column | str, pos: str, value: str) -> DataFrame:
    return df.select(key, F.posexplode(array).alias(pos, "_v")).select(key, pos, F.round(F.col("_v").cast("double"), 6).alias(value))


def neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of vectors with consecutive numbers."""
    e = table(spark, sf, "embeddings")
    right = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("right_vec"), F.col("label").alias("right_label"))
    return e.withColumnRenamed("embedding", "left_vec").join(right, "vec_id").withColumn("same_intent", F.col("label") == F.col("right_label"))


# -- corpus -----------------------------------------------------------------------


@query
def corpus_scan_subset(spark, sf):
    labelled = table(spark, sf, "labels").select(F.col("doc_id").alias("src_id"), F.lit("train").alias("split"))
    rows = raw_documents(spark, sf).join(labelled, "src_id", "left").withColumn("split", F.coalesce("split", F.lit("test")))
    return corpus.select_subset(rows, "train").select("src_id", "text", "label")


@query
def category_lookup(spark, sf):
    rows = raw_documents(spark, sf).drop("category")
    return corpus.with_category(rows, categories(spark, sf)).select("src_id", "label", "category")


@query
def min_length_filter(spark, sf):
    rows = raw_documents(spark, sf).select("src_id", tx.clean_text("text").alias("text"))
    return rows.where(tx.long_enough("text")).select("src_id", F.char_length("text").cast("long").alias("n_chars"))


@query
def load_summary(spark, sf):
    return corpus.load_summary(raw_documents(spark, sf))


@query
def dedup_exact(spark, sf):
    return corpus.load_corpus(raw_documents(spark, sf)).select("doc_id", "src_id", "text", "label")


@query
def corpus_from_posts(spark, sf):
    """Documents wrapped as posts, loaded without their header, footer and quotes."""
    posts = raw_documents(spark, sf).join(table(spark, sf, "documents").select(F.col("doc_id").alias("src_id"), _post().alias("post")), "src_id")
    return corpus.load_corpus(posts, text_col="post", strip_parts=True).select("doc_id", "src_id", "text", "label")


def _mail() -> Column:
    """Document text behind two header lines and a quoted line."""
    head = F.format_string("SUBJECT: %s\n> %s\nlines %d\n", "source", "lang", "n_chars")
    return F.concat(head, F.col("text"))


def _post() -> Column:
    """Document text as a post with header, quote and signature."""
    head = F.format_string("From: %s\n\nIn article %s\n> %s\n", "source", "lang", "lang")
    return F.concat(head, F.col("text"), F.lit("\n ---\nsigned "), F.col("source"))


def _text() -> Column:
    return F.col("text")


def _text_query(name: str, fn: Callable[[Column], Column], source: Callable[[], Column] = _text) -> None:
    QUERIES[name] = lambda spark, sf: table(spark, sf, "documents").select("doc_id", fn(source()).alias("text"))


_text_query("clean_headers", tx.strip_header_lines, _mail)
_text_query("clean_quotes", tx.strip_quoted_lines, _mail)
_text_query("clean_emails", tx.blank_emails)
_text_query("clean_punct", tx.blank_punctuation)
_text_query("clean_space", tx.collapse_space)
_text_query("truncate_text", tx.truncate)
_text_query("clean_text", lambda c: tx.clean_text(c, DEFAULTS.truncate_chars), _mail)
_text_query("strip_post_parts", tx.strip_post_parts, _post)


@query
def doc_hash_id(spark, sf):
    return raw_documents(spark, sf).select("src_id", tx.text_hash(tx.clean_text("text")).alias("doc_id"))


@query
def distinct_pair_queries(spark, sf):
    turns = table(spark, sf, "conversations")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("q2"))
    return corpus.distinct_queries(turns.withColumnRenamed("text", "q1").join(following, ["conv_id", "turn"]), "q1", "q2")


# -- vectors and clustering ---------------------------------------------------------


@query
def embed_documents(spark, sf):
    return _long(embed(corpus.load_corpus(raw_documents(spark, sf))), "doc_id", "embedding", "dim", "value")


@query
def l2_normalize(spark, sf):
    grown = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 2))
    return _long(table(spark, sf, "embeddings"), "vec_id", vx.l2_normalize(grown), "dim", "value")


@query
def squared_distances(spark, sf):
    return _long(model(spark, sf).distances(vectors(spark, sf)), "vec_id", "d2", "cluster", "d2")


def _first_model(spark, sf):
    start = fcm.initial_centroids(vectors(spark, sf), K, "vec_id").orderBy("cluster").toPandas()
    return fcm.FuzzyModel(np.array(start["embedding"].tolist(), dtype=float), M)


@query
def fcm_memberships(spark, sf):
    rows = _first_model(spark, sf).distances(vectors(spark, sf))
    return _long(rows.select("vec_id", mem.memberships("d2", M).alias("u")), "vec_id", "u", "cluster", "u")


@query
def fcm_centroids(spark, sf):
    v, _ = fcm.fcm_step(vectors(spark, sf), _first_model(spark, sf).centroids, M)
    return _long(fcm.FuzzyModel(v, M).centroid_table(spark), "cluster", "centroid", "dim", "value")


@query
def fcm_objective(spark, sf):
    return model(spark, sf).history_table(spark).select("iteration", F.round("objective", 6).alias("objective"))


@query
def fcm_convergence(spark, sf):
    """Rounds that a fit took until the objective changed by less than the tolerance."""
    fitted = fcm.FuzzyCMeans(K, M, CONVERGENCE_ROUNDS, tol=CONVERGENCE_TOL).fit(vectors(spark, sf))
    rows = [(fitted.iterations, fitted.converged, round(fitted.objective, 6))]
    return spark.createDataFrame(rows, "iterations int, converged boolean, objective double")


@query
def model_round_trip(spark, sf):
    """Centroids of a model that was saved and loaded again."""
    path = scratch_path(spark, "model")
    save_model(spark, model(spark, sf), path)
    return _long(load_model(spark, path).centroid_table(spark), "cluster", "centroid", "dim", "value")


@query
def pair_similarity(spark, sf):
    return evaluate.pair_similarity(neighbours(spark, sf)).select("vec_id", F.round("similarity", 6).alias("similarity"), "same_intent")


@query
def sample_fixed_rows(spark, sf):
    return sample_fixed(table(spark, sf, "embeddings"), SAMPLE, "vec_id").select("vec_id", "label")


@query
def fcm_init(spark, sf):
    return fcm.initial_centroids(vectors(spark, sf), K, "vec_id").select("cluster", "vec_id")


@query
def fcm_fit_3iter(spark, sf):
    fitted = fcm.FuzzyCMeans(K, M, ROUNDS, tol=None, sample=None).fit(vectors(spark, sf))
    return _long(fitted.centroid_table(spark), "cluster", "centroid", "dim", "value")


@query
def fcm_predict(spark, sf):
    return _long(scored(spark, sf), "vec_id", "membership", "cluster", "u")


@query
def dominant_cluster(spark, sf):
    return scored(spark, sf).select("vec_id", mem.dominant_cluster("membership").alias("dominant_cluster"))


@query
def boundary_flag(spark, sf):
    return scored(spark, sf).select("vec_id", mem.is_boundary("membership").alias("is_boundary"))


@query
def top2_clusters(spark, sf):
    top = fcm.top_clusters(scored(spark, sf), "vec_id", 2)
    return top.select("vec_id", "rank", "cluster", F.round("membership", 6).alias("membership"))


@query
def cluster_histogram(spark, sf):
    return fcm.cluster_histogram(scored(spark, sf), K + 2)  # two clusters are empty


@query
def boundary_rate(spark, sf):
    return fcm.boundary_rate(scored(spark, sf))


# -- vector table -------------------------------------------------------------------


@query
def doc_metadata(spark, sf):
    return vector_rows(spark, sf).drop("document", "embedding")


@query
def metadata_filter(spark, sf):
    where = {"$and": [{"dominant_cluster": {"$in": [1, 3, 5]}}, {"is_boundary": True}, {"mem_top1": {"$gte": 0.3}}]}
    return vector_table.metadata_filter(vector_rows(spark, sf), where).drop("document", "embedding")


@query
def get_by_ids(spark, sf):
    return vector_table.get_by_ids(vector_rows(spark, sf), table(spark, sf, "labels"))


@query
def store_count(spark, sf):
    return vector_table.store_count(vector_rows(spark, sf))


def _updates(spark, sf):
    """Changed text for every French document, in the vector table or not."""
    french = raw_documents(spark, sf).where("lang = 'fr'")
    return french.select(F.col("src_id").alias("doc_id"), F.concat(F.lit("updated "), tx.clean_text("text")).alias("document"), "label", "category")


_KEPT = ["doc_id", "document", "label", "category"]


@query
def vector_upsert(spark, sf):
    return vector_table.upsert(vector_rows(spark, sf).select(*_KEPT), _updates(spark, sf))


@query
def artefact_sample(spark, sf):
    rows = model(spark, sf).score(sample_fixed(table(spark, sf, "embeddings"), SAMPLE, "vec_id"))
    return rows.select("vec_id", "label", mem.dominant_cluster("membership").alias("dominant_cluster"))


@query
def prepare_vector_table(spark, sf):
    _prepared.pop((spark.sparkContext.applicationId, sf), None)  # this query is the flow itself
    rows, _ = prepared(spark, sf)
    return rows.drop("embedding")


_prepared: dict[tuple, tuple[DataFrame, fcm.FuzzyModel]] = {}


def forget_shared() -> None:
    for kept in (_models, _stored, _prepared):
        kept.clear()


def prepared(spark, sf):
    """The whole offline flow on ``documents``: clean, dedupe, embed, fit, score, write."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _prepared:
        raw = raw_documents(spark, sf)
        rows, fitted = prepare(raw, categories(spark, sf), fcm.FuzzyCMeans(K, M, ROUNDS, tol=None, sample=None))
        _prepared[key] = cut_lineage(rows), fitted
    return _prepared[key]


# -- retrieval ----------------------------------------------------------------------


def _as_queries(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("vec_id", "query_id")


def _hits(df: DataFrame) -> DataFrame:
    return df.select("query_id", "rank", "doc_id", "similarity", "distance")


@query
def knn_topk(spark, sf):
    docs = vectors(spark, sf).withColumnRenamed("vec_id", "doc_id")
    return _hits(retrieve.knn(_as_queries(vectors(spark, sf)), docs, 10, order="doc_id", exclude_self=True))


def _search(spark, sf, rows: DataFrame | None = None, **options) -> DataFrame:
    rows = stored_rows(spark, sf) if rows is None else rows
    return retrieve.knn_by_cluster(_as_queries(scored(spark, sf)), rows, 5, order="doc_id", exclude_self=True, **options)


@query
def knn_cluster_filtered(spark, sf):
    return _hits(_search(spark, sf, fallback=False))


@query
def knn_with_fallback(spark, sf):
    rows = stored_rows(spark, sf).where("dominant_cluster NOT IN (3, 7)")
    return _hits(_search(spark, sf, rows))


@query
def knn_nprobe2(spark, sf):
    return _hits(_search(spark, sf, n_probe=2, fallback=False))


def _index_search(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Every row whose id is divisible by ``INDEX_QUERIES`` against all rows, by the coded index and exactly."""
    rows = vectors(spark, sf).withColumnRenamed("vec_id", "doc_id")
    asked = _as_queries(vectors(spark, sf)).where(F.col("query_id") % INDEX_QUERIES == 0)
    index = pqindex.fit_index(rows, scratch_path(spark, "index"))
    n_probe, rerank = pqindex.tune(index, rows, 10)
    found = pqindex.search_index(index, asked, rows, 10, n_probe=n_probe, rerank=rerank, exclude_self=True)
    return found, retrieve.knn(asked, rows, 10, order="doc_id", exclude_self=True)


@query
def index_recall(spark, sf):
    found, exact = _index_search(spark, sf)
    measured = pqindex.recall(found, exact)
    return measured.select("n_queries", (F.col("recall") >= 0.9).alias("recall_reached"))


@query
def format_results(spark, sf):
    return retrieve.format_results(_search(spark, sf), stored_rows(spark, sf), _as_queries(scored(spark, sf)))


# -- cache --------------------------------------------------------------------------

def _decisions(df: DataFrame) -> DataFrame:
    return df.select("cache_id", "seq", "cache_hit", "matched_seq", F.round("similarity", 6).alias("similarity"))


@query
def cache_buckets(spark, sf):
    return semcache.bucket_rows(cache_log(spark, sf))


@query
def cache_lookup(spark, sf):
    log = cache_log(spark, sf)
    return _decisions(semcache.lookup(log.where("label >= 5"), log.where("label < 5"), THRESHOLD))


@query
def cache_replay(spark, sf):
    return _decisions(semcache.replay(cache_log(spark, sf), THRESHOLD, None).decisions)


def _by_label(spark, sf):
    return cache_log(spark, sf, F.col("label"))


@query
def cache_touch(spark, sf):
    run = semcache.replay(_by_label(spark, sf), THRESHOLD, None)
    fresh = run.entries.withColumn("access_time", F.col("seq"))
    return semcache.touch(fresh, run.decisions)


@query
def cache_evict_lru(spark, sf):
    return semcache.evict_lru(semcache.replay(_by_label(spark, sf), THRESHOLD, None).entries, EVICT_SIZE)


@query
def cache_replay_lru(spark, sf):
    return _decisions(semcache.replay(_by_label(spark, sf), THRESHOLD, LRU_SIZE).decisions)


@query
def cache_stats(spark, sf):
    run = semcache.replay(_by_label(spark, sf), THRESHOLD, None)
    return semcache.stats(run.decisions, run.entries)


@query
def cache_flush(spark, sf):
    return semcache.flush(semcache.replay(_by_label(spark, sf), THRESHOLD, None).entries)[1]


def _toxic_flushes(spark, sf):
    toxic = table(spark, sf, "labels").where("toxic = 1")
    return toxic.select(F.lit("all").alias("cache_id"), F.col("doc_id").alias("seq"))


@query
def cache_replay_flushed(spark, sf):
    """The cache is flushed after every document that is labelled toxic."""
    log = semcache.split_by_flush(cache_log(spark, sf), _toxic_flushes(spark, sf))
    return _decisions(semcache.replay(log, THRESHOLD, None).decisions)


@query
def cache_stats_flushed(spark, sf):
    """Entries and counters after the last flush of that log."""
    log, flushes = cache_log(spark, sf), _toxic_flushes(spark, sf)
    run = semcache.replay(semcache.split_by_flush(log, flushes), THRESHOLD, None)
    return semcache.stats(semcache.last_stretch(run.decisions, log, flushes), semcache.last_stretch(run.entries, log, flushes))


@query
def health_summary(spark, sf):
    entries = semcache.replay(_by_label(spark, sf), THRESHOLD, None).entries
    return semcache.health(vector_rows(spark, sf), entries, THRESHOLD)


@query
def query_validation(spark, sf):
    asked = F.when(F.col("role") == "user", F.col("text")).when(F.col("role") == "system", "")
    reason = reject_reason("query")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", asked.alias("query"))
    return rows.select("conv_id", "turn", reason.isNull().alias("accepted"), reason.alias("reason"))


def user_requests(spark, sf):
    turns = table(spark, sf, "conversations").where("role = 'user'")
    return turns.select(F.lit("all").alias("cache_id"), (F.col("conv_id") * 100_000 + F.col("turn")).alias("seq"), F.col("text").alias("query"))


@query
def answer_queries_log(spark, sf):
    rows, fitted = prepared(spark, sf)
    return answer_queries(user_requests(spark, sf), rows, fitted, threshold=ANSWER_THRESHOLD)


# -- evaluation ---------------------------------------------------------------------


def _labelled(spark, sf):
    return scored(spark, sf).select("embedding", mem.dominant_cluster("membership").alias("dominant_cluster"))


@query
def silhouette_cosine(spark, sf):
    return evaluate.quality_table(_labelled(spark, sf), K).select(F.round("silhouette", 6).alias("silhouette"))


@query
def davies_bouldin(spark, sf):
    return evaluate.quality_table(_labelled(spark, sf), K).select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


@query
def cluster_quality_degenerate(spark, sf):
    one = vectors(spark, sf).select("embedding", F.lit(0).alias("dominant_cluster"))
    return evaluate.quality_table(one, 1)


@query
def select_k(spark, sf):
    found = evaluate.select_k(vectors(spark, sf), K_RANGE, M, SWEEP_ROUNDS, tol=None)
    return found.select("k", F.round("silhouette", 6).alias("silhouette"), F.round("davies_bouldin", 6).alias("davies_bouldin"), "is_best")


@query
def m_sweep_metrics(spark, sf):
    return evaluate.sweep_metrics(vectors(spark, sf), model(spark, sf).centroids, FUZZINESS)


@query
def m_sweep(spark, sf):
    return evaluate.m_sweep(vectors(spark, sf), FUZZINESS, K, SWEEP_ROUNDS, tol=None)


def _profile_docs(spark, sf):
    return vector_rows(spark, sf).withColumnRenamed("document", "text")


@query
def tfidf_weights(spark, sf):
    weights = tfidf.tfidf_weights(_corpus(spark, sf))
    return weights.select("doc_id", "term", "tf", F.round("weight", 6).alias("weight"))


def _corpus(spark, sf):
    return corpus.load_corpus(raw_documents(spark, sf))


@query
def cluster_top_terms(spark, sf):
    docs = _profile_docs(spark, sf)
    full = scored(spark, sf).select(F.col("vec_id").alias("doc_id"), mem.dominant_cluster("membership").alias("dominant_cluster"), F.array_max("membership").alias("mem_top1"))
    found = tfidf.cluster_top_terms(tfidf.tfidf_weights(docs.select("doc_id", "text")), full.join(docs.select("doc_id"), "doc_id", "left_semi"))
    return found.select("cluster", "n_docs", "rank", "term", F.round("score", 6).alias("score"))


@query
def cluster_top_categories(spark, sf):
    return tfidf.cluster_top_categories(vector_rows(spark, sf))


@query
def boundary_examples(spark, sf):
    texts = raw_documents(spark, sf).select(F.col("src_id").alias("vec_id"), tx.clean_text("text").alias("text"))
    return evaluate.boundary_examples(scored(spark, sf).join(texts, "vec_id"), "vec_id", "text")


@query
def threshold_sweep(spark, sf):
    return evaluate.threshold_sweep(evaluate.pair_similarity(neighbours(spark, sf)), PAIR_THRESHOLDS)


@query
def text_pair_similarity(spark, sf):
    turns = table(spark, sf, "conversations").where("role = 'user'")
    following = turns.select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("text").alias("q2"))
    pairs = turns.withColumnRenamed("text", "q1").join(following, ["conv_id", "turn"])
    found = embed_pairs(pairs.select("conv_id", "turn", "q1", "q2"))
    return found.select("conv_id", "turn", F.round("similarity", 6).alias("similarity"))


#: sections of the report: the query whose rows they hold, and their keys
REPORT = {
    "k_selection": ("select_k", ["k"]), "fuzziness": ("m_sweep", ["m"]), "cluster_terms": ("cluster_top_terms", ["cluster", "rank"]),
    "cluster_categories": ("cluster_top_categories", ["cluster", "rank"]), "boundary_examples": ("boundary_examples", ["vec_id"]),
    "thresholds": ("threshold_sweep", ["threshold"]),
}


@query
def analysis_report(spark, sf):
    sections = {section: QUERIES[source](spark, sf) for section, (source, _) in REPORT.items()}
    return report_rows(sections, {section: keys for section, (_, keys) in REPORT.items()})


# -- streams ------------------------------------------------------------------------


def _stream(spark, sf, name):
    """A table as a file stream, be it one file or a folder of them: a pattern that only its name
    fits, as a stream refuses the plain path of a file."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/[{name[0]}]{name[1:]}.parquet")


def _streamed_decisions(spark, sf, max_size):
    log = _stream(spark, sf, "embeddings").select(F.col("label").cast("string").alias("cache_id"), F.col("vec_id").alias("seq"), "embedding")
    path = scratch_path(spark, "decisions")
    found = stream_cache.stream_decisions(log, model(spark, sf), THRESHOLD, max_size)
    sinks.append_to(found, path).awaitTermination()
    return path


@query
def stream_cache_decisions(spark, sf):
    return _decisions(spark.read.parquet(_streamed_decisions(spark, sf, LRU_SIZE)))


@query
def stream_cache_flushed(spark, sf):
    """The log of ``cache_replay_flushed`` as a stream of several batches, flushes as control rows."""
    log = table(spark, sf, "embeddings").select(F.lit("all").alias("cache_id"), F.col("vec_id").alias("seq"), "embedding", F.lit(False).alias("flush"))
    flushes = _toxic_flushes(spark, sf).select("cache_id", "seq", F.lit(None).cast("array<float>").alias("embedding"), F.lit(True).alias("flush"))
    source, path = scratch_path(spark, "log"), scratch_path(spark, "answers")
    rows = cut_lineage(log.unionByName(flushes))
    last = rows.agg(F.max("seq")).first()[0] or 0
    for part in range(STREAM_BATCHES):  # in the order of seq, as a log arrives
        inside = F.floor(F.col("seq") * STREAM_BATCHES / (last + 1)) == part
        rows.where(inside).coalesce(1).write.mode("append").parquet(source)
    live = spark.readStream.schema(stream_cache.LOG).option("maxFilesPerTrigger", 1).parquet(source)
    stream_cache.cached_stream(live, model(spark, sf), path, THRESHOLD).awaitTermination()
    return _decisions(stream_cache.stored_decisions(spark, path))


@query
def stream_cache_stats(spark, sf):
    path, out = scratch_path(spark, "decisions"), scratch_path(spark, "stats")
    semcache.replay(_by_label(spark, sf), THRESHOLD, None).decisions.write.parquet(path)
    decisions = spark.readStream.schema(stream_cache.DECISIONS).parquet(path)
    sinks.keep_latest(stream_cache.stream_stats(decisions), out).awaitTermination()
    return sinks.read_latest(spark, out)


@query
def stream_upsert(spark, sf):
    path = scratch_path(spark, "vectors")
    rows = vector_rows(spark, sf).select(*_KEPT, "dominant_cluster")
    vector_table.write_table(rows, path)
    docs = _stream(spark, sf, "documents").where("lang = 'fr'")
    updates = docs.select(
        "doc_id", F.concat(F.lit("updated "), tx.clean_text("text")).alias("document"), label_of_source().alias("label"),
        F.col("source").alias("category"), F.lit(-1).alias("dominant_cluster"),
    )
    sinks.upsert_stream(updates, path).awaitTermination()
    return vector_table.read_table(spark, path).select(*_KEPT)
