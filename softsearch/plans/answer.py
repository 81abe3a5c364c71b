"""Answer a table of text queries through the cache and the vector table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from softsearch.config import DEFAULTS, cut_lineage
from softsearch.functions.membership import nth_cluster
from softsearch.operators.embed import ModelFactory, embed
from softsearch.operators.fcm import FuzzyModel
from softsearch.operators.retrieve import format_results, knn_by_cluster
from softsearch.operators.semcache import replay


def reject_reason(query: Column | str) -> Column:
    """Why a request is refused, or null. White space alone is accepted."""
    c = F.col(query) if isinstance(query, str) else query
    return F.when(c.isNull(), "missing").when(F.char_length(c) < 1, "empty")


def validate(requests: DataFrame, query_col: str = "query") -> tuple[DataFrame, DataFrame]:
    """Accepted requests, and refused ones with their reason."""
    marked = requests.withColumn("reason", reject_reason(query_col))
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def answer_log(
    log: DataFrame,
    table: DataFrame,
    *,
    threshold: float = DEFAULTS.cache_threshold,
    max_size: int | None = DEFAULTS.cache_max_size,
    boundary: float = DEFAULTS.boundary,
    n_results: int = DEFAULTS.n_results,
    order: str | None = None,
) -> DataFrame:
    """Answers for an embedded and scored log ``(cache_id, seq, query, embedding, membership)``.

    Cache decisions do not depend on the results, so only the misses search, all at once;
    hits then take the text, query and cluster of the entry they matched.
    """
    log = cut_lineage(log.select("cache_id", "seq", "query", "embedding", "membership"))
    decisions = cut_lineage(replay(log, threshold, max_size, boundary).decisions)
    row_id = F.concat_ws("\x1f", "cache_id", F.col("seq").cast("string"))
    misses = (
        log.join(decisions.where(~F.col("cache_hit")).select("cache_id", "seq"), ["cache_id", "seq"], "left_semi")
        .withColumn("query_id", row_id)
    )
    hits = knn_by_cluster(misses, table, n_results, order=order)
    results = format_results(hits, table, misses)
    stored = misses.join(results, "query_id").select(
        "cache_id", F.col("seq").alias("entry_seq"), F.col("query").alias("entry_query"), "result",
        nth_cluster("membership", 1).alias("dominant_cluster"),
    )
    asked = log.select("cache_id", "seq", "query").join(decisions, ["cache_id", "seq"])
    asked = asked.withColumn("entry_seq", F.coalesce("matched_seq", "seq"))
    return asked.join(stored, ["cache_id", "entry_seq"]).select(
        "cache_id", "seq", "query", "cache_hit",
        F.when(F.col("cache_hit"), F.col("entry_query")).alias("matched_query"),
        F.round("similarity", 4).alias("similarity_score"), "result", "dominant_cluster",
    )


def answer_queries(
    requests: DataFrame,
    table: DataFrame,
    model: FuzzyModel,
    embedding_model: ModelFactory | None = None,
    **options,
) -> DataFrame:
    """``requests(cache_id, seq, query)`` to answers; refused requests are left out."""
    accepted, _ = validate(requests)
    return answer_log(model.score(embed(accepted, "query", model=embedding_model)), table, **options)
