"""From a raw document table to the clean, deduplicated corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from softsearch.config import DEFAULTS, broadcast_if_small
from softsearch.functions.text import clean_text, long_enough, strip_post_parts, text_hash


def select_subset(df: DataFrame, subset: str = "all", split_col: str = "split") -> DataFrame:
    """``all``, or the rows whose split column says ``train`` or ``test``."""
    if subset not in ("all", "train", "test"):
        raise ValueError(f"unknown subset {subset!r}")
    return df if subset == "all" else df.where(F.col(split_col) == subset)


def with_category(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Attach the category name by label, null where the label is null or unknown; the
    dimension is broadcast if it is small, so the documents of a very frequent category stay
    where they are."""
    return df.join(broadcast_if_small(categories.select("label", "category")), "label", "left")


def dedupe_exact(df: DataFrame, key: str = "doc_id", order: str = "src_id") -> DataFrame:
    """Keep the first row per key, whole.

    Written as an aggregate, not a window: ``min_by`` combines on the map side, so a key
    held by a third of all rows reaches its reducer as one row per map task.
    """
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*rest), F.col(order)).alias("first")
    return df.groupBy(key).agg(first).select(key, "first.*").select(*df.columns)


def load_corpus(
    raw: DataFrame,
    subset: str = "all",
    *,
    id_col: str | Column = "src_id",
    text_col: str | Column = "text",
    label_col: str | Column = "label",
    split_col: str = "split",
    max_chars: int | None = None,
    min_chars: int = DEFAULTS.min_chars,
    strip_parts: bool = False,
) -> DataFrame:
    """``corpus(doc_id, src_id, text, label)``: cleaned, long enough, first of its copies.

    ``strip_parts`` first takes header, footer and quotes of a post away. One shuffle, by the
    whole SHA-256 of the cleaned text (cut, if at all, to ``max_chars``). Copies are equally long, so the length test comes
    after the deduplication: before it, the optimizer would clean every text twice, once
    for the filter and once for the result.
    """
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    cleaned = select_subset(raw, subset, split_col).select(
        as_col(id_col).cast("long").alias("src_id"),
        clean_text(strip_post_parts(as_col(text_col)) if strip_parts else as_col(text_col), max_chars).alias("text"),
        as_col(label_col).cast("int").alias("label"),
    )
    hashed = cleaned.select(F.sha2("text", 256).alias("text_sha"), "src_id", "text", "label")
    first = dedupe_exact(hashed, "text_sha").where(long_enough("text", min_chars))
    return first.select(text_hash("text").alias("doc_id"), "src_id", "text", "label")


def load_summary(
    raw: DataFrame,
    *,
    text_col: str = "text",
    max_chars: int | None = None,
    min_chars: int = DEFAULTS.min_chars,
) -> DataFrame:
    """Counts of rows read, kept, too short and duplicate, in one pass over the raw table."""
    cleaned = raw.select(clean_text(text_col, max_chars).alias("text"))
    per_text = cleaned.groupBy(
        F.sha2("text", 256).alias("text_sha"), F.coalesce(long_enough("text", min_chars), F.lit(False)).alias("ok")
    ).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    kept = F.count_if("ok")
    short = F.coalesce(F.sum(F.when(~F.col("ok"), F.col("n"))), F.lit(0))
    return per_text.agg(
        total.alias("n_read"),
        kept.alias("n_kept"),
        short.alias("n_short"),
        (total - short - kept).alias("n_duplicate"),
        (total - kept).alias("n_dropped"),
    )


def distinct_queries(pairs: DataFrame, *cols: str) -> DataFrame:
    """The set of texts that occur in any of the given columns of a pair table."""
    stacked = pairs.select(F.explode(F.array(*cols)).alias("query"))
    return stacked.where(F.col("query").isNotNull()).distinct()
