"""From raw documents to a scored vector table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from softsearch.config import DEFAULTS, cut_lineage
from softsearch.operators.embed import ModelFactory, embed
from softsearch.operators.fcm import FuzzyCMeans, FuzzyModel
from softsearch.schemas import VECTOR_TABLE
from softsearch.sources.corpus import load_corpus, with_category
from softsearch.sources.model_store import save_model
from softsearch.sources.vector_table import table_exists, upsert_into, with_metadata, write_table


def build_vector_table(
    embedded: DataFrame, categories: DataFrame, model: FuzzyModel, boundary: float = DEFAULTS.boundary
) -> DataFrame:
    """``embedded(doc_id, text, embedding, label)`` to rows of the vector table."""
    scored = with_metadata(model.score(embedded.withColumnRenamed("text", "document")), boundary)
    return with_category(scored, categories).select(*VECTOR_TABLE.names)


def prepare(
    raw: DataFrame,
    categories: DataFrame,
    fcm: FuzzyCMeans | None = None,
    embedding_model: ModelFactory | None = None,
    **corpus_options,
) -> tuple[DataFrame, FuzzyModel]:
    """Clean, dedupe, embed, fit and score. The embedded corpus is written once, because
    fit and scoring both read it."""
    corpus = load_corpus(raw, **corpus_options)
    embedded = cut_lineage(embed(corpus, "text", model=embedding_model))
    model = (fcm or FuzzyCMeans()).fit(embedded, key="doc_id")
    return build_vector_table(embedded, categories, model), model


def publish(
    raw: DataFrame, categories: DataFrame, table_path: str, model_path: str, fcm: FuzzyCMeans | None = None, buckets: int = 64, **options
) -> FuzzyModel:
    """``prepare``, saved: the model, and the rows written to a new table or upserted into
    the stored one. Searches then read the table (``read_table``) and score nothing again."""
    spark = raw.sparkSession
    rows, model = prepare(raw, categories, fcm, **options)
    save_model(spark, model, model_path)
    if table_exists(spark, table_path):
        upsert_into(table_path, rows)
    else:
        write_table(rows, table_path, buckets=buckets)
    return model


def categories_of(raw: DataFrame, label_col: str = "label", name_col: str = "category") -> DataFrame:
    """The category dimension that occurs in a table: ``(label, category)``."""
    return raw.groupBy(F.col(label_col).alias("label")).agg(F.min(name_col).alias("category"))
