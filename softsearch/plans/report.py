"""The analysis report: one table per section, and a text version."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from softsearch.config import cut_lineage
from softsearch.functions.membership import dominant_cluster
from softsearch.operators.evaluate import THRESHOLDS, boundary_examples, m_sweep, select_k, threshold_sweep
from softsearch.operators.fcm import FuzzyModel
from softsearch.operators.sampling import sample_fixed
from softsearch.operators.tfidf import cluster_top_categories, cluster_top_terms, tfidf_weights

#: the columns each section of ``analyse`` is ordered by in the text report
SECTION_ORDER = {
    "k_selection": ["k"], "fuzziness": ["m"], "cluster_terms": ["cluster", "rank"],
    "cluster_categories": ["cluster", "rank"], "boundary_examples": [], "thresholds": ["threshold"],
}


def analyse(
    docs: DataFrame,
    model: FuzzyModel,
    pairs: DataFrame,
    *,
    key: str = "doc_id",
    sample: int | None = None,
    ks: Iterable[int] = range(10, 21),
    ms: Iterable[float] = (1.2, 1.5, 2.0, 2.5),
    thresholds: Iterable[float] = THRESHOLDS,
    max_iter: int = 80,
) -> dict[str, DataFrame]:
    """The sections of the analysis of ``docs(key, text, embedding, label)``, or of a sample.

    ``pairs(similarity, same_intent)`` are labelled query pairs, see ``embed_pairs``.
    """
    docs = docs.select(key, "text", "embedding", "label")
    rows = cut_lineage(model.score(docs if sample is None else sample_fixed(docs, sample, key)))
    assigned = rows.select(
        key, "label", dominant_cluster("membership").alias("dominant_cluster"), F.array_max("membership").alias("mem_top1")
    )
    return {
        "k_selection": select_k(rows, ks, key=key, sample=None),
        "fuzziness": m_sweep(rows, ms, model.n_clusters, max_iter, key=key, sample=None),
        "cluster_terms": cluster_top_terms(tfidf_weights(rows, key), assigned, key),
        "cluster_categories": cluster_top_categories(assigned),
        "boundary_examples": boundary_examples(rows, key, "text"),
        "thresholds": threshold_sweep(pairs, thresholds),
    }


def report_rows(sections: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """The whole report as one table ``(section, key, name, value, text)``: a row for every cell
    that is not a key; ``value`` holds numbers, ``text`` the rest."""
    parts = []
    for section, table in sections.items():
        key = F.concat_ws("/", *[F.col(k).cast("string") for k in keys[section]])
        cells = []
        for f in table.schema:
            if f.name not in keys[section]:
                number = isinstance(f.dataType, T.NumericType)
                value, text = (F.col(f.name), F.lit(None)) if number else (F.lit(None), F.col(f.name))
                cells.append(F.struct(F.lit(f.name).alias("name"), value.cast("double").alias("value"), text.cast("string").alias("text")))
        parts.append(table.select(F.lit(section).alias("section"), key.alias("key"), F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


def write_report(sections: dict[str, DataFrame], path: str) -> None:
    """Each section as a JSON table below ``path``."""
    for name, table in sections.items():
        table.write.mode("overwrite").json(f"{path}/{name}")


def report_lines(sections: dict[str, DataFrame], order: dict[str, list[str]]) -> DataFrame:
    """``(section_no, section, sort_key, line)``: every row of every section as one line of
    ``name=value`` pairs; ``order`` names the non-negative numbers a section is sorted by."""
    parts = []
    for no, (name, table) in enumerate(sections.items()):
        cells = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in table.columns]
        key = F.concat(F.lit(""), *[F.format_string("%020.6f", F.col(c).cast("double")) for c in order[name]])
        parts.append(
            table.select(
                F.lit(no).alias("section_no"), F.lit(name).alias("section"),
                key.alias("sort_key"), F.concat_ws("  ", *cells).alias("line"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def write_text_report(lines: DataFrame, path: str) -> None:
    """One ordered text file; the report has a few hundred lines at most."""
    text = F.concat_ws("  ", F.col("section"), F.col("line")).alias("value")
    ordered = lines.orderBy("section_no", "sort_key", "line").select(text)
    ordered.coalesce(1).write.mode("overwrite").text(path)
