"""From raw documents to packed training sequences, stage by stage.

Each stage works on all rows that the one before it kept and returns the columns of
``documents``; the last returns pieces of sequences. Between stages the rows are written as
Parquet below the shared folder and read again, so a stage can be repeated on its own.

Rows with a null id or text pass through like others: a null text counts as empty and is
rejected by the quality rules (no words). Repeated rows are near duplicates of one another.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from softsearch.llm.common import saved, scratch, table
from softsearch.llm.importance import resample
from softsearch.llm.minhash import near_duplicates
from softsearch.llm.packing import pack
from softsearch.llm.quality_rules import judge, language_references
from softsearch.llm.secret_scan import redacted, scan


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws go on."""
    return resample(docs, table(spark, sf_dir, "labels"), docs.columns).where("kept").select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near enough to their language go on."""
    return judge(docs, language_references(docs), docs.columns).where("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates goes on (five words, similarity 0.8)."""
    return near_duplicates(docs, docs.columns).where("kept").select(docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are replaced in the texts; copied examples stay."""
    found = scan(docs, docs.columns, owner="source")
    clean = found.withColumn("text", redacted(F.col("text"), F.col("found")))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1,024 tokens, with their token ids."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Trained models and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, held = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch(spark) as written:  # ends with what the stage and the one before it have stored
            rows = saved(stage(spark, rows, sf_dir), name)
            last = written.pop()
            written += held
            held = [last]
    return STAGES[-1][1](spark, rows, sf_dir)
