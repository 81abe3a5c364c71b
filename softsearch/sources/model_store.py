"""Fitted models as two small Parquet tables."""

from __future__ import annotations

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from softsearch.operators.fcm import FuzzyModel

_PARAMS = "n_clusters int, m double, exponent string, iterations int, objective double, converged boolean"


def save_model(spark: SparkSession, model: FuzzyModel, path: str) -> None:
    """Centroids first, parameters last: a model without parameters does not count as saved."""
    model.centroid_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    params = (model.n_clusters, model.m, model.exponent, model.iterations, model.objective, model.converged)
    spark.createDataFrame([params], _PARAMS).coalesce(1).write.mode("overwrite").parquet(f"{path}/params")


def model_exists(spark: SparkSession, path: str) -> bool:
    try:
        return not spark.read.parquet(f"{path}/params").isEmpty()
    except AnalysisException:
        return False


def load_model(spark: SparkSession, path: str) -> FuzzyModel:
    if not model_exists(spark, path):
        raise FileNotFoundError(f"no fitted model at {path}; fit and save one first")
    p = spark.read.parquet(f"{path}/params").first()
    rows = spark.read.parquet(f"{path}/centroids").orderBy("cluster").collect()
    v = np.array([r["centroid"] for r in rows], dtype=np.float64)
    return FuzzyModel(v, p["m"], p["exponent"], p["iterations"], p["objective"], p["converged"])
