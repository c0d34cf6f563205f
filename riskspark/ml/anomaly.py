"""Anomaly score: how much of a standardised row a linear autoencoder loses.

The encoder is a PCA fitted on legitimate rows. Its components are orthonormal, so the mean squared
reconstruction error is (|x|^2 - |code|^2) / d and needs no decoding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOTTLENECK = 16


def _assembled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="_x").transform(df)


def fit_anomaly(legit: DataFrame, columns: Sequence[str], k: int = BOTTLENECK) -> PCAModel:
    """One pass for the covariance, whose size is the number of columns squared."""
    return PCA(k=min(k, len(columns)), inputCol="_x", outputCol="_code").fit(_assembled(legit, columns).select("_x"))


def anomaly_scores(df: DataFrame, model: PCAModel, columns: Sequence[str], out: str = "ae_anomaly_score") -> DataFrame:
    """Adds the score and the code (``embedding``, an array)."""
    coded = model.transform(_assembled(df, columns)).withColumn("embedding", vector_to_array("_code"))
    norm = sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))
    kept = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x * x)
    score = F.greatest(F.lit(0.0), (norm - kept) / F.lit(float(len(columns))))
    return coded.withColumn(out, score).drop("_x", "_code")
