"""Probability calibration. Every calibrator has ``transform(df, score, out)``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLIP = 1e-7


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def clipped(p: Column) -> Column:
    return F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), p))


def logit(p: Column) -> Column:
    q = clipped(p)
    return F.ln(q / (F.lit(1.0) - q))


@dataclass(frozen=True)
class Platt:
    slope: float
    intercept: float

    def apply(self, score: Column) -> Column:
        return sigmoid(F.lit(self.slope) * score + F.lit(self.intercept))

    def transform(self, df: DataFrame, score: str, out: str) -> DataFrame:
        return df.withColumn(out, self.apply(F.col(score)))


@dataclass(frozen=True)
class Temperature:
    temperature: float

    def apply(self, score: Column) -> Column:
        return sigmoid(logit(score) / F.lit(self.temperature))

    def transform(self, df: DataFrame, score: str, out: str) -> DataFrame:
        return df.withColumn(out, self.apply(F.col(score)))


@dataclass(frozen=True)
class Isotonic:
    """Linear between the fitted steps and flat outside them."""

    model: IsotonicRegressionModel

    def transform(self, df: DataFrame, score: str, out: str) -> DataFrame:
        mine = self.model.copy().setFeaturesCol("_score").setPredictionCol("_calibrated")
        done = mine.transform(df.withColumn("_score", F.col(score).cast("double")))
        return done.withColumn(out, F.col("_calibrated")).drop("_score", "_calibrated")


def fit_platt(df: DataFrame, score: str, label: str = "y") -> Platt:
    rows = VectorAssembler(inputCols=[score], outputCol="features").transform(df.select(score, label))
    n = max(df.count(), 1)
    model = LogisticRegression(labelCol=label, regParam=1.0 / n, standardization=False, maxIter=200).fit(rows)
    return Platt(float(model.coefficients[0]), float(model.intercept))


def fit_isotonic(df: DataFrame, score: str, label: str = "y") -> Isotonic:
    """Equal scores are pooled before fitting."""
    cells = (
        df.groupBy(F.col(score).cast("double").alias("features"))
        .agg(F.avg(F.col(label).cast("double")).alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
        .filter(F.col("features").isNotNull())
    )
    model = IsotonicRegression(featuresCol="features", labelCol="label", weightCol="weight").fit(cells)
    return Isotonic(model)


def temperature_nll(df: DataFrame, score: str, temperatures: list[float], label: str = "y") -> DataFrame:
    """Mean negative log-likelihood of each temperature, all from one scan."""
    z = df.select(logit(F.col(score)).alias("z"), F.col(label).cast("double").alias("y"))
    aggs = []
    for i, t in enumerate(temperatures):
        q = clipped(sigmoid(F.col("z") / F.lit(float(t))))
        nll = -F.avg(F.col("y") * F.ln(q) + (1 - F.col("y")) * F.ln(1 - q))
        aggs.append(F.struct(F.lit(float(t)).alias("temperature"), nll.alias("nll")).alias(f"t{i}"))
    return z.agg(*aggs).select(F.inline(F.array(*[F.col(f"t{i}") for i in range(len(temperatures))])))


def fit_temperature(
    df: DataFrame, score: str, label: str = "y", low: float = 0.01, high: float = 10.0, points: int = 21, rounds: int = 4
) -> Temperature:
    """Grid search that narrows around the best point; the loss has one minimum in 1/T."""
    best = low
    for _ in range(rounds):
        step = (high - low) / (points - 1)
        grid = [low + i * step for i in range(points)]
        rows = temperature_nll(df, score, grid, label).collect()  # ``points`` rows
        best = min(rows, key=lambda r: r["nll"])["temperature"]
        low, high = max(0.01, best - step), min(10.0, best + step)
    return Temperature(float(best))


FITTERS = {"platt": fit_platt, "isotonic": fit_isotonic, "temperature": fit_temperature}
