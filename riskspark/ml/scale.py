"""Standardisation with population standard deviations; a constant column keeps scale 1."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import sqrt

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scaler:
    columns: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]

    def values(self) -> list[Column]:
        return [
            ((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(m)) / F.lit(s)).alias(f"z_{c}")
            for c, m, s in zip(self.columns, self.mean, self.scale)
        ]

    @property
    def names(self) -> list[str]:
        return [f"z_{c}" for c in self.columns]


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """Two numbers per column come back, from one map-side combined pass over the assembled vector."""
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(filled)
    row = vectors.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("_x")).alias("s")).first()["s"]
    n = row["count"]
    if n == 0:
        return Scaler(tuple(columns), (0.0,) * len(columns), (1.0,) * len(columns))
    population = sqrt((n - 1) / n)
    scale = tuple(float(sqrt(v) * population) or 1.0 for v in row["variance"])
    return Scaler(tuple(columns), tuple(float(m) for m in row["mean"]), scale)


def standardize(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *fit_scaler(df, columns).values())
