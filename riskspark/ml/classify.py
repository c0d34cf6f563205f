"""Probability models: the weighted logistic baseline and cost-sensitive boosted trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.numeric import hash_uniform
from riskspark.ml.boost import boost, node_rows
from riskspark.ml.trim import best_rounds, made, trimmed


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def class_ratio(df: DataFrame, label: str) -> tuple[int, int]:
    pos, neg = df.agg(F.count(F.when(F.col(label) == 1, 1)), F.count(F.when(F.col(label) == 0, 1))).first()
    return pos, neg


def balanced_weight(label: str, pos: int, neg: int) -> Column:
    """Both classes get half of the total weight."""
    total = pos + neg
    return F.when(F.col(label) == 1, F.lit(total / (2.0 * max(pos, 1)))).otherwise(F.lit(total / (2.0 * max(neg, 1))))


def fit_logistic(df: DataFrame, columns: Sequence[str], label: str = "isFraud", max_iter: int = 1000) -> LogisticRegressionModel:
    pos, neg = class_ratio(df, label)
    weighted = assemble(df, columns).withColumn("_w", balanced_weight(label, pos, neg))
    # The usual unit penalty on a sum of losses is 1/n on Spark's mean of losses.
    estimator = LogisticRegression(
        labelCol=label, weightCol="_w", maxIter=max_iter, regParam=1.0 / max(pos + neg, 1), standardization=False
    )
    return estimator.fit(weighted.select("features", label, "_w"))


#: Rows up to which Spark's own trees are fitted. Beyond, the same rounds are run by ``boost``, which takes less of each.
SPARK_ROWS = 500_000
#: Rows of a training partition at least: more and smaller ones only add to the time of each of many short jobs.
PARTITION_ROWS = 20_000


def held_out(key: str, seed: int, share: float = 0.15) -> Column:
    """Picks the rows that only decide how many rounds to keep."""
    return hash_uniform(f"stop{seed}", F.col(key)) < share


def next_rounds(run: int, rounds: int) -> int:
    """Twice as many rounds, or all of them if twice as many again would be more: a refit starts from nothing, so one that
    stops just short of the end is paid for twice."""
    return rounds if 4 * run > rounds else 2 * run


def fit_trees(
    df: DataFrame,
    columns: Sequence[str],
    label: str = "isFraud",
    key: str = "TransactionID",
    rounds: int = 500,
    depth: int = 6,
    step: float = 0.05,
    subsample: float = 0.8,
    feature_share: float = 0.8,
    min_rows: int = 5,
    penalty: float = 1.0,
    patience: int = 30,
    validation_share: float = 0.15,
    positive_weight: float | None = None,
    seed: int = 42,
    stop: Column | None = None,
) -> GBTClassificationModel:
    """Boosted trees. A hash-picked share of the rows (or those where ``stop`` holds) is left out of the training; its
    loss is taken after every round, and the rounds up to the lowest one before ``patience`` rounds without improvement are
    kept. Splits that save less than ``penalty`` are then pruned.

    Boosting is run for a few rounds first, and for more (``next_rounds``) as long as patience has not ended within them: the
    first rounds are the same however many follow. More than ``SPARK_ROWS`` rows are boosted by ``boost`` instead, round by
    round until patience ends.

    ``positive_weight`` defaults to negatives per positive. Features are sampled per node.
    """
    stop = held_out(key, seed, validation_share) if stop is None else stop
    rows = assemble(df, columns).select("features", F.col(label).cast("double").alias("label"), stop.alias("_stop"))
    pos, neg = class_ratio(rows.filter("not _stop"), "label")
    weight = neg / max(pos, 1) if positive_weight is None else positive_weight
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
    trees = GBTClassifier(
        labelCol="label",
        weightCol="weight",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=subsample,
        featureSubsetStrategy=str(feature_share),
        minInstancesPerNode=min_rows,
        seed=seed,
    )
    if pos + neg > SPARK_ROWS:
        plain = df.select(*[F.col(c).cast("double") for c in columns], F.col(label).cast("double").alias("label"), stop.alias("_stop"))
        plain = plain.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(weight))).otherwise(F.lit(1.0)))
        grown, cuts, losses = boost(plain, columns, rounds, depth, step, subsample, feature_share, min_rows, patience, seed)
        keep = best_rounds(losses, patience) if losses else len(grown)
        corners = [(Vectors.dense([float(y)] * len(columns)), float(y), 1.0) for y in (0, 1)]
        like = trees.setMaxIter(2).fit(df.sparkSession.createDataFrame(corners, ["features", "label", "weight"]))
        return made(df.sparkSession, like, [node_rows(tree, cuts) for tree in grown[:keep]], penalty, len(grown))
    training, checked = rows.filter("not _stop").drop("_stop"), rows.filter("_stop").drop("_stop")
    training = training.coalesce(max(1, -(-(pos + neg) // PARTITION_ROWS)))
    run = rounds if checked.isEmpty() else min(rounds, 2 * patience)
    while True:
        model = trees.setMaxIter(run).fit(training)
        keep = run if checked.isEmpty() else best_rounds(model.evaluateEachIteration(checked), patience)
        if run >= rounds or keep + patience <= run:
            return trimmed(df.sparkSession, model, keep, penalty)
        run = next_rounds(run, rounds)


def probability(df: DataFrame, model, columns: Sequence[str], out: str = "probability") -> DataFrame:
    """Adds the probability of class 1."""
    scored = model.transform(assemble(df, columns))
    one = vector_to_array("probability")[1]
    return scored.withColumn("_p", one).drop("features", "rawPrediction", "probability", "prediction").withColumnRenamed(
        "_p", out
    )
