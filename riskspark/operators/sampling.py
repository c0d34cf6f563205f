"""Deterministic splits and samples. The order comes from a seeded hash of the row key, so it does
not depend on partitioning and every retry of a task gives the same rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.functions.numeric import hash_uniform
from riskspark.operators.ranking import hash_rank


SLICES = 1 << 16


def hash_place(seed: str, key: str) -> Column:
    """A row's place in the order of splits and samples, in [0, 1)."""
    return hash_uniform(seed, F.col(key), digits=13)


def first_of_class(df: DataFrame, wanted: Sequence[Column], label: str, key: str, seed: str, u: Column | None = None) -> list[Column]:
    """Conditions that hold for the ``wanted`` first rows of each class in hash order, one for each of ``wanted``.

    Counts per class and slice of the hash range (combined before the shuffle) tell in which slices a
    class reaches its numbers; only the rows of these slices are ordered. One cut-off row per class and number comes
    back, so the conditions are row expressions and neither the table nor its keys are shuffled.
    ``wanted`` may use the label and ``group_rows``. ``u`` is the hash of the key by ``seed`` (``hash_place``) where it is at hand.
    """
    u = hash_place(seed, key) if u is None else u
    piece = F.floor(u * SLICES).cast("int")
    earlier = W.partitionBy(label).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    reached = (F.col("_before") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_before") + F.col("_n"))
    counts = (
        df.groupBy(label, piece.alias("_slice"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("group_rows", F.sum("_n").over(W.partitionBy(label)))
        .select("*", F.posexplode(F.array(*[w.cast("bigint") for w in wanted])).alias("_which", "_wanted"))
        .filter(reached)
    )
    chosen = [F.lit(False) for _ in wanted]
    found = counts.collect()  # one row per class and number
    if not found:
        return chosen
    mine = lambda row: F.col(label).eqNullSafe(F.lit(row[label]))
    places = sorted({(row[label] is None, row[label], row["_slice"]) for row in found}, key=repr)
    here = reduce(or_, [F.col(label).eqNullSafe(F.lit(c)) & (piece == F.lit(s)) for _, c, s in places])
    rank = F.row_number().over(W.partitionBy(label, "_slice").orderBy("_u", key))
    slices = df.filter(here).select(label, key, u.alias("_u"), piece.alias("_slice")).withColumn("_rank", rank)
    last = [mine(r) & (F.col("_slice") == r["_slice"]) & (F.col("_rank") == r["_wanted"] - r["_before"]) for r in found]
    at = {(r[label], r["_slice"], r["_rank"]): r for r in slices.filter(reduce(or_, last)).collect()}
    for r in found:
        row = at[r[label], r["_slice"], r["_wanted"] - r["_before"]]
        upto = (u < F.lit(row["_u"])) | ((u == F.lit(row["_u"])) & (F.col(key) <= F.lit(row[key])))
        chosen[r["_which"]] = chosen[r["_which"]] | (mine(r) & upto)
    return chosen


def stratified_split(
    df: DataFrame, fraction: float = 0.8, label: str = "isFraud", key: str = "TransactionID", seed: str = "42", u: Column | None = None
) -> DataFrame:
    """Adds ``is_train``: exactly ceil(fraction * n) rows of each class. ``u`` is a stored ``hash_place``."""
    # The small slack keeps a product such as 0.8 * 10 from being rounded above the whole number.
    wanted = F.ceil(F.lit(fraction) * F.col("group_rows") - F.lit(1e-9))
    return df.withColumn("is_train", first_of_class(df, [wanted], label, key, seed, u)[0])


def hash_split(df: DataFrame, fraction: float = 0.8, key: str = "TransactionID", seed: str = "42") -> DataFrame:
    """Adds ``is_train`` by a hash threshold: class shares hold in expectation and nothing is shuffled."""
    return df.withColumn("is_train", hash_uniform(seed, F.col(key), digits=13) < fraction)


def kfold(
    df: DataFrame, k: int = 5, label: str = "isFraud", key: str = "TransactionID", seed: str = "42"
) -> DataFrame:
    """Adds ``fold`` 0..k-1: the rows of each class are numbered in hash order and dealt in turn, so folds of a class differ
    by at most one row."""
    ranked = hash_rank(df, seed, key, [label])
    return ranked.select(*df.columns, F.pmod("hash_rank", F.lit(k)).cast("int").alias("fold"))


def _per_class(df: DataFrame, n_fraud: int, n_legit: int, label: str, key: str, seed: str) -> DataFrame:
    wanted = F.when(F.col(label) == 1, F.least(F.lit(n_fraud), F.col("group_rows"))).when(
        F.col(label) == 0, F.least(F.lit(n_legit), F.col("group_rows"))
    )
    return df.filter(first_of_class(df, [wanted], label, key, seed)[0])


def _class_counts(df: DataFrame, label: str) -> tuple[int, int]:
    fraud, legit = df.agg(F.count(F.when(F.col(label) == 1, 1)), F.count(F.when(F.col(label) == 0, 1))).first()
    return fraud, legit


def stratified_sample(
    df: DataFrame, n: int, label: str = "isFraud", key: str = "TransactionID", seed: str = "42"
) -> DataFrame:
    """A tenth fraud (all of it when there is less), the rest legit."""
    fraud, _ = _class_counts(df, label)
    n_fraud = min(n // 10, fraud)
    return _per_class(df, n_fraud, n - n_fraud, label, key, seed)


def importance_sample(
    df: DataFrame, n: int, label: str = "isFraud", key: str = "TransactionID", seed: str = "42"
) -> DataFrame:
    """Fraud at three times its base rate, filled up with legit rows."""
    fraud, legit = _class_counts(df, label)
    n_fraud = min(fraud, int(n * (fraud / max(fraud + legit, 1)) * 3))
    n_legit = min(legit, n - n_fraud)
    return _per_class(df, n_fraud, n_legit, label, key, seed)


def first_by_hash(df: DataFrame, seed: str, n: int, key: str = "TransactionID") -> DataFrame:
    """``n`` rows in the seeded order: a per-task top-n and a merge, no full sort."""
    return df.orderBy(hash_uniform(seed, F.col(key), digits=13), key).limit(n)
