"""Training flows: leak-free fit and evaluation, cross-validation, calibration and ablation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.ml import calibrate
from riskspark.operators import metrics, profiles, sampling
from riskspark.plans import reports
from riskspark.plans.features import build_features, drop_features
from riskspark.plans.model import RiskModel, Settings, fit_model
from riskspark.session import at_once, stored
from riskspark.sources import io
from riskspark.sources.schema import ADDRESS, FEATURES, MERCHANT, VELOCITY, feature_columns


def prepare(
    df: DataFrame, fraction: float = 0.8, hours: Sequence[int] = (1, 6, 24), history: bool = False
) -> tuple[DataFrame, DataFrame, list[str], DataFrame, DataFrame]:
    """Splits first, takes every statistic from the training rows only, then builds both feature sets.

    The two sets are stored (reliable checkpoint), because the fits read them many times. With
    ``history`` the test windows also see the training rows. Returns train, test, feature names, risk
    profile and card statistics.
    """
    # Stored once, as narrow as the features allow: the split, the statistics and both builds read it.
    needed = {"TransactionID", "isFraud", "TransactionDT", "event_time", "TransactionAmt", "ProductCD", "card1", "addr1", "addr2", *FEATURES}
    # With the hash of each key, so that the rows are made and hashed once and the split is a comparison.
    rows = stored(df.select(*[c for c in df.columns if c in needed], sampling.hash_place("42", "TransactionID").alias("_u")))
    split = sampling.stratified_split(rows, fraction, u=F.col("_u"))
    train, test = (split.filter(c).drop("is_train", "_u") for c in (F.col("is_train"), ~F.col("is_train")))
    risk, cards = stored(profiles.risk_profile(train)), stored(profiles.card_stats(train))
    past = train.select("card1", "event_time", "TransactionAmt") if history else None
    built = [
        build_features(part, risk, cards, hours, history=h) for part, h in ((train, None), (test, past))
    ]
    names = feature_columns(built[0].columns)
    kept = [stored(b.select("TransactionID", "isFraud", *names)) for b in built]
    return kept[0], kept[1], names, risk, cards


def evaluate_model(model: RiskModel, test: DataFrame, threshold: float = 0.5) -> DataFrame:
    scored = stored(model.score(test, keep=("TransactionID", "isFraud")))
    return metrics.evaluate(scored, "fraud_score", "isFraud", threshold)


def cross_validate(
    df: DataFrame, features: Sequence[str], settings: Settings = Settings(), k: int = 5
) -> DataFrame:
    """One row per fold with its metrics; ``df`` holds stored features."""
    folds = stored(sampling.kfold(df, k))

    def tested(fold: int) -> DataFrame:
        model = fit_model(folds.filter(F.col("fold") != fold), features, settings)
        # Stored, so that the folds are also evaluated at the same time.
        return stored(evaluate_model(model, folds.filter(F.col("fold") == fold)).withColumn("fold", F.lit(fold)))

    return reduce(DataFrame.unionByName, at_once(tested, range(k)))


def cross_validation_summary(folds: DataFrame, metric: str = "auc_pr") -> DataFrame:
    return folds.agg(
        F.avg(metric).alias(f"{metric}_mean"), F.stddev_pop(metric).alias(f"{metric}_std"), F.count(F.lit(1)).alias("folds")
    )


def calibrate_and_compare(
    scored: DataFrame, score: str, label: str = "y", method: str = "platt", threshold: float = 0.5
) -> tuple[DataFrame, object]:
    """Fits on 40 % of the rows and reports the other 60 % before and after, with the differences."""
    split = stored(sampling.stratified_split(scored, 0.4, label))
    fitted = calibrate.FITTERS[method](split.filter("is_train"), score, label)
    rest = stored(fitted.transform(split.filter("not is_train"), score, "calibrated"))
    names = ("precision", "recall", "f1", "auc_pr", "auc_roc")
    before = metrics.evaluate(rest, score, label, threshold).select(F.struct(*names)).scalar()
    after = metrics.evaluate(rest, "calibrated", label, threshold).select(F.struct(*names)).scalar()
    both = scored.sparkSession.range(1).select(before.alias("b"), after.alias("a"))
    rows = [
        F.struct(
            F.lit(n).alias("metric"),
            F.col("b")[n].alias("before"),
            F.col("a")[n].alias("after"),
            (F.col("a")[n] - F.col("b")[n]).alias("delta"),
        )
        for n in names
    ]
    return both.select(F.inline(F.array(*rows))), fitted


# Variants of the ablation: name, changed settings, dropped features.
VARIANTS = {
    "1_logistic_baseline": ({"kind": "logistic", "use_anomaly": False}, VELOCITY + ADDRESS + MERCHANT),
    "2_trees_smote": ({"use_anomaly": False, "resample": "smote"}, []),
    "3_trees_costsensitive": ({"use_anomaly": False}, []),
    "4_full_ensemble": ({"resample": "smote"}, []),
    "5_no_velocity": ({"resample": "smote"}, VELOCITY),
    "6_no_haversine": ({"resample": "smote"}, ADDRESS),
    "7_no_merchant_risk": ({"resample": "smote"}, MERCHANT),
    "8_no_smote": ({}, []),
}
BASELINES = ("1_logistic_baseline", "2_trees_smote", "3_trees_costsensitive")
SUBJECT = "4_full_ensemble"


def ablation(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    settings: Settings = Settings(),
    variants: Sequence[str] = tuple(VARIANTS),
    threshold: float = 0.4,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Metrics of every variant as one table, and the stored test scores of each."""

    def tested(name: str) -> tuple[DataFrame, DataFrame]:
        changes, dropped = VARIANTS[name]
        model = fit_model(train, drop_features(features, dropped), replace(settings, **changes))
        scored = stored(model.score(test, keep=("TransactionID", "isFraud")))
        one = metrics.evaluate(scored, "fraud_score", "isFraud", threshold)
        return stored(one.select(F.lit(name).alias("variant"), *one.columns)), scored

    found = at_once(tested, variants)
    return reduce(DataFrame.unionByName, [one for one, _ in found]), {name: scored for name, (_, scored) in zip(variants, found)}


# -- jobs over files ---------------------------------------------------------------------------


def run_training(
    transactions: DataFrame,
    identity: DataFrame | None,
    out: str,
    settings: Settings = Settings(),
    fraction: float = 0.8,
) -> DataFrame:
    """From raw tables to a saved model: writes the profiles, test features, the evaluation record and the model under
    ``out`` and returns the record."""
    spark = transactions.sparkSession
    train, test, names, risk, cards = prepare(profiles.join_identity(transactions, identity), fraction)
    io.write_table(risk, f"{out}/risk_profile")
    io.write_table(cards, f"{out}/card_stats")
    io.write_table(test, f"{out}/test_features")
    model = fit_model(train, names, settings)
    model.save(spark, f"{out}/model")
    scored = stored(model.score(test, keep=("TransactionID", "isFraud")))
    return _kept(reports.evaluation_record(scored, "fraud_score", "isFraud"), f"{out}/metrics")


def run_calibration(spark: SparkSession, out: str, method: str = "platt") -> DataFrame:
    """Calibrates the model saved under ``out`` on 40 % of its test features, saves it again with the calibrator and returns
    the calibration record of the other 60 %."""
    model = RiskModel.load(spark, f"{out}/model")
    model.calibrator = None
    scored = stored(model.score(io.read_features(spark, f"{out}/test_features"), keep=("TransactionID", "isFraud")))
    split = stored(sampling.stratified_split(scored, 0.4, "isFraud"))
    model.calibrator = calibrate.FITTERS[method](split.filter("is_train"), "raw_score", "isFraud")
    rest = stored(model.calibrator.transform(split.filter("not is_train"), "raw_score", "calibrated"))
    model.save(spark, f"{out}/calibrated_model")
    return _kept(reports.calibration_record(rest, "raw_score", "calibrated", "isFraud", method), f"{out}/calibration")


def run_ablation(
    transactions: DataFrame,
    identity: DataFrame | None,
    out: str,
    settings: Settings = Settings(),
    variants: Sequence[str] = tuple(VARIANTS),
    replicates: int = 500,
) -> DataFrame:
    """Fits and tests every variant and returns the ablation record, which is kept under ``out``."""
    train, test, names, _, _ = prepare(profiles.join_identity(transactions, identity))
    table, scores = ablation(train, test, names, settings, variants)
    return _kept(reports.ablation_record(stored(table), scores, SUBJECT, BASELINES, replicates=replicates), f"{out}/ablation")


def _kept(record: DataFrame, path: str) -> DataFrame:
    io.write_metrics(record, path)
    return record.sparkSession.read.schema(record.schema).json(path)
