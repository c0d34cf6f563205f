"""The risk model: scaling, anomaly score, boosted trees and calibration, fitted and applied together."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.feature import PCAModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.ml import anomaly, attribute, calibrate, classify
from riskspark.ml.scale import Scaler, fit_scaler
from riskspark.ml.smote import smote
from riskspark.operators.metrics import percentile_threshold
from riskspark.plans.features import feature_values
from riskspark.session import stored


@dataclass(frozen=True)
class Settings:
    """Training choices. ``kind`` is trees or logistic; ``resample`` is weights or smote."""

    kind: str = "trees"
    use_anomaly: bool = True
    resample: str = "weights"
    rounds: int = 500
    depth: int = 6
    patience: int = 30
    penalty: float = 1.0
    bottleneck: int = anomaly.BOTTLENECK
    anomaly_percent: float = 95.0
    seed: int = 42


@dataclass
class RiskModel:
    features: list[str]
    settings: Settings
    scaler: Scaler
    classifier: GBTClassificationModel | LogisticRegressionModel
    pca: PCAModel | None = None
    anomaly_threshold: float | None = None
    calibrator: calibrate.Platt | calibrate.Temperature | calibrate.Isotonic | None = None
    inputs: list[str] = field(default_factory=list)

    # -- applying --------------------------------------------------------------------------

    def prepared(self, df: DataFrame) -> DataFrame:
        """Adds the scaled features, and the anomaly score and its code when the model has them."""
        filled = feature_values(df.columns, self.features)
        scaled = df.withColumns({c: v for c, v in zip(self.features, filled)})
        out = scaled.select("*", *self.scaler.values())
        return _with_anomaly(out, self.pca, self.scaler.names) if self.pca is not None else out

    def score(self, df: DataFrame, keep: Sequence[str] = ("TransactionID",)) -> DataFrame:
        """``keep`` columns, ``raw_score``, calibrated ``fraud_score`` and ``anomaly_score``."""
        scored = classify.probability(self.prepared(df), self.classifier, self.inputs, "raw_score")
        if self.calibrator is None:
            scored = scored.withColumn("fraud_score", F.col("raw_score"))
        else:
            scored = self.calibrator.transform(scored, "raw_score", "fraud_score")
        name = "ae_anomaly_score" if self.pca is not None else None
        anomalous = F.col(name) if name else F.lit(0.0)
        return scored.select(*keep, "raw_score", "fraud_score", anomalous.alias("anomaly_score"))

    def contributions(self, df: DataFrame, path: str | None, keep: Sequence[str]) -> DataFrame:
        """Per-row contributions to the margin: ``keep``, ``phi_<input>``, ``expected_value``, ``sum_shap``. For trees ``path``
        is where this model is saved. A logistic model's are linear, against inputs of 0, the mean of a scaled feature."""
        prepared = self.prepared(df)
        if self.settings.kind == "trees":
            return attribute.tree_contributions(prepared, self.classifier, f"{path}/classifier", self.inputs, keep)
        phi = {f"phi_{c}": F.lit(float(w)) * F.col(c) for c, w in zip(self.inputs, self.classifier.coefficients)}
        found = prepared.select(*keep, *[x.alias(name) for name, x in phi.items()])
        return found.withColumns({"expected_value": F.lit(float(self.classifier.intercept)), "sum_shap": sum((F.col(n) for n in phi), F.lit(0.0))})

    def probability_of(self, margin: Column) -> Column:
        """The raw score that a margin stands for."""
        return 1 / (1 + F.exp((-2 if self.settings.kind == "trees" else -1) * margin))

    # -- saving ----------------------------------------------------------------------------

    def save(self, spark: SparkSession, path: str) -> None:
        self.classifier.write().overwrite().save(f"{path}/classifier")
        if self.pca is not None:
            self.pca.write().overwrite().save(f"{path}/pca")
        kind, values = _calibrator_state(self.calibrator)
        if kind == "isotonic":
            self.calibrator.model.write().overwrite().save(f"{path}/isotonic")
        meta = {
            "features": self.features,
            "inputs": self.inputs,
            "settings": asdict(self.settings),
            "scaler": asdict(self.scaler),
            "anomaly_threshold": self.anomaly_threshold,
            "calibrator": [kind, values],
        }
        row = spark.createDataFrame([(json.dumps(meta),)], "meta string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> RiskModel:
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        settings = Settings(**meta["settings"])
        loader = GBTClassificationModel if settings.kind == "trees" else LogisticRegressionModel
        kind, values = meta["calibrator"]
        calibrator = None
        if kind == "isotonic":
            calibrator = calibrate.Isotonic(IsotonicRegressionModel.load(f"{path}/isotonic"))
        elif kind:
            calibrator = {"platt": calibrate.Platt, "temperature": calibrate.Temperature}[kind](**values)
        return RiskModel(
            features=meta["features"],
            settings=settings,
            scaler=Scaler(*[tuple(meta["scaler"][k]) for k in ("columns", "mean", "scale")]),
            classifier=loader.load(f"{path}/classifier"),
            pca=PCAModel.load(f"{path}/pca") if settings.use_anomaly else None,
            anomaly_threshold=meta["anomaly_threshold"],
            calibrator=calibrator,
            inputs=meta["inputs"],
        )


def _calibrator_state(calibrator) -> tuple[str | None, dict]:
    if calibrator is None:
        return None, {}
    if isinstance(calibrator, calibrate.Isotonic):
        return "isotonic", {}
    return type(calibrator).__name__.lower(), asdict(calibrator)


def _with_anomaly(df: DataFrame, pca: PCAModel, names: Sequence[str]) -> DataFrame:
    out = anomaly.anomaly_scores(df, pca, names)
    codes = {f"ae_emb_{i}": F.col("embedding")[i] for i in range(pca.getK())}
    return out.withColumns(codes).drop("embedding")


def fit_model(
    train: DataFrame, features: Sequence[str], settings: Settings = Settings(), label: str = "isFraud", key: str = "TransactionID"
) -> RiskModel:
    """Fits on stored training features: scaler on all rows, anomaly part on legitimate rows, then the
    classifier on the features with the anomaly score and code appended."""
    features = list(features)
    scaler = fit_scaler(train, features)
    scaled = train.select(key, label, *scaler.values())
    pca = threshold = None
    inputs = list(scaler.names)
    if settings.use_anomaly:
        legit = scaled.filter(F.col(label) == 0)
        pca = anomaly.fit_anomaly(legit, scaler.names, settings.bottleneck)
        inputs += ["ae_anomaly_score"] + [f"ae_emb_{i}" for i in range(pca.getK())]
        # The training matrix is read many times by the fits below.
        scaled = stored(_with_anomaly(scaled, pca, scaler.names).select(key, label, *inputs))
        legit_scores = scaled.filter(F.col(label) == 0).select("ae_anomaly_score")
        threshold = percentile_threshold(legit_scores, "ae_anomaly_score", settings.anomaly_percent).first()["threshold"]
    # What decides about the number of rounds is set apart first, so no synthetic row is drawn from or towards it.
    stop = F.lit(False) if settings.kind == "logistic" else classify.held_out(key, settings.seed)
    rows, weight = scaled.select(key, label, *inputs, stop.alias("_stop")), None
    if settings.resample == "smote":
        rows, weight = stored(_resampled(rows, inputs, label, key, str(settings.seed))), 1.0
    if settings.kind == "logistic":
        classifier = classify.fit_logistic(rows.drop("_stop"), inputs, label)
    else:
        classifier = classify.fit_trees(
            rows, inputs, label, key, settings.rounds, settings.depth, patience=settings.patience, penalty=settings.penalty,
            positive_weight=weight, seed=settings.seed, stop=F.col("_stop"),
        )
    return RiskModel(features, settings, scaler, classifier, pca, threshold, None, inputs)


def _resampled(rows: DataFrame, inputs: Sequence[str], label: str, key: str, seed: str) -> DataFrame:
    """Rows and synthetic minority rows between rows that are trained on."""
    packed = rows.filter("not _stop").select(key, label, F.array(*inputs).alias("values"))
    made = smote(packed, key=key, label=label, seed=seed)
    unpacked = made.select(key, label, *[F.col("values")[i].alias(c) for i, c in enumerate(inputs)], F.lit(False).alias("_stop"))
    return rows.unionByName(unpacked)
