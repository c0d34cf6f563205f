"""Registered queries: scaling, resampling, models, calibration, attribution by trees."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.ml import anomaly, calibrate, classify
from riskspark.ml.scale import fit_scaler, standardize
from riskspark.ml.smote import nearest_neighbours, smote
from riskspark.plans import reports, training
from riskspark.plans.metric_queries import _RANKED
from riskspark.plans.model import RiskModel, Settings, fit_model
from riskspark.plans.oracle import SCORES, TX_EVENTS, hex_unit, r, u
from riskspark.plans.registry import register, round_columns
from riskspark.plans.scoring import explain_batch, importance_report, score_batch
from riskspark.session import new_dir, stored
from riskspark.sources import views

# One full model is fitted for all queries that need one. Flows that fit many models use smaller ones.
FULL = Settings()
SMALL = Settings(rounds=20, depth=4, bottleneck=4)
LOGISTIC = Settings(kind="logistic", use_anomaly=False)


def _transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Without C1, which the label is derived from."""
    return views.tx_events(spark, sf).drop("C1")


_SCALED = ["TransactionDT", "TransactionAmt", "card1", "C1", "addr1", "isFraud"]


@register(
    "standardize",
    f"""with {TX_EVENTS}, m as (select {', '.join(
        f'avg({c}) as m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) as s_{c}' for c in _SCALED)}
      from tx_events)
    select TransactionID, {', '.join(r(f'({c} - m_{c}) / s_{c}') + f' as z_{c}' for c in _SCALED)}
    from tx_events, m""",
)
def standardize_query(spark: SparkSession, sf: str) -> DataFrame:
    out = standardize(views.tx_events(spark, sf), _SCALED, keep=["TransactionID"])
    return round_columns(out, **{f"z_{c}": 6 for c in _SCALED})


_VECTORS = """rows_ as (select vec_id as id, cast(embedding as double[]) as v, label = 0 as minority from embeddings),
few as (select * from rows_ where minority),
near as (
  select * from (
    select a.id, b.id as neighbour, list_distance(a.v, b.v) as distance,
      row_number() over (partition by a.id order by list_distance(a.v, b.v), b.id) as rank
    from few a, few b where a.id <> b.id) x where rank <= 5)"""


@register(
    "smote_neighbours",
    f"with {_VECTORS} select id as TransactionID, cast(rank as integer) as rank, neighbour, {r('distance', 4)} as distance from near",
)
def smote_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    minority = views.features64(spark, sf).filter(F.col("isFraud") == 1)
    return round_columns(nearest_neighbours(minority), distance=4)


@register(
    "smote",
    f"""with {_VECTORS},
    need as (select (select count(*) from rows_) - 2 * (select count(*) from few) as missing,
                    (select count(*) from few) as n),
    ranked as (select *, row_number() over (order by {u('42', 'id', 13)}, id) - 1 as hr from few),
    plans as (
      select id, v, copy, concat_ws('-', cast(id as varchar), cast(copy as varchar)) as name
      from (select id, v, unnest(range(1, 1 + greatest(0, missing) // n
              + cast(hr < greatest(0, missing) % n as bigint))) as copy from ranked, need) x),
    placed as (
      select id, v, copy, cast(floor({hex_unit("md5(concat_ws(':', '42n', name))")} * 5) + 1 as integer) as rank,
        {hex_unit("md5(concat_ws(':', '42g', name))")} as part from plans)
    select p.id as TransactionID, cast(p.copy as integer) as copy, n.neighbour, {r('part')} as part,
      {r('p.v[1] + part * (f.v[1] - p.v[1])')} as first_value,
      {r('p.v[64] + part * (f.v[64] - p.v[64])')} as last_value
    from placed p join near n on p.id = n.id and p.rank = n.rank join few f on f.id = n.neighbour""",
)
def smote_query(spark: SparkSession, sf: str) -> DataFrame:
    out = smote(views.features64(spark, sf)).select(
        "TransactionID",
        "copy",
        "neighbour",
        "part",
        F.element_at("values", 1).alias("first_value"),
        F.element_at("values", 64).alias("last_value"),
    )
    return round_columns(out, part=6, first_value=6, last_value=6)


@register(
    "platt_apply",
    f"""with {SCORES}
    select TransactionID, {r('1 / (1 + exp(-(9.5::double * pa - 7.0::double)))')} as calibrated from scores""",
)
def platt_apply(spark: SparkSession, sf: str) -> DataFrame:
    out = calibrate.Platt(9.5, -7.0).transform(views.scores(spark, sf), "pa", "calibrated")
    return round_columns(out.select("TransactionID", "calibrated"), calibrated=6)


_TEMPERATURES = [0.25 * i for i in range(1, 41)]


@register(
    "temperature_nll",
    f"""with {SCORES}, t(temperature) as (select 0.25::double * i from range(1, 41) x(i)),
    z as (select y, greatest(1e-7, least(1 - 1e-7, pa)) as p from scores),
    q as (select temperature, y,
            greatest(1e-7, least(1 - 1e-7, 1 / (1 + exp(-ln(p / (1 - p)) / temperature)))) as q from z, t)
    select temperature, {r('-avg(y * ln(q) + (1 - y) * ln(1 - q))')} as nll from q group by temperature""",
)
def temperature_nll(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(calibrate.temperature_nll(views.scores(spark, sf), "pa", _TEMPERATURES), nll=6)


def _calibration(method: str) -> None:
    @register(f"calibration_compare_{method}")
    def query(spark: SparkSession, sf: str) -> DataFrame:
        table, _ = training.calibrate_and_compare(views.scores(spark, sf), "pa", "y", method)
        return round_columns(table, before=6, after=6, delta=6)


for _method in calibrate.FITTERS:
    _calibration(_method)


@register("isotonic_apply")
def isotonic_apply(spark: SparkSession, sf: str) -> DataFrame:
    df = views.scores(spark, sf)
    out = calibrate.fit_isotonic(df, "pa").transform(df, "pa", "calibrated")
    return round_columns(out.select("TransactionID", "calibrated"), calibrated=6)


@register("isotonic_blocks", f"with {SCORES} select TransactionID, 1 as mean_of_block, 1 as in_order from scores")
def isotonic_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """What makes a fit isotonic: a calibrated score is the share of positive rows among those that have it, and blocks of
    equal calibrated scores do not overlap in their raw scores."""
    df = views.scores(spark, sf)
    rows = stored(calibrate.fit_isotonic(df, "pa").transform(df, "pa", "calibrated").select("TransactionID", "pa", "y", F.round("calibrated", 12).alias("block")))
    blocks = rows.groupBy("block").agg(F.avg("y").alias("share"), F.min("pa").alias("low"), F.max("pa").alias("high"))
    before = F.max("high").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    blocks = blocks.withColumn("in_order", F.coalesce(before < F.col("low"), F.lit(True)))
    right = F.abs(F.col("share") - F.col("block")) < 1e-6
    return rows.join(blocks, "block").select("TransactionID", right.cast("int").alias("mean_of_block"), F.col("in_order").cast("int").alias("in_order"))


# -- models ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fitted:
    """A model with what it was fitted on, and where it is saved."""

    model: RiskModel
    path: str
    train: DataFrame
    test: DataFrame
    names: list[str]
    risk: DataFrame
    cards: DataFrame


_fitted: dict[tuple[str, str, Settings], Fitted] = {}


def fitted(spark: SparkSession, sf: str, settings: Settings = FULL) -> Fitted:
    """The model of the training part of all transactions with all features; fitted once in a session."""
    key = (spark.sparkContext.applicationId, sf, settings)
    if key not in _fitted:
        train, test, names, risk, cards = training.prepare(_transactions(spark, sf))
        path = new_dir(spark, "model")
        fit_model(train, names, settings).save(spark, path)
        _fitted[key] = Fitted(RiskModel.load(spark, path), path, train, test, names, risk, cards)
    return _fitted[key]


#: The rows that the split leaves for testing.
TEST_ROWS = f"""with {_RANKED}, test as (select * from ranked where rk >= ceil(0.8::double * n - 1e-9))"""


@register("logistic_baseline")
def logistic_baseline(spark: SparkSession, sf: str) -> DataFrame:
    made = fitted(spark, sf, LOGISTIC)
    return made.model.score(made.test, keep=("TransactionID", "isFraud"))


@register("logistic_by_formula", f"{TEST_ROWS} select TransactionID, isFraud, 1 as by_formula, 1 as stationary from test")
def logistic_by_formula(spark: SparkSession, sf: str) -> DataFrame:
    """Test scores are the logistic function of the weighted scaled features, and the weights are where the penalised,
    class-balanced loss of the training rows has no slope."""
    made = fitted(spark, sf, LOGISTIC)
    model, weights = made.model, list(made.model.classifier.coefficients)
    margin = sum((F.lit(float(w)) * F.col(c) for w, c in zip(weights, model.inputs)), F.lit(float(model.classifier.intercept)))
    rows = model.prepared(made.train)
    pos, neg = classify.class_ratio(rows, "isFraud")
    error = classify.balanced_weight("isFraud", pos, neg) * (1 / (1 + F.exp(-margin)) - F.col("isFraud"))
    slopes = rows.agg(*[F.avg(error * F.col(c)).alias(c) for c in model.inputs]).first()
    stationary = max(abs(g + w / (pos + neg)) for g, w in zip(slopes, weights)) < 1e-4
    scored = model.prepared(made.test).withColumn("want", 1 / (1 + F.exp(-margin))).select("TransactionID", "isFraud", "want")
    both = scored.join(model.score(made.test), "TransactionID")
    right = (F.abs(F.col("raw_score") - F.col("want")) < 1e-9).cast("int")
    return both.select("TransactionID", "isFraud", right.alias("by_formula"), F.lit(int(stationary)).alias("stationary"))


@register("gbt_scores")
def gbt_scores(spark: SparkSession, sf: str) -> DataFrame:
    made = fitted(spark, sf)
    return made.model.score(made.test, keep=("TransactionID", "isFraud")).select("TransactionID", "isFraud", F.col("raw_score").alias("probability"))


@register("pca_anomaly")
def pca_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    names = [f"v{i}" for i in range(64)]
    rows = views.features64(spark, sf)
    rows = rows.select("TransactionID", "isFraud", *[F.col("values")[i].alias(n) for i, n in enumerate(names)])
    scaler = fit_scaler(rows, names)
    scaled = rows.select("TransactionID", "isFraud", *scaler.values())
    model = anomaly.fit_anomaly(scaled.filter(F.col("isFraud") == 0), scaler.names)
    out = anomaly.anomaly_scores(scaled, model, scaler.names)
    return out.select("TransactionID", "ae_anomaly_score", F.size("embedding").alias("embedding_size"))


@register("pca_by_formula", "select vec_id as TransactionID, 1 as by_formula from embeddings")
def pca_by_formula(spark: SparkSession, sf: str) -> DataFrame:
    """The anomaly score is the mean squared distance of the scaled row from its projection on the components, which are
    orthonormal."""
    names = [f"v{i}" for i in range(64)]
    rows = views.features64(spark, sf)
    rows = rows.select("TransactionID", "isFraud", *[F.col("values")[i].alias(n) for i, n in enumerate(names)])
    scaler = fit_scaler(rows, names)
    scaled = rows.select("TransactionID", "isFraud", *scaler.values())
    model = anomaly.fit_anomaly(scaled.filter(F.col("isFraud") == 0), scaler.names)
    basis = model.pc.toArray()
    flat = bool(abs(basis.T @ basis - np.eye(basis.shape[1])).max() < 1e-9)

    def distance(batches):
        for batch in batches:
            x = batch[list(scaler.names)].to_numpy(float)
            yield pd.DataFrame({"TransactionID": batch["TransactionID"], "want": ((x - x @ basis @ basis.T) ** 2).mean(1)})

    want = scaled.mapInPandas(distance, "TransactionID long, want double")
    both = anomaly.anomaly_scores(scaled, model, scaler.names).select("TransactionID", "ae_anomaly_score").join(want, "TransactionID")
    right = (F.abs(F.col("ae_anomaly_score") - F.col("want")) < 1e-9) & F.lit(flat)
    return both.select("TransactionID", right.cast("int").alias("by_formula"))


@register("train_eval")
def train_eval(spark: SparkSession, sf: str) -> DataFrame:
    made = fitted(spark, sf)
    return training.evaluate_model(made.model, made.test)


@register("score_batch")
def score_batch_query(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted on the training part; the whole table is then scored with those profiles."""
    made = fitted(spark, sf)
    return score_batch(_transactions(spark, sf), made.model, made.risk, made.cards, model_path=made.path)


@register("score_batch_rows", f"with {TX_EVENTS} select TransactionID, 1 as decided, 1 as explained from tx_events")
def score_batch_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every transaction is scored once; its flag follows its score and its text names its action."""
    made = fitted(spark, sf)
    rows = score_batch(_transactions(spark, sf), made.model, made.risk, made.cards, model_path=made.path)
    score = F.col("fraud_score")
    decided = ((F.col("is_fraud").cast("boolean") == (score >= 0.5)) | (F.abs(score - 0.5) < 2e-6)) & score.between(0, 1)
    action = F.when(score > 0.8, "BLOCK.").when(score > 0.5, "REVIEW.").otherwise("MONITOR.")
    near = (F.abs(score - 0.8) < 2e-6) | (F.abs(score - 0.5) < 2e-6)
    explained = (F.substring_index("explanation", " ", -1) == action) | near
    return rows.select("TransactionID", decided.cast("int").alias("decided"), (explained & (F.size("top_risk_factors") == 5)).cast("int").alias("explained"))


@register("tree_contributions")
def tree_contributions(spark: SparkSession, sf: str) -> DataFrame:
    made = fitted(spark, sf)
    return made.model.contributions(made.test, made.path, keep=["TransactionID"])


@register("tree_additivity", f"{TEST_ROWS} select TransactionID, 1 as additive from test")
def tree_additivity(spark: SparkSession, sf: str) -> DataFrame:
    """Contributions plus expected value equal the model's own margin on every row."""
    made = fitted(spark, sf)
    phi = made.model.contributions(made.test, made.path, keep=["TransactionID"])
    scored = made.model.score(made.test).select("TransactionID", "raw_score")
    margin = F.ln(F.col("raw_score") / (1 - F.col("raw_score"))) / 2
    gap = F.abs(F.col("sum_shap") + F.col("expected_value") - margin)
    return phi.join(scored, "TransactionID").select("TransactionID", (gap < 1e-6).cast("int").alias("additive"))


@register("tree_importance")
def tree_importance(spark: SparkSession, sf: str) -> DataFrame:
    made = fitted(spark, sf)
    return importance_report(made.test, made.model, made.path, n=10_000)[0]


@register("tree_importance_by_class")
def tree_importance_by_class(spark: SparkSession, sf: str) -> DataFrame:
    made = fitted(spark, sf)
    return importance_report(made.test, made.model, made.path, n=10_000)[1]


@register("explain_batch")
def explain_batch_query(spark: SparkSession, sf: str) -> DataFrame:
    made = fitted(spark, sf)
    return explain_batch(made.test, made.model, made.path).select("TransactionID", "fraud_score", "factors", "explanation")


@register("cross_validate")
def cross_validate(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of each fold of the whole ensemble."""
    made = fitted(spark, sf, LOGISTIC)
    return training.cross_validate(made.train, made.names, SMALL, k=5)


@register("ablation")
def ablation(spark: SparkSession, sf: str) -> DataFrame:
    """All eight variants with interval, significance and improvement as one record."""
    made = fitted(spark, sf, LOGISTIC)
    table, scores = training.ablation(made.train, made.test, made.names, SMALL)
    return reports.ablation_record(stored(table), scores, training.SUBJECT, training.BASELINES)
