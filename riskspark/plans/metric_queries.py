"""Registered queries: metrics, curves, bootstrap, splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.numeric import rounded
from riskspark.functions.text import fixed
from riskspark.ml import calibrate
from riskspark.operators import bootstrap, metrics, sampling
from riskspark.plans import reports
from riskspark.plans.oracle import SCORES, TX_EVENTS, div, poisson, r, u
from riskspark.plans.registry import ORACLES, register, round_columns
from riskspark.session import stored
from riskspark.sources import views

CONFUSION = f"""{SCORES},
m as (select count(*) filter (pa >= 0.5::double and y = 1) as tp,
             count(*) filter (pa >= 0.5::double and y = 0) as fp,
             count(*) filter (pa < 0.5::double and y = 1) as fn,
             count(*) filter (pa < 0.5::double and y = 0) as tn from scores)"""

CURVE = f"""{SCORES},
cells as (select pa, sum(y) as tp, sum(1 - y) as fp from scores group by pa),
curve as (
  select pa, tp, fp, sum(tp) over w as ctp, sum(fp) over w as cfp,
         sum(tp) over () as ntp, sum(fp) over () as nfp
  from cells window w as (order by pa desc))"""
AUC_PR = "sum(tp::double / ntp * ctp / (ctp + cfp))"
AUC_ROC = "sum(fp::double / nfp * (ctp - tp + tp::double / 2) / ntp)"


@register(
    "dataset_summary",
    f"""with {TX_EVENTS}
    select count(*) as n_rows, cast(sum(isFraud) as bigint) as n_fraud, {r('avg(isFraud)')} as fraud_rate
    from tx_events""",
)
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(metrics.dataset_summary(views.tx_events(spark, sf)), fraud_rate=6)


@register(
    "class_weight",
    f"""with {TX_EVENTS}
    select count(*) filter (isFraud = 0) as n_negative, count(*) filter (isFraud = 1) as n_positive,
      {r('count(*) filter (isFraud = 0)::double / greatest(count(*) filter (isFraud = 1), 1)')} as scale_pos_weight
    from tx_events""",
)
def class_weight(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(metrics.class_weight(views.tx_events(spark, sf)), scale_pos_weight=6)


@register("confusion", f"with {CONFUSION} select tp, fp, fn, tn from m")
def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion(views.scores(spark, sf), "pa")


_REPORT = f"""{CONFUSION},
c as (select *, {div('tp', 'tp + fp')} as p1, {div('tp', 'tp + fn')} as r1,
             {div('tn', 'tn + fn')} as p0, {div('tn', 'tn + fp')} as r0,
             cast(tp + fn as double) as s1, cast(tn + fp as double) as s0 from m),
d as (select *, {div('2 * p1 * r1', 'p1 + r1')} as f1, {div('2 * p0 * r0', 'p0 + r0')} as f0, s0 + s1 as s from c)"""


@register(
    "classification_report",
    f"""with {_REPORT},
    rows_ as (
      select '0' as class, p0 as p, r0 as r, f0 as f, s0 as support from d
      union all select '1', p1, r1, f1, s1 from d
      union all select 'accuracy', (tp + tn) / s, (tp + tn) / s, (tp + tn) / s, s from d
      union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s from d
      union all select 'weighted avg', (p0 * s0 + p1 * s1) / s, (r0 * s0 + r1 * s1) / s, (f0 * s0 + f1 * s1) / s, s
        from d)
    select class, {r('p')} as precision, {r('r')} as recall, {r('f')} as f1, support from rows_""",
)
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(metrics.classification_report(views.scores(spark, sf), "pa"), precision=6, recall=6, f1=6)


@register("auc_roc", f"with {CURVE} select {r(AUC_ROC)} as auc_roc from curve")
def auc_roc(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(metrics.auc(views.scores(spark, sf), "pa").select("auc_roc"), auc_roc=6)


@register("auc_pr", f"with {CURVE} select {r(AUC_PR)} as auc_pr from curve")
def auc_pr(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(metrics.auc(views.scores(spark, sf), "pa").select("auc_pr"), auc_pr=6)


@register(
    "pr_curve",
    f"""with {CURVE}
    select {r('pa')} as threshold, {r('ctp::double / (ctp + cfp)')} as precision, {r('ctp::double / ntp')} as recall
    from curve order by pa limit 100""",
)
def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(metrics.pr_curve(views.scores(spark, sf), "pa"), threshold=6, precision=6, recall=6)


_EVALUATE = f"""{CURVE},
e as (select {AUC_PR} as auc_pr, {AUC_ROC} as auc_roc,
        coalesce(sum(tp) filter (pa >= 0.5::double), 0)::bigint as tp,
        coalesce(sum(fp) filter (pa >= 0.5::double), 0)::bigint as fp,
        coalesce(sum(tp) filter (pa < 0.5::double), 0)::bigint as fn,
        coalesce(sum(fp) filter (pa < 0.5::double), 0)::bigint as tn from curve),
f as (select *, {div('tp', 'tp + fp')} as p, {div('tp', 'tp + fn')} as r from e)"""


@register(
    "evaluate",
    f"""with {_EVALUATE}
    select {r('auc_pr')} as auc_pr, {r('auc_roc')} as auc_roc, {r('p')} as precision, {r('r')} as recall,
      {r(div('2 * p * r', 'p + r'))} as f1, {r(div('fn', 'fn + tp'))} as false_negative_rate,
      fp as false_positives, fn as false_negatives, tp as true_positives, tn as true_negatives
    from f""",
)
def evaluate(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.evaluate(views.scores(spark, sf), "pa")
    return round_columns(out, auc_pr=6, auc_roc=6, precision=6, recall=6, f1=6, false_negative_rate=6)


@register(
    "threshold_sweep",
    f"""with {SCORES},
    t(threshold) as (values {', '.join(f'({x!r}::double)' for x in metrics.SWEEP)}),
    m as (select threshold, count(*) filter (pa >= threshold and y = 1) as tp,
            count(*) filter (pa >= threshold and y = 0) as fp, count(*) filter (pa < threshold and y = 1) as fn
          from scores, t group by threshold),
    c as (select threshold, {div('tp', 'tp + fp')} as p, {div('tp', 'tp + fn')} as r from m where tp + fp > 0)
    select threshold, {r('p')} as precision, {r('r')} as recall, {r(div('2 * p * r', 'p + r'))} as f1,
      {r('(p - 0.2163::double) / 0.2163::double * 100', 4)} as improvement_pct
    from c""",
)
def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.threshold_sweep(views.scores(spark, sf), "pa")
    return round_columns(out, precision=6, recall=6, f1=6, improvement_pct=4)


@register(
    "score_distribution",
    f"""with {SCORES}
    select {r('min(pa)')} as score_min, {r('quantile_cont(pa, 0.1)')} as p10, {r('quantile_cont(pa, 0.5)')} as p50,
      {r('quantile_cont(pa, 0.9)')} as p90, {r('max(pa)')} as score_max,
      {r('avg(cast(pa > 0.4::double as integer))')} as share_gt_40,
      {r('avg(cast(pa > 0.5::double as integer))')} as share_gt_50
    from scores""",
)
def score_distribution(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.score_distribution(views.scores(spark, sf), "pa")
    return round_columns(out, **{c: 6 for c in out.columns})


@register(
    "anomaly_threshold",
    f"with {TX_EVENTS} select {r('quantile_cont(TransactionAmt, 0.95)', 4)} as threshold from tx_events where isFraud = 0",
)
def anomaly_threshold(spark: SparkSession, sf: str) -> DataFrame:
    legit = views.tx_events(spark, sf).filter(F.col("isFraud") == 0)
    return round_columns(metrics.percentile_threshold(legit, "TransactionAmt", 95.0), threshold=4)


@register(
    "model_metrics",
    f"""with {CONFUSION}
    select {r('tp::double / greatest(tp + fp, 1)')} as precision, {r('tp::double / greatest(tp + fn, 1)')} as recall,
      (select {r('avg(y)')} from scores) as fraud_rate, (select {r('avg(pa)')} from scores) as avg_score,
      tp + fp + fn + tn as n_transactions, tp + fp as n_flagged from m""",
)
def model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.model_metrics(views.scores(spark, sf), "pa")
    return round_columns(out, precision=6, recall=6, fraud_rate=6, avg_score=6)


@register(
    "batch_summary",
    f"""with {SCORES}
    select count(*) as total, count(*) filter (pa >= 0.5::double) as flagged, {r('avg(pa)')} as avg_score from scores""",
)
def batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(metrics.batch_summary(views.scores(spark, sf), "pa"), avg_score=6)


@register(
    "latency_percentiles",
    "select event_type, "
    + ", ".join(f"{r(f'quantile_cont(value, {p})', 4)} as p{int(p * 100)}" for p in (0.5, 0.75, 0.95, 0.99))
    + " from events group by event_type",
)
def latency_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.latency_percentiles(views.table(spark, sf, "events"), "value", ["event_type"])
    return round_columns(out, p50=4, p75=4, p95=4, p99=4)


@register(
    "latency_summary",
    f"""select event_type, count(*) as n_requests, {r('avg(value)', 4)} as mean, {r('min(value)', 4)} as min, {r('max(value)', 4)} as max,
      {r('count(*) * 1000.0::double / sum(value)', 4)} as per_second, """
    + ", ".join(f"{r(f'quantile_cont(value, {p})', 4)} as p{int(p * 100)}" for p in (0.5, 0.75, 0.95, 0.99))
    + " from events group by event_type",
)
def latency_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = metrics.latency_summary(views.table(spark, sf, "events"), "value", ["event_type"])
    return round_columns(out, **{c: 4 for c in ("mean", "min", "max", "per_second", "p50", "p75", "p95", "p99")})


def _long(sql: str, section: str, item: str, measures: Sequence[str]) -> str:
    """Rows (section, item, measure, value) of a query's columns."""
    return " union all ".join(f"select '{section}' as section, {item} as item, '{m}' as measure, {r(m, 4)} as value from ({sql}) x" for m in measures)


def _flat(record: DataFrame, section: str, struct: str, measures: Sequence[str], item: Column) -> DataFrame:
    """The same of a record: ``struct`` is a struct or an array of structs."""
    source = F.col(struct) if record.schema[struct].dataType.typeName() == "array" else F.array(struct)
    rows = record.select(F.explode(source).alias("x"))
    each = F.array(*[F.struct(F.lit(m).alias("measure"), rounded(F.col(f"x.{m}").cast("double"), 4).alias("value")) for m in measures])
    return rows.select(F.lit(section).alias("section"), item.alias("item"), F.explode(each).alias("m")).select("section", "item", "m.*")


_RATES = ("precision", "recall", "f1")


@register(
    "evaluation_record",
    _long(ORACLES["evaluate"], "metrics", "''", ("auc_pr", "auc_roc", *_RATES, "false_negative_rate"))
    + " union all " + _long(ORACLES["pr_curve"], "curve", "printf('%.6f', threshold)", ("precision", "recall"))
    + " union all " + _long(ORACLES["classification_report"], "report", "class", (*_RATES, "support"))
    + " union all " + _long(ORACLES["evaluate"], "confusion", "''", ("true_negatives", "false_positives", "false_negatives", "true_positives")),
)
def evaluation_record(spark: SparkSession, sf: str) -> DataFrame:
    """The whole evaluation of a model, as it is kept for a training run, in rows."""
    record = stored(reports.evaluation_record(views.scores(spark, sf), "pa"))
    whole = record.withColumn("metrics", F.struct("auc_pr", "auc_roc", *_RATES, "false_negative_rate"))
    matrix = [[("true_negatives"), ("false_positives")], [("false_negatives"), ("true_positives")]]
    whole = whole.withColumn("confusion", F.struct(*[F.col("confusion_matrix")[i][j].alias(n) for i, row in enumerate(matrix) for j, n in enumerate(row)]))
    out = _flat(whole, "metrics", "metrics", ("auc_pr", "auc_roc", *_RATES, "false_negative_rate"), F.lit(""))
    out = out.unionByName(_flat(whole, "curve", "precision_recall_curve", ("precision", "recall"), fixed(rounded(F.col("x.threshold"), 6), 6)))
    out = out.unionByName(_flat(whole, "report", "classification_report", (*_RATES, "support"), F.col("x.class")))
    return out.unionByName(_flat(whole, "confusion", "confusion", [n for row in matrix for n in row], F.lit("")))


_CALIBRATED = "1 / (1 + exp(-(9.5::double * pa - 7.0::double)))"
_SPREAD = ("score_min", "p10", "p50", "p90", "score_max", "share_gt_40", "share_gt_50")


@register(
    "calibration_record",
    _long(ORACLES["score_distribution"], "before", "''", _SPREAD)
    + " union all " + _long(ORACLES["score_distribution"].replace(f"with {SCORES}", f"with {SCORES.replace('scores as (', 'raw as (')}, scores as (select y, {_CALIBRATED} as pa from raw)"), "after", "''", _SPREAD)
    + " union all " + _long(ORACLES["threshold_sweep"].replace(f"with {SCORES}", f"with {SCORES.replace('scores as (', 'raw as (')}, scores as (select y, {_CALIBRATED} as pa from raw)"), "sweep", "printf('%.2f', threshold)", (*_RATES, "improvement_pct")),
)
def calibration_record(spark: SparkSession, sf: str) -> DataFrame:
    """The whole calibration report of a fixed Platt calibrator, in rows."""
    scores = stored(calibrate.Platt(9.5, -7.0).transform(views.scores(spark, sf), "pa", "calibrated"))
    record = stored(reports.calibration_record(scores, "pa", "calibrated", "y", "platt"))
    out = _flat(record, "before", "distribution_before", _SPREAD, F.lit(""))
    out = out.unionByName(_flat(record, "after", "distribution_after", _SPREAD, F.lit("")))
    return out.unionByName(_flat(record, "sweep", "sweep", (*_RATES, "improvement_pct"), fixed(F.col("x.threshold"), 2)))


# -- bootstrap ---------------------------------------------------------------------------------

REPLICATES = 500


def _boot_cte(score: str, name: str) -> str:
    digest = "md5(concat_ws(':', '42' || g, cast(TransactionID as varchar)))"
    bits = "cast('0x' || substr(d, 1 + 15 * (j // 3), 15) as bigint)"
    unit = f"(({bits} >> (40 - 20 * (j % 3))) & 1048575)::double / 1048576.0::double"
    return f"""{name}_d as (select {score} as s, y, g, {digest} as d from scores, range({-(-REPLICATES // 6)}) t(g)),
{name}_w as (select g * 6 + j as k, s, y, {poisson(unit)} as w from {name}_d, range(6) x(j) where g * 6 + j < {REPLICATES}),
{name}_cells as (select k, s, sum(w * y) as tp, sum(w * (1 - y)) as fp from {name}_w group by k, s),
{name}_curve as (select k, tp, fp, sum(tp) over o as ctp, sum(fp) over o as cfp,
    sum(tp) over (partition by k) as ntp from {name}_cells window o as (partition by k order by s desc)),
{name}_ap as (select k, sum(coalesce(tp::double / nullif(ntp, 0) * ctp / nullif(ctp + cfp, 0), 0)) as ap
    from {name}_curve group by k)"""


@register(
    "bootstrap_ci",
    f"""with {SCORES}, {_boot_cte('pa', 'a')}
    select {r('quantile_cont(ap, 0.025)')} as ci_low, {r('quantile_cont(ap, 0.975)')} as ci_high,
      count(*) as replicates from a_ap""",
)
def bootstrap_ci(spark: SparkSession, sf: str) -> DataFrame:
    out = bootstrap.bootstrap_ci(views.scores(spark, sf), "pa", replicates=REPLICATES)
    return round_columns(out, ci_low=6, ci_high=6)


@register(
    "bootstrap_significance",
    f"""with {SCORES}, {_boot_cte('pb', 'a')}, {_boot_cte('pa', 'b')}
    select {r('avg(cast(b_ap.ap - a_ap.ap <= 0 as integer))')} as p_value,
      cast(avg(cast(b_ap.ap - a_ap.ap <= 0 as integer)) < 0.05::double as integer) as significant,
      count(*) as replicates
    from a_ap join b_ap on a_ap.k = b_ap.k""",
)
def bootstrap_significance(spark: SparkSession, sf: str) -> DataFrame:
    out = bootstrap.bootstrap_significance(views.scores(spark, sf), "pb", "pa", replicates=REPLICATES)
    return round_columns(out, p_value=6).withColumn("significant", F.col("significant").cast("int"))


# Both models at two thresholds stand for the variants of an ablation.
_VARIANTS = (("pa_50", "pa", 0.5), ("pb_50", "pb", 0.5), ("pb_40", "pb", 0.4))


@register(
    "ablation_summary",
    f"""with {SCORES}, v as ("""
    + " union all ".join(
        f"""select '{n}' as variant, {div(f'count(*) filter ({s} >= {t}::double and y = 1)', f'count(*) filter ({s} >= {t}::double)')} as p,
      {div(f'count(*) filter ({s} < {t}::double and y = 1)', 'count(*) filter (y = 1)')} as f from scores"""
        for n, s, t in _VARIANTS
    )
    + f"""),
    b as (select max(p) filter (variant = 'pa_50') as p, max(f) filter (variant = 'pa_50') as f,
      max(p) filter (variant <> 'pa_50') as bp, min(f) filter (variant <> 'pa_50') as bf from v)
    select {r('bp')} as best_baseline_precision, {r('bf')} as best_baseline_fnr,
      {r('(p - bp) / greatest(bp, 1e-6) * 100', 4)} as precision_improvement_pct,
      {r('(bf - f) / greatest(bf, 1e-6) * 100', 4)} as fnr_reduction_pct from b""",
)
def ablation_summary(spark: SparkSession, sf: str) -> DataFrame:
    df = views.scores(spark, sf)
    table = None
    for name, score, threshold in _VARIANTS:
        c = metrics.confusion(df, score, threshold=threshold)
        rates = metrics.rates(*[F.col(x) for x in ("tp", "fp", "fn", "tn")])
        one = c.select(F.lit(name).alias("variant"), *[e.alias(n) for n, e in rates.items()])
        table = one if table is None else table.unionByName(one)
    out = metrics.ablation_summary(table, "pa_50", ["pb_50", "pb_40"])
    return round_columns(
        out,
        best_baseline_precision=6,
        best_baseline_fnr=6,
        precision_improvement_pct=4,
        fnr_reduction_pct=4,
    )


# -- splits and samples ------------------------------------------------------------------------

_RANKED = f"""{TX_EVENTS},
ranked as (select *, row_number() over (partition by isFraud order by {u('42', 'TransactionID', 13)}, TransactionID) - 1
             as rk, count(*) over (partition by isFraud) as n from tx_events),
f as (select count(*) filter (isFraud = 1) as fraud, count(*) filter (isFraud = 0) as legit, count(*) as total
      from tx_events)"""


@register(
    "stratified_split",
    f"""with {_RANKED}
    select TransactionID, isFraud, cast(rk < ceil(0.8::double * n - 1e-9) as integer) as is_train from ranked""",
)
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    out = sampling.stratified_split(views.tx_events(spark, sf).select("TransactionID", "isFraud"))
    return out.withColumn("is_train", F.col("is_train").cast("int"))


@register(
    "calibration_split",
    f"""with {_RANKED}
    select TransactionID, isFraud, cast(rk < ceil(0.4::double * n - 1e-9) as integer) as is_calibration from ranked""",
)
def calibration_split(spark: SparkSession, sf: str) -> DataFrame:
    out = sampling.stratified_split(views.tx_events(spark, sf).select("TransactionID", "isFraud"), 0.4)
    return out.select("TransactionID", "isFraud", F.col("is_train").cast("int").alias("is_calibration"))


@register(
    "hash_split",
    f"""with {TX_EVENTS}
    select TransactionID, cast({u('42', 'TransactionID', 13)} < 0.85::double as integer) as is_train from tx_events""",
)
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    out = sampling.hash_split(views.tx_events(spark, sf).select("TransactionID"), 0.85)
    return out.withColumn("is_train", F.col("is_train").cast("int"))


@register("kfold_assign", f"with {_RANKED} select TransactionID, isFraud, cast(rk % 5 as integer) as fold from ranked")
def kfold_assign(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.kfold(views.tx_events(spark, sf).select("TransactionID", "isFraud"))


@register(
    "stratified_sample",
    f"""with {_RANKED}
    select TransactionID, isFraud from ranked, f
    where rk < case when isFraud = 1 then least(100, fraud) else 1000 - least(100, fraud) end""",
)
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_sample(views.tx_events(spark, sf).select("TransactionID", "isFraud"), 1000)


@register(
    "shap_sample",
    f"""with {_RANKED},
    g as (select least(fraud, cast(trunc(1000 * (fraud::double / greatest(total, 1)) * 3) as bigint)) as nf, legit from f)
    select TransactionID, isFraud from ranked, g
    where rk < case when isFraud = 1 then nf else least(legit, 1000 - nf) end""",
)
def shap_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.importance_sample(views.tx_events(spark, sf).select("TransactionID", "isFraud"), 1000)


@register(
    "uniform_sample",
    f"""with {TX_EVENTS}
    select TransactionID, TransactionAmt from tx_events
    order by {u('42', 'TransactionID', 13)}, TransactionID limit 1000""",
)
def uniform_sample(spark: SparkSession, sf: str) -> DataFrame:
    df = views.tx_events(spark, sf).select("TransactionID", "TransactionAmt")
    return sampling.first_by_hash(df, "42", 1000)
