"""Classification metrics, exact curves, and score summaries over (label, score) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.numeric import ratio
from riskspark.operators.ranking import cumulative, exact_percentiles


def dataset_summary(df: DataFrame, label: str = "isFraud") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("n_fraud"),
        F.coalesce(F.avg(label), F.lit(0.0)).alias("fraud_rate"),
    )


def class_weight(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """Negatives per positive, the weight of a positive row in cost-sensitive training."""
    pos = F.count(F.when(F.col(label) == 1, 1))
    neg = F.count(F.when(F.col(label) == 0, 1))
    return df.agg(
        neg.alias("n_negative"),
        pos.alias("n_positive"),
        (neg.cast("double") / F.greatest(pos, F.lit(1)).cast("double")).alias("scale_pos_weight"),
    )


def _counts(label: Column, score: Column, threshold: Column) -> dict[str, Column]:
    pred, pos = score >= threshold, label == 1

    def n(cond: Column) -> Column:
        return F.count(F.when(cond, F.lit(1)))

    return {"tp": n(pred & pos), "fp": n(pred & ~pos), "fn": n(~pred & pos), "tn": n(~pred & ~pos)}


def confusion(
    df: DataFrame, score: str, label: str = "y", threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    counts = [c.alias(n) for n, c in _counts(F.col(label), F.col(score), F.lit(threshold)).items()]
    return df.groupBy(*by).agg(*counts) if by else df.agg(*counts)


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Empty denominators give 0."""
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {
        "precision": precision,
        "recall": recall,
        "f1": ratio(2 * precision * recall, precision + recall),
        "false_negative_rate": ratio(fn, fn + tp),
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
    }


def classification_report(df: DataFrame, score: str, label: str = "y", threshold: float = 0.5) -> DataFrame:
    """Rows 0, 1, accuracy, macro avg and weighted avg with precision, recall, f1 and support."""
    c = confusion(df, score, label, threshold)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    one, zero = rates(tp, fp, fn, tn), rates(tn, fn, fp, tp)
    support1, support0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    total = support0 + support1

    def row(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.alias("support")
        )

    def mean(m: str, w0: Column, w1: Column) -> Column:
        return ratio(zero[m] * w0 + one[m] * w1, w0 + w1)

    names = ("precision", "recall", "f1")
    half = F.lit(1.0)
    rows = [
        row("0", *[zero[m] for m in names], support0),
        row("1", *[one[m] for m in names], support1),
        row("accuracy", *[one["accuracy"]] * 3, total),
        row("macro avg", *[mean(m, half, half) for m in names], total),
        row("weighted avg", *[mean(m, support0, support1) for m in names], total),
    ]
    return c.select(F.inline(F.array(*rows)))


def _curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    tp = (F.col(label) == 1).cast("bigint")
    return cumulative(df, score, {"tp": tp, "fp": 1 - tp}, by, descending=True)


def _average_precision(tp: str, fp: str) -> Column:
    """Sum over distinct thresholds of recall step times precision."""
    return F.expr(
        f"sum(coalesce(try_divide(double({tp}), total_{tp}), 0D) "
        f"* coalesce(try_divide(double(cum_{tp}), cum_{tp} + cum_{fp}), 0D))"
    )


def _roc_area(tp: str, fp: str) -> Column:
    """Share of (positive, negative) pairs in the right order; ties count half."""
    return F.expr(
        f"sum(coalesce(try_divide(double({fp}), total_{fp}), 0D) "
        f"* coalesce(try_divide(double(cum_{tp} - {tp}) + double({tp}) / 2D, total_{tp}), 0D))"
    )


def auc(df: DataFrame, score: str, label: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """Exact ``auc_pr`` and ``auc_roc`` from one pass over the distinct scores."""
    curve = _curve(df, score, label, by)
    both = [_average_precision("tp", "fp").alias("auc_pr"), _roc_area("tp", "fp").alias("auc_roc")]
    return curve.groupBy(*by).agg(*both) if by else curve.agg(*both)


def pr_curve(df: DataFrame, score: str, label: str = "y", points: int = 100) -> DataFrame:
    """The ``points`` lowest thresholds with their precision and recall."""
    curve = _curve(df, score, label)
    return (
        curve.orderBy(score)
        .limit(points)
        .select(
            F.col(score).alias("threshold"),
            ratio(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp")).alias("precision"),
            ratio(F.col("cum_tp"), F.col("total_tp")).alias("recall"),
        )
    )


def evaluate(df: DataFrame, score: str, label: str = "y", threshold: float = 0.5) -> DataFrame:
    """One row with AUCs, precision, recall, F1, FNR and the confusion counts.

    Counts at the threshold come out of the same distinct-score cells as the AUCs.
    """
    curve = _curve(df, score, label)
    at = F.col(score) >= threshold

    def n(name: str, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col(name))), F.lit(0))

    c = curve.agg(
        _average_precision("tp", "fp").alias("auc_pr"),
        _roc_area("tp", "fp").alias("auc_roc"),
        n("tp", at).alias("tp"),
        n("fp", at).alias("fp"),
        n("tp", ~at).alias("fn"),
        n("fp", ~at).alias("tn"),
    )
    r = rates(*[F.col(x) for x in ("tp", "fp", "fn", "tn")])
    return c.select(
        "auc_pr",
        "auc_roc",
        *[r[m].alias(m) for m in ("precision", "recall", "f1", "false_negative_rate")],
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.col("tp").alias("true_positives"),
        F.col("tn").alias("true_negatives"),
    )


# Thresholds of the sweep and the precision it is compared with (fixed values).
SWEEP = tuple(round(0.30 + 0.05 * i, 2) for i in range(11))
SWEEP_BASELINE_PRECISION = 0.2163


def threshold_sweep(
    df: DataFrame,
    score: str,
    label: str = "y",
    thresholds: Sequence[float] = SWEEP,
    baseline_precision: float = SWEEP_BASELINE_PRECISION,
) -> DataFrame:
    """Precision, recall and F1 per threshold, and the precision change against a baseline in percent.

    One scan: every threshold is a set of conditional counts, unpivoted afterwards. Thresholds that
    flag nothing are left out.
    """
    aggs = []
    for i, t in enumerate(thresholds):
        counts = _counts(F.col(label), F.col(score), F.lit(float(t)))
        aggs.append(F.struct(F.lit(float(t)).alias("threshold"), *[c.alias(n) for n, c in counts.items()]).alias(f"t{i}"))
    wide = df.agg(*aggs)
    long = wide.select(F.inline(F.array(*[F.col(f"t{i}") for i in range(len(thresholds))])))
    r = rates(*[F.col(x) for x in ("tp", "fp", "fn", "tn")])
    base = F.lit(baseline_precision)
    return long.filter(F.col("tp") + F.col("fp") > 0).select(
        "threshold",
        *[r[m].alias(m) for m in ("precision", "recall", "f1")],
        ((r["precision"] - base) / base * 100).alias("improvement_pct"),
    )


def score_distribution(df: DataFrame, score: str) -> DataFrame:
    """Exact min, p10, p50, p90, max and the shares above 0.4 and 0.5."""
    names = ("score_min", "p10", "p50", "p90", "score_max")
    found = exact_percentiles(df, score, (0.0, 0.1, 0.5, 0.9, 1.0)).scalar()

    def share(t: float) -> Column:
        return F.avg((F.col(score) > t).cast("double"))

    out = df.agg(share(0.4).alias("share_gt_40"), share(0.5).alias("share_gt_50")).withColumn("_p", found)
    return out.select(*[F.col("_p")[i].alias(n) for i, n in enumerate(names)], "share_gt_40", "share_gt_50")


def percentile_threshold(df: DataFrame, value: str, percent: float = 95.0) -> DataFrame:
    """The cut-off above which a value counts as anomalous."""
    return exact_percentiles(df, value, [percent / 100]).select(F.col("percentiles")[0].alias("threshold"))


def model_metrics(df: DataFrame, score: str = "score", label: str = "y", threshold: float = 0.5) -> DataFrame:
    """Metrics of a scored window; unlabelled rows count for the averages only."""
    c = _counts(F.col(label), F.col(score), F.lit(threshold))
    flagged = F.count(F.when(F.col(score) >= threshold, 1))
    return df.agg(
        ratio(c["tp"], F.greatest(c["tp"] + c["fp"], F.lit(1))).alias("precision"),
        ratio(c["tp"], F.greatest(c["tp"] + c["fn"], F.lit(1))).alias("recall"),
        F.coalesce(F.avg(label), F.lit(0.0)).alias("fraud_rate"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("avg_score"),
        F.count(F.lit(1)).alias("n_transactions"),
        flagged.alias("n_flagged"),
    )


def batch_summary(df: DataFrame, score: str, threshold: float = 0.5) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col(score) >= threshold, 1)).alias("flagged"),
        F.avg(score).alias("avg_score"),
    )


def failure_rate(df: DataFrame, error: str = "error_type") -> DataFrame:
    failed, total = F.count(error), F.count(F.lit(1))
    return df.agg(
        (total - failed).alias("processed"),
        failed.alias("failed"),
        ratio(failed, total).alias("failure_rate"),
    )


def latency_percentiles(df: DataFrame, latency: str, by: Sequence[str] = ()) -> DataFrame:
    out = exact_percentiles(df, latency, [0.5, 0.75, 0.95, 0.99], by)
    names = ("p50", "p75", "p95", "p99")
    return out.select(*by, *[F.col("percentiles")[i].alias(n) for i, n in enumerate(names)])


def latency_summary(df: DataFrame, latency: str, by: Sequence[str] = ()) -> DataFrame:
    """Percentiles, mean, extremes, number of requests and requests per second of latencies in milliseconds, one request
    after the other."""
    values = df.filter(F.col(latency).isNotNull())
    about = [
        F.count(F.lit(1)).alias("n_requests"), F.avg(latency).alias("mean"), F.min(latency).alias("min"), F.max(latency).alias("max"),
        F.try_divide(F.count(F.lit(1)) * F.lit(1000.0), F.sum(latency)).alias("per_second"),
    ]
    percentiles = latency_percentiles(values, latency, by)
    if by:
        return values.groupBy(*by).agg(*about).join(percentiles, list(by))
    row = percentiles.select(F.struct(*percentiles.columns)).scalar()
    return values.agg(*about).withColumn("_p", row).select("*", "_p.*").drop("_p")


def ablation_summary(
    metrics: DataFrame, subject: str, baselines: Sequence[str], variant: str = "variant"
) -> DataFrame:
    """Precision gain and false-negative cut of one variant against the best of the baselines."""
    mine, base = F.col(variant) == subject, F.col(variant).isin(list(baselines))
    tiny = F.lit(1e-6)
    out = metrics.agg(
        F.max(F.when(mine, F.col("precision"))).alias("p"),
        F.max(F.when(mine, F.col("false_negative_rate"))).alias("f"),
        F.max(F.when(base, F.col("precision"))).alias("bp"),
        F.min(F.when(base, F.col("false_negative_rate"))).alias("bf"),
    )
    return out.select(
        F.col("bp").alias("best_baseline_precision"),
        F.col("bf").alias("best_baseline_fnr"),
        ((F.col("p") - F.col("bp")) / F.greatest(F.col("bp"), tiny) * 100).alias("precision_improvement_pct"),
        ((F.col("bf") - F.col("f")) / F.greatest(F.col("bf"), tiny) * 100).alias("fnr_reduction_pct"),
    )
