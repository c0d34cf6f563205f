"""Distribution and performance drift between a baseline and a current set of scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.functions.numeric import ratio
from riskspark.functions.text import fill, fixed
from riskspark.operators.ranking import column_percentiles, cumulative, exact_percentiles, interpolated, percentile_cells, percentile_picks
from riskspark.session import stored

# Limits of the checks and the sentences of their alerts (fixed values). Numbers in braces have that many decimals.
KS_P = 0.01
KS_THRESHOLD = 0.05
KS_CRITICAL = 0.2
PSI_THRESHOLD = 0.2
PSI_CRITICAL = 0.25
METRIC_DROP = 0.05
METRIC_DROP_CRITICAL = 0.1
MIN_SCORES = 100
EMPTY_SHARE = 1e-6
KS_TEXT = "Score distribution drift detected (KS={value}, p={p}). Model may need retraining."
PSI_TEXT = "PSI={value} ≥ 0.2. Score distribution has shifted significantly."
PRECISION_TEXT = "Precision dropped from {base} to {value} (Δ={by} > threshold=0.05)"
RECALL_TEXT = "Recall dropped from {base} to {value} (Δ={by} > threshold=0.05)"


@dataclass(frozen=True)
class Rule:
    """One check of a row of measures: an alert is raised where ``fires`` holds, critical where ``critical`` does."""

    metric: str
    value: str
    base: str
    limit: float
    fires: str
    critical: str
    text: str


#: What an alert may be raised for, as conditions over ``MEASURES``.
RULES = (
    Rule("score_distribution_ks", "ks_stat", "0D", KS_THRESHOLD, f"p_value < {KS_P}D", f"ks_stat >= {KS_CRITICAL}D", KS_TEXT),
    Rule("score_psi", "psi", "0D", PSI_THRESHOLD, f"psi >= {PSI_THRESHOLD}D", f"psi >= {PSI_CRITICAL}D", PSI_TEXT),
    *(
        Rule(
            f"{name}_drift",
            f"cur_{name}",
            f"base_{name}",
            METRIC_DROP,
            f"cur_labelled > 0 and base_{name} - cur_{name} > {METRIC_DROP}D",
            f"base_{name} - cur_{name} > {METRIC_DROP_CRITICAL}D",
            text,
        )
        for name, text in (("precision", PRECISION_TEXT), ("recall", RECALL_TEXT))
    ),
)
MEASURES = ("n_baseline", "n_current", "ks_stat", "p_value", "psi", "base_precision", "cur_precision", "base_recall", "cur_recall", "cur_labelled")


def alerts_of(measures: DataFrame, keep: Sequence[str] = (), rules: Sequence[Rule] = RULES, min_scores: int = MIN_SCORES) -> DataFrame:
    """The alerts of each row of measures, a table or a stream: ``keep``, metric, current_value, baseline_value, threshold,
    severity, message. None below ``min_scores`` current scores or without a baseline."""
    raised = []
    for rule in rules:
        value, base = F.expr(rule.value), F.expr(rule.base)
        numbers = {"value": value, "base": base, "by": base - value, "p": F.col("p_value")}
        alert = F.struct(
            F.lit(rule.metric).alias("metric"),
            value.alias("current_value"),
            base.alias("baseline_value"),
            F.lit(rule.limit).alias("threshold"),
            F.when(F.expr(rule.critical), F.lit("critical")).otherwise(F.lit("warning")).alias("severity"),
            fill(rule.text, {name: fixed(x, 4) for name, x in numbers.items()}).alias("message"),
        )
        raised.append(F.when(F.expr(rule.fires), alert))
    enough = measures.filter((F.col("n_current") >= min_scores) & (F.col("n_baseline") > 0))
    return enough.select(*keep, F.explode(F.array_compact(F.array(*raised))).alias("a")).select(*keep, "a.*")


def sides(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both tables in one, told apart by ``current`` (0 or 1)."""
    return (
        baseline.select(*columns)
        .withColumn("current", F.lit(0))
        .unionByName(current.select(*columns).withColumn("current", F.lit(1)))
    )


# -- PSI ---------------------------------------------------------------------------------------


def psi_edges(baseline: DataFrame, value: str, bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Inner bin edges: the baseline's exact percentiles without both ends, which are infinite."""
    return exact_percentiles(baseline, value, [i / bins for i in range(1, bins)], by)


def _edge_list(baseline: DataFrame, value: str, bins: int) -> list[float]:
    """The edges as numbers, so that the table is binned by plain comparisons."""
    return [e for e in psi_edges(baseline, value, bins).first()[0] if e is not None]


def _bin(value: Column, edges: Sequence[Column | float]) -> Column:
    """Bins are closed on the left, so the number of edges at or below the value is the bin."""
    return sum(((value >= e).cast("int") for e in edges), F.lit(0))


def _psi_of(bins_table: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    """``bins_table`` has one row per (by, bin) with the counts ``b`` (baseline) and ``c`` (current).

    Counts and shares are arrays, which keeps the expression small however often the result is used.
    """

    def counts(side: str) -> Column:
        each = ", ".join(f"coalesce(sum(if(bin = {i}, {side}, 0)), 0)" for i in range(bins))
        return F.expr(f"array({each}) as {side}")

    wide = bins_table.groupBy(*by).agg(counts("b"), counts("c")) if by else bins_table.agg(counts("b"), counts("c"))
    return _index(wide, by)


def _index(wide: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by``, psi, n_baseline, n_current of rows with the counts of all bins as arrays ``b`` and ``c``."""
    keys = [f"`{c}`" for c in by]
    sized = wide.selectExpr(
        *keys, "b", "c", *[f"aggregate({s}, 0L, (a, x) -> a + x) as {n}" for s, n in (("b", "n_baseline"), ("c", "n_current"))]
    )
    share = "transform({s}, x -> if(x = 0, {e!r}D, x / double({n}))) as {s}"
    shares = sized.selectExpr(
        *keys,
        *[share.format(s=s, e=EMPTY_SHARE, n=n) for s, n in (("b", "n_baseline"), ("c", "n_current"))],
        "n_baseline",
        "n_current",
    )
    index = "aggregate(zip_with(b, c, (p, q) -> (q - p) * ln(q / p)), 0D, (a, x) -> a + x) as psi"
    return shares.selectExpr(*keys, index, "n_baseline", "n_current")


def monitor_cells(baseline: DataFrame, current: DataFrame, score: str = "score", label: str | None = None) -> DataFrame:
    """One stored row per distinct score with running counts of both sides.

    KS, PSI and the performance metrics all follow from it, so the two tables are read once for the
    bucket sketch and once for the counts.
    """
    columns = [score] if label is None else [score, label]
    both = sides(baseline, current, columns).filter(F.col(score).isNotNull())
    sums: dict[str, Column] = {}
    for name, side in (("b", 0), ("c", 1)):
        mine = F.col("current") == side
        sums[name] = mine.cast("bigint")
        if label is not None:
            sums[f"{name}_pos"] = F.coalesce(mine & (F.col(label) == 1), F.lit(False)).cast("bigint")
            sums[f"{name}_known"] = (mine & F.col(label).isNotNull()).cast("bigint")
    return stored(cumulative(both, score, sums))


def psi(baseline: DataFrame, current: DataFrame, value: str = "score", bins: int = 10) -> DataFrame:
    """Population stability index: one row with psi, n_baseline, n_current."""
    return psi_of(monitor_cells(baseline, current, value), value, bins)


def psi_of(cells: DataFrame, value: str = "score", bins: int = 10) -> DataFrame:
    inner = [i / bins for i in range(1, bins)]
    picked = percentile_cells(cells, inner, "b").agg(*percentile_picks(value, inner, "b"))
    found = picked.select(*[interpolated(i) for i in range(len(inner))])
    edges = [e for e in found.first() if e is not None]  # ``bins - 1`` numbers
    binned = cells.select("b", "c", _bin(F.col(value), edges).alias("bin"))
    return _psi_of(binned.groupBy("bin").agg(F.sum("b").alias("b"), F.sum("c").alias("c")), (), bins)


def feature_psi(baseline: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """PSI of every feature: feature, psi, n_baseline, n_current. The edges are numbers of the plan, and each table is
    counted in one wide aggregate, without multiplying or moving its rows."""
    edges = column_percentiles(baseline, features, [i / bins for i in range(1, bins)])

    def counted(df: DataFrame) -> Column:
        per_feature = []
        for c in features:
            at = _bin(F.col(c).cast("double"), edges[c])
            per_feature.append(F.array(*[F.count(F.when(F.col(c).isNotNull() & (at == i), F.lit(1))) for i in range(bins)]))
        return df.agg(F.array(*per_feature).alias("counts")).scalar()

    names = F.array(*[F.lit(c) for c in features])
    wide = baseline.sparkSession.range(1).select(names.alias("feature"), counted(baseline).alias("b"), counted(current).alias("c"))
    return _index(wide.select(F.explode(F.arrays_zip("feature", "b", "c")).alias("x")).select("x.*"), ["feature"])


def psi_by(baseline: DataFrame, current: DataFrame, by: str, value: str = "score", bins: int = 10) -> DataFrame:
    """PSI of each group of the current table against the whole baseline."""
    edges = _edge_list(baseline, value, bins)
    at = _bin(F.col(value), edges).alias("bin")
    base = baseline.filter(F.col(value).isNotNull()).groupBy(at).agg(F.count(F.lit(1)).alias("b"))
    mine = current.filter(F.col(value).isNotNull()).groupBy(by, at).agg(F.count(F.lit(1)).alias("c"))
    # One row per group carries the baseline's counts, at most ``bins`` of them.
    listed = base.agg(F.collect_list(F.struct("bin", "b"))).scalar()
    carried = mine.groupBy(by).agg(F.first(listed).alias("base")).select(by, F.inline("base"))
    both = mine.withColumn("b", F.lit(0)).unionByName(carried.withColumn("c", F.lit(0)))
    return _psi_of(both, [by], bins).select(by, "n_current", "psi")


# -- Kolmogorov-Smirnov ------------------------------------------------------------------------


def ks_p_value(stat: Column, n: Column, m: Column) -> Column:
    """Two-sided asymptotic p-value with the effective sample size n*m/(n+m)."""
    size = ratio(n.cast("double") * m.cast("double"), (n + m).cast("double"))
    lam = stat * F.sqrt(size)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    # Below 0.2 the series converges too slowly and the value is 1 to twelve digits.
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * series)))


def ks_test(baseline: DataFrame, current: DataFrame, value: str = "score") -> DataFrame:
    """One row with ks_stat, p_value, n_baseline, n_current."""
    return ks_of(monitor_cells(baseline, current, value))


def ks_of(cells: DataFrame) -> DataFrame:
    gap = F.abs(ratio(F.col("cum_b"), F.col("total_b")) - ratio(F.col("cum_c"), F.col("total_c")))
    out = cells.agg(
        F.coalesce(F.max(gap), F.lit(0.0)).alias("ks_stat"),
        F.coalesce(F.max("total_b"), F.lit(0)).alias("n_baseline"),
        F.coalesce(F.max("total_c"), F.lit(0)).alias("n_current"),
    )
    p = ks_p_value(F.col("ks_stat"), F.col("n_baseline"), F.col("n_current"))
    return out.select("ks_stat", p.alias("p_value"), "n_baseline", "n_current")


def ks_by(baseline: DataFrame, current: DataFrame, by: str, value: str = "score") -> DataFrame:
    """KS of each group against the whole baseline, without copying the baseline per group.

    Between two neighbouring points of a group its own curve is flat and the baseline's rises, so the
    largest gap is found at the group's points, taken from both sides.
    """
    group = current.filter(F.col(value).isNotNull())
    points = baseline.filter(F.col(value).isNotNull()).select(value, F.lit(1).alias("n"))
    points = points.unionByName(group.select(value, F.lit(0).alias("n")))
    base = cumulative(points, value, {"b": F.col("n")})
    mine = cumulative(group, value, {"c": F.lit(1)}, by=[by])
    both = mine.join(base, value)
    at = F.abs(ratio(F.col("cum_b"), F.col("total_b")) - ratio(F.col("cum_c"), F.col("total_c")))
    left = F.abs(
        ratio(F.col("cum_b") - F.col("b"), F.col("total_b")) - ratio(F.col("cum_c") - F.col("c"), F.col("total_c"))
    )
    out = both.groupBy(by).agg(
        F.max(F.greatest(at, left)).alias("ks_stat"), F.max("total_b").alias("nb"), F.max("total_c").alias("nc")
    )
    return out.select(by, "ks_stat", ks_p_value(F.col("ks_stat"), F.col("nb"), F.col("nc")).alias("p_value"))


# -- performance, alerts, status ---------------------------------------------------------------


def side_metrics(cells: DataFrame, score: str, threshold: float) -> DataFrame:
    """Precision, recall and sizes of both sides as one row; unlabelled rows count for the sizes only."""
    at = F.col(score) >= threshold

    def n(name: str, flagged: bool = False) -> Column:
        counted = F.when(at, F.col(name)) if flagged else F.col(name)
        return F.coalesce(F.sum(counted), F.lit(0))

    one = F.lit(1)
    aggs = []
    for side, name in (("b", "base"), ("c", "cur")):
        tp = n(f"{side}_pos", flagged=True)
        aggs += [
            ratio(tp, F.greatest(n(f"{side}_known", flagged=True), one)).alias(f"{name}_precision"),
            ratio(tp, F.greatest(n(f"{side}_pos"), one)).alias(f"{name}_recall"),
            n(side).alias(f"{name}_n"),
            n(f"{side}_known").alias(f"{name}_labelled"),
            ratio(n(side, flagged=True), n(side)).alias(f"{name}_flagged_share"),
            ratio(F.sum(F.col(score) * F.col(side)), n(side)).alias(f"{name}_avg_score"),
        ]
    return cells.agg(*aggs)


def measures(baseline: DataFrame, current: DataFrame, score: str = "score", label: str | None = "y", threshold: float = 0.5) -> DataFrame:
    """``MEASURES`` of two tables as one row. Labelled and unlabelled rows may be mixed: precision and recall use the
    labelled ones. Without ``label`` there are none."""
    cells = monitor_cells(baseline, current, score, label)
    performance = ("base_precision", "cur_precision", "base_recall", "cur_recall", "cur_labelled")
    if label is None:
        known = cells.sparkSession.range(1).select(*[F.lit(0.0).alias(n) for n in performance])
    else:
        known = side_metrics(cells, score, threshold)
    of = {"psi": psi_of(cells, score).select("psi").scalar(), "known": known.select(F.struct(*performance)).scalar()}
    return ks_of(cells).withColumns(of).select("*", "known.*").select(*MEASURES)


def drift_alerts(
    baseline: DataFrame,
    current: DataFrame,
    score: str = "score",
    label: str | None = "y",
    threshold: float = 0.5,
    min_scores: int = MIN_SCORES,
) -> DataFrame:
    """Alert rows: metric, current_value, baseline_value, threshold, severity, message."""
    return alerts_of(measures(baseline, current, score, label, threshold), min_scores=min_scores)


def drift_summary(baseline: DataFrame, window: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """Status row of a monitored window next to the baseline's precision and recall."""
    m = side_metrics(monitor_cells(baseline, window, score, label), score, 0.5)
    has_baseline = F.col("base_n") > 0
    return m.select(
        F.col("cur_n").alias("window_size"),
        F.col("cur_avg_score").alias("avg_fraud_score"),
        F.col("cur_flagged_share").alias("fraud_rate"),
        has_baseline.alias("baseline_set"),
        F.when(has_baseline, F.col("base_precision")).alias("baseline_precision"),
        F.when(has_baseline, F.col("base_recall")).alias("baseline_recall"),
    )


def drift_status(summary: DataFrame, alerts: DataFrame) -> DataFrame:
    """The status row with its alerts (at most one per metric) as an array."""
    listed = alerts.agg(F.array_sort(F.collect_list(F.struct(*alerts.columns)))).scalar()
    return summary.withColumn("alerts", listed)


def last_n(df: DataFrame, n: int = 1000, time: str = "event_time", key: str = "TransactionID") -> DataFrame:
    """The newest ``n`` rows: per-task top-n and a merge."""
    return df.orderBy(F.col(time).desc(), F.col(key).desc()).limit(n)


# -- alert cooldown ----------------------------------------------------------------------------


def cooldown(alerts: DataFrame, key: str = "metric", time: str = "event_time", seconds: int = 3600) -> DataFrame:
    """(key, time) of the alerts to send: the first one, then each first one at least ``seconds``
    after the last one sent.

    The chain is followed by pointer doubling, which no key can turn into one large task.
    """
    times = stored(alerts.filter(F.col(time).isNotNull()).select(key, F.unix_micros(time).alias("us")).distinct())
    return _cooldown_doubling(times, key, seconds * 1_000_000).select(key, F.timestamp_micros("us").alias(time))


def _cooldown_doubling(times: DataFrame, key: str, gap: int) -> DataFrame:
    """Each alert points to the first one at least ``gap`` later; follow the pointers from the first
    alert, doubling the stride every round, so rounds grow with the logarithm of the chain."""
    # A record with shift 0 is an alert, one with shift 1 asks for the first alert from there on.
    records = times.withColumn("ask", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        key,
        "us",
        "ask",
        (F.col("us") + F.col("ask") * gap).alias("at"),
        F.floor((F.col("us") + F.col("ask") * gap) / gap).alias("slot"),
    )
    alert_at = F.when(F.col("ask") == 0, F.col("at"))
    since = W.partitionBy(key, "slot").orderBy(F.col("at").desc()).rangeBetween(W.unboundedPreceding, W.currentRow)
    later = W.partitionBy(key).orderBy(F.col("slot").desc()).rowsBetween(W.unboundedPreceding, -1)
    # One row per key and cooldown span, however many alerts there are.
    slots = (
        records.groupBy(key, "slot")
        .agg(F.min(alert_at).alias("first"))
        .select(key, "slot", F.last("first", ignorenulls=True).over(later).alias("after"))
    )
    jump = stored(
        records.withColumn("inside", F.min(alert_at).over(since))
        .filter(F.col("ask") == 1)
        .join(slots, [key, "slot"])
        .select(key, "us", F.coalesce("inside", "after").alias("to"))
        .filter(F.col("to").isNotNull())
    )
    reached = stored(times.groupBy(key).agg(F.min("us").alias("us")))
    while not jump.isEmpty():
        following = reached.join(jump, [key, "us"]).select(key, F.col("to").alias("us"))
        reached = stored(reached.unionByName(following))
        ahead = jump.select(key, F.col("us").alias("to"), F.col("to").alias("far"))
        jump = stored(jump.join(ahead, [key, "to"]).select(key, "us", F.col("far").alias("to")))
    return reached
