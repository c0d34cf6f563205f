"""Registered queries: drift statistics, alerts, monitoring, attribution, tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators import attribution, drift
from riskspark.plans.oracle import SCORES, SIDES, TX_EVENTS, r
from riskspark.plans.registry import register, round_columns
from riskspark.sources import views
from riskspark.sources.views import BASELINE_END
from riskspark.streaming import enrich

_EDGES = "list_value(" + ", ".join(f"quantile_cont(score, {i / 10!r})" for i in range(1, 10)) + ")"

def _bin(value: str = "score") -> str:
    return "(" + " + ".join(f"cast({value} >= e[{i}] as integer)" for i in range(1, 10)) + ")"


PSI = f"""edges as (select {_EDGES} as e from baseline),
binned as (
  select 0 as side, {_bin()} as bin from baseline, edges
  union all select 1, {_bin()} from current_scores, edges),
shares as (
  select i as bin,
    count(*) filter (side = 0)::double / (select count(*) from baseline) as b,
    count(*) filter (side = 1)::double / (select count(*) from current_scores) as c
  from range(10) t(i) left join binned on bin = i group by i),
psi_row as (
  select sum((case when c = 0 then 1e-6 else c end - case when b = 0 then 1e-6 else b end)
    * ln(case when c = 0 then 1e-6 else c end / case when b = 0 then 1e-6 else b end)) as psi from shares)"""


def ks_p(stat: str, n: str, m: str) -> str:
    lam = f"({stat} * sqrt({n}::double * {m}::double / ({n} + {m})))"
    series = (
        f"(select sum(case when k % 2 = 1 then 1.0::double else -1.0::double end "
        f"* exp(-2.0::double * k * k * {lam} * {lam})) from range(1, 101) series(k))"
    )
    return f"case when {lam} < 0.2::double then 1.0::double else greatest(0, least(1, 2 * {series})) end"


KS = f"""pooled as (select score, sum(b) as b, sum(c) as c from (
    select score, 1 as b, 0 as c from baseline union all select score, 0, 1 from current_scores) x group by score),
ecdf as (select sum(b) over w / (sum(b) over ())::double as fb, sum(c) over w / (sum(c) over ())::double as fc
         from pooled window w as (order by score)),
ks_row as (select max(abs(fb - fc)) as ks_stat, (select count(*) from baseline) as n,
             (select count(*) from current_scores) as m from ecdf)"""

SIDE_METRICS = """counts as (
  select 0 as side, count(*) as n, count(*) filter (score >= 0.5::double and y = 1) as tp,
    count(*) filter (score >= 0.5::double) as flagged, count(*) filter (y = 1) as pos from baseline
  union all
  select 1, count(*), count(*) filter (score >= 0.5::double and y = 1), count(*) filter (score >= 0.5::double),
    count(*) filter (y = 1) from current_scores),
side_metrics as (select side, n, tp::double / greatest(flagged, 1) as p, tp::double / greatest(pos, 1) as rc from counts),
drops as (
  select 'precision' as name, b.p as base, c.p as cur from side_metrics b, side_metrics c where b.side = 0 and c.side = 1
  union all
  select 'recall', b.rc, c.rc from side_metrics b, side_metrics c where b.side = 0 and c.side = 1)"""


@register("psi", f"""with {SIDES}, {PSI}
    select {r('psi')} as psi, (select count(*) from baseline) as n_baseline,
      (select count(*) from current_scores) as n_current from psi_row""")
def psi(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(drift.psi(*views.baseline_and_current(spark, sf)), psi=6)


_PSI_FEATURES = ("TransactionDT", "TransactionAmt", "card1", "C1", "addr1", "addr2", "isFraud")


def _feature_psi_sql() -> str:
    parts = []
    for c in _PSI_FEATURES:
        parts.append(
            f"select '{c}' as feature, cast({c} as double) as value, "
            f"cast(event_time >= timestamp '{BASELINE_END}' as integer) as side from tx_events where {c} is not null"
        )
    edges = _EDGES.replace("score", "value")
    return f"""with {TX_EVENTS}, long as ({' union all '.join(parts)}),
    edges as (select feature, {edges} as e from long where side = 0 group by feature),
    binned as (select feature, side, {_bin('value')} as bin from long join edges using (feature)),
    sizes as (select feature, count(*) filter (side = 0) as nb, count(*) filter (side = 1) as nc
              from binned group by feature),
    shares as (
      select feature, i, nb, nc,
        case when count(*) filter (side = 0) = 0 then 1e-6 else count(*) filter (side = 0)::double / nb end as b,
        case when count(*) filter (side = 1) = 0 then 1e-6 else count(*) filter (side = 1)::double / nc end as c
      from (select * from sizes, range(10) t(i)) s left join binned using (feature)
      where bin = i or bin is null group by feature, i, nb, nc),
    full_shares as (
      select s.feature, s.nb, s.nc, coalesce(b, 1e-6) as b, coalesce(c, 1e-6) as c
      from (select * from sizes, range(10) t(i)) s left join shares h on s.feature = h.feature and s.i = h.i)
    select feature, {r('sum((c - b) * ln(c / b))')} as psi, any_value(nb) as n_baseline, any_value(nc) as n_current
    from full_shares group by feature"""


@register("feature_psi", _feature_psi_sql())
def feature_psi(spark: SparkSession, sf: str) -> DataFrame:
    df = views.tx_events(spark, sf)
    early = F.col("event_time") < F.to_timestamp(F.lit(BASELINE_END))
    return round_columns(drift.feature_psi(df.filter(early), df.filter(~early), _PSI_FEATURES), psi=6)


@register("ks_test", f"""with {SIDES}, {KS}
    select {r('ks_stat')} as ks_stat, {r(ks_p('ks_stat', 'n', 'm'))} as p_value, n as n_baseline, m as n_current
    from ks_row""")
def ks_test(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(drift.ks_test(*views.baseline_and_current(spark, sf)), ks_stat=6, p_value=6)


ALERTS = f"""{PSI}, {KS}, {SIDE_METRICS},
alerts as (
      select 'score_distribution_ks' as metric, ks_stat as cur, 0.0::double as base, 0.05::double as threshold,
        ks_stat >= 0.2::double as critical,
        printf('Score distribution drift detected (KS=%.4f, p=%.4f). Model may need retraining.', ks_stat,
               {ks_p('ks_stat', 'n', 'm')}) as message
      from ks_row where {ks_p('ks_stat', 'n', 'm')} < 0.01::double and m >= 100
      union all
      select 'score_psi', psi, 0.0::double, 0.2::double, psi >= 0.25::double,
        printf('PSI=%.4f ≥ 0.2. Score distribution has shifted significantly.', psi)
      from psi_row, ks_row where psi >= 0.2::double and m >= 100
      union all
      select name || '_drift', cur, base, 0.05::double, base - cur > 0.1::double,
        printf('%s dropped from %.4f to %.4f (Δ=%.4f > threshold=0.05)',
               upper(substr(name, 1, 1)) || substr(name, 2), base, cur, base - cur)
      from drops, ks_row where base - cur > 0.05::double and m >= 100)"""
ALERT_ROWS = f"""select metric, {r('cur')} as current_value, {r('base')} as baseline_value, threshold,
      case when critical then 'critical' else 'warning' end as severity, message
    from alerts"""


@register("drift_alerts", f"with {SIDES}, {ALERTS} {ALERT_ROWS}")
def drift_alerts(spark: SparkSession, sf: str) -> DataFrame:
    out = drift.drift_alerts(*views.baseline_and_current(spark, sf))
    return round_columns(out, current_value=6, baseline_value=6)


def alerts_by_part(parts: int) -> str:
    """The alerts of the newest 1000 later scores after each of ``parts`` parts of equal time."""
    return f"""with {SIDES},
    span as (select min(epoch_us(event_time)) as low, max(epoch_us(event_time)) as high from current_scores),
    arrived as (select c.*, least({parts - 1}, cast(floor((epoch_us(event_time) - low) * {parts} / cast(high - low + 1 as double)) as integer)) as part
      from current_scores c, span),
    checks as (select distinct part as upto from arrived),
    held as (select upto, event_time, score, y from (
        select upto, a.*, row_number() over (partition by upto order by event_time desc, TransactionID desc) as place
        from checks join arrived a on a.part <= upto) x where place <= 1000),
    sizes as (select upto, count(*) as m, max(epoch_us(event_time)) as sent_us, (select count(*) from baseline) as n,
        count(*) filter (score >= 0.5::double and y = 1)::double as hits, count(*) filter (score >= 0.5::double) as flagged,
        count(*) filter (y = 1) as pos from held group by upto),
    base as (select count(*) filter (score >= 0.5::double and y = 1)::double / greatest(count(*) filter (score >= 0.5::double), 1) as p,
        count(*) filter (score >= 0.5::double and y = 1)::double / greatest(count(*) filter (y = 1), 1) as rc from baseline),
    edges as (select {_EDGES} as e from baseline),
    base_bins as (select i, case when count(bin) = 0 then 1e-6 else count(bin)::double / (select count(*) from baseline) end as b
      from range(10) t(i) left join (select {_bin()} as bin from baseline, edges) q on bin = i group by i),
    held_bins as (select s.upto, i, case when count(q.bin) = 0 then 1e-6 else count(q.bin)::double / any_value(m) end as c
      from (select * from sizes, range(10) t(i)) s left join (select upto, {_bin()} as bin from held, edges) q
        on q.upto = s.upto and q.bin = s.i group by s.upto, i),
    psi_rows as (select upto, sum((c - b) * ln(c / b)) as psi from held_bins join base_bins using (i) group by upto),
    pooled as (select upto, score, sum(b) as b, sum(c) as c from (
        select upto, score, 1 as b, 0 as c from baseline, checks union all select upto, score, 0, 1 from held) x group by upto, score),
    ecdf as (select upto, sum(b) over w / (sum(b) over p)::double as fb, sum(c) over w / (sum(c) over p)::double as fc
      from pooled window w as (partition by upto order by score), p as (partition by upto)),
    ks_rows as (select upto, max(abs(fb - fc)) as ks_stat from ecdf group by upto),
    measured as (select *, {ks_p('ks_stat', 'n', 'm')} as p_value, hits / greatest(flagged, 1) as cp, hits / greatest(pos, 1) as cr
      from sizes join psi_rows using (upto) join ks_rows using (upto), base where m >= 100),
    alerts as (
      select sent_us, 'score_distribution_ks' as metric, ks_stat as cur, 0.0::double as base, 0.05::double as threshold,
        ks_stat >= 0.2::double as critical,
        printf('Score distribution drift detected (KS=%.4f, p=%.4f). Model may need retraining.', ks_stat, p_value) as message
      from measured where p_value < 0.01::double
      union all select sent_us, 'score_psi', psi, 0.0::double, 0.2::double, psi >= 0.25::double,
        printf('PSI=%.4f ≥ 0.2. Score distribution has shifted significantly.', psi) from measured where psi >= 0.2::double
      union all select sent_us, 'precision_drift', cp, p, 0.05::double, p - cp > 0.1::double,
        printf('Precision dropped from %.4f to %.4f (Δ=%.4f > threshold=0.05)', p, cp, p - cp) from measured where p - cp > 0.05::double
      union all select sent_us, 'recall_drift', cr, rc, 0.05::double, rc - cr > 0.1::double,
        printf('Recall dropped from %.4f to %.4f (Δ=%.4f > threshold=0.05)', rc, cr, rc - cr) from measured where rc - cr > 0.05::double)
    select sent_us, metric, {r('cur')} as current_value, {r('base')} as baseline_value, threshold,
      case when critical then 'critical' else 'warning' end as severity, message from alerts"""


@register("drift_summary", f"""with {SIDES}, {SIDE_METRICS}
    select count(*) as window_size, {r('avg(score)')} as avg_fraud_score,
      {r('avg(cast(score >= 0.5::double as integer))')} as fraud_rate, 1 as baseline_set,
      (select {r('p')} from side_metrics where side = 0) as baseline_precision,
      (select {r('rc')} from side_metrics where side = 0) as baseline_recall
    from current_scores""")
def drift_summary(spark: SparkSession, sf: str) -> DataFrame:
    out = drift.drift_summary(*views.baseline_and_current(spark, sf))
    out = out.withColumn("baseline_set", F.col("baseline_set").cast("int"))
    return round_columns(out, avg_fraud_score=6, fraud_rate=6, baseline_precision=6, baseline_recall=6)


@register("drift_status", f"""with {SIDES}, {ALERTS}
    select (select count(*) from current_scores) as window_size, (select {r('avg(score)')} from current_scores) as avg_fraud_score,
      metric, {r('cur')} as current_value, {r('base')} as baseline_value, case when critical then 'critical' else 'warning' end as severity,
      message from alerts""")
def drift_status(spark: SparkSession, sf: str) -> DataFrame:
    """The status row, its alerts listed one below the other."""
    base, cur = views.baseline_and_current(spark, sf)
    out = drift.drift_status(drift.drift_summary(base, cur), drift.drift_alerts(base, cur))
    out = out.select("window_size", "avg_fraud_score", F.inline("alerts")).drop("threshold")
    return round_columns(out, avg_fraud_score=6, current_value=6, baseline_value=6)


@register("rolling_last_n", f"""with {SCORES}
    select TransactionID, {r('pa')} as score, y from scores
    order by event_time desc, TransactionID desc limit 1000""")
def rolling_last_n(spark: SparkSession, sf: str) -> DataFrame:
    out = drift.last_n(views.scores(spark, sf), 1000)
    return round_columns(out.select("TransactionID", F.col("pa").alias("score"), "y"), score=6)


@register("drift_by_day", f"""with {SIDES},
    edges as (select {_EDGES} as e from baseline),
    days as (select cast(date_trunc('day', event_time) as date) as day, score from current_scores),
    base_bins as (select i, case when count(bin) = 0 then 1e-6 else count(bin)::double / (select count(*) from baseline) end as b
      from range(10) t(i) left join (select {_bin()} as bin from baseline, edges) q
        on bin = i group by i),
    day_sizes as (select day, count(*) as m from days group by day),
    day_bins as (select d.day, i, count(q.bin) as k, any_value(m) as m
      from (select * from day_sizes, range(10) t(i)) d
      left join (select day, {_bin()} as bin from days, edges) q
        on q.day = d.day and q.bin = d.i group by d.day, i),
    psi_days as (select day, any_value(m) as m,
        sum((case when k = 0 then 1e-6 else k::double / m end - b)
          * ln(case when k = 0 then 1e-6 else k::double / m end / b)) as psi
      from day_bins join base_bins using (i) group by day),
    pooled as (select day, score, sum(b) as b, sum(c) as c from (
        select day, score, 1 as b, 0 as c from baseline, (select distinct day from days)
        union all select day, score, 0, 1 from days) x group by day, score),
    ecdf as (select day, sum(b) over w / (sum(b) over p)::double as fb, sum(c) over w / (sum(c) over p)::double as fc
      from pooled window w as (partition by day order by score), p as (partition by day)),
    ks_days as (select day, max(abs(fb - fc)) as ks from ecdf group by day)
    select cast(day as varchar) as day, m as n_current, {r('psi')} as psi, {r('ks')} as ks_stat,
      {r(ks_p('ks', '(select count(*) from baseline)', 'm'))} as p_value
    from psi_days join ks_days using (day)""")
def drift_by_day(spark: SparkSession, sf: str) -> DataFrame:
    base, cur = views.baseline_and_current(spark, sf)
    cur = cur.withColumn("day", F.date_format("event_time", "yyyy-MM-dd"))
    out = drift.psi_by(base, cur, "day").join(drift.ks_by(base, cur, "day"), "day")
    return round_columns(out, psi=6, ks_stat=6, p_value=6)


_COOLDOWN = f"""with recursive {TX_EVENTS},
    kept as (
      select ProductCD as metric, min(event_time) as t from tx_events group by ProductCD
      union all
      select metric, n from (
        select k.metric, (select min(e.event_time) from tx_events e
            where e.ProductCD = k.metric and e.event_time >= k.t + interval 3600 second) as n from kept k) x
      where n is not null)
    select metric, epoch_us(t) as sent_us from kept"""


def _alerts(spark: SparkSession, sf: str) -> DataFrame:
    return views.tx_events(spark, sf).select(F.col("ProductCD").alias("metric"), "event_time")


@register("alert_cooldown", _COOLDOWN)
def alert_cooldown(spark: SparkSession, sf: str) -> DataFrame:
    out = drift.cooldown(_alerts(spark, sf))
    return out.select("metric", F.unix_micros("event_time").alias("sent_us"))


# -- attribution -------------------------------------------------------------------------------

COEFFICIENTS = {"TransactionAmt": 0.01, "C1": 0.03, "addr1": -0.002, "isFraud": 1.5}
INTERCEPT = -2.0

_CONTRIB = f"""{TX_EVENTS},
m as (select {', '.join(f'avg({c}) as m_{c}' for c in COEFFICIENTS)} from tx_events),
c as (select tx_events.*, {', '.join(f'{w!r}::double * ({c} - m_{c}) as c_{c}' for c, w in COEFFICIENTS.items())},
        {INTERCEPT!r}::double + {' + '.join(f'{w!r}::double * m_{c}' for c, w in COEFFICIENTS.items())} as expected
      from tx_events, m),
long as ({' union all '.join(f"select TransactionID, isFraud, '{c}' as feature, c_{c} as v from c" for c in COEFFICIENTS)}),
top as (select *, row_number() over (partition by TransactionID order by abs(v) desc, feature) as rk from long)"""


def contributions(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.linear_contributions(views.tx_events(spark, sf), COEFFICIENTS, INTERCEPT)


@register("linear_contributions", f"""with {_CONTRIB}
    select TransactionID, {', '.join(f"{r(f'c_{c}')} as c_{c}" for c in COEFFICIENTS)},
      {r('expected')} as expected_value, {r(' + '.join(f'c_{c}' for c in COEFFICIENTS))} as sum_shap
    from c""")
def linear_contributions(spark: SparkSession, sf: str) -> DataFrame:
    df = contributions(spark, sf)
    parts = [F.col("contributions")[i]["shap_value"].alias(f"c_{c}") for i, c in enumerate(COEFFICIENTS)]
    out = df.select("TransactionID", *parts, "expected_value", "sum_shap")
    return round_columns(out, **{c: 6 for c in out.columns[1:]})


@register("top_risk_factors", f"""with {_CONTRIB}
    select TransactionID, cast(rk as integer) as rank, feature, {r('v')} as shap_value,
      case when v > 0 then 'increases_fraud_risk' else 'decreases_fraud_risk' end as direction
    from top where rk <= 3""")
def top_risk_factors(spark: SparkSession, sf: str) -> DataFrame:
    df = contributions(spark, sf)
    out = df.select("TransactionID", F.posexplode(attribution.top_factors(F.col("contributions"), 3)).alias("rank", "x"))
    out = out.select("TransactionID", (F.col("rank") + 1).alias("rank"), "x.feature", "x.shap_value", "x.direction")
    return round_columns(out, shap_value=6)


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    df = contributions(spark, sf)
    return df.select(F.col("isFraud").alias("class"), *[F.col("contributions")[i]["shap_value"].alias(c) for i, c in enumerate(COEFFICIENTS)])


@register("global_importance", f"""with {_CONTRIB},
    g as (select feature, avg(abs(v)) as m, stddev_pop(abs(v)) as s from long group by feature)
    select cast(row_number() over (order by m desc, feature) as integer) as rank, feature, {r('m')} as shap_mean,
      {r('s')} as shap_std, cast(s >= 0.5::double * m as integer) as unstable from g""")
def global_importance(spark: SparkSession, sf: str) -> DataFrame:
    out = attribution.importance(_wide(spark, sf), list(COEFFICIENTS), top=30)
    return round_columns(out.withColumn("unstable", F.col("unstable").cast("int")), shap_mean=6, shap_std=6)


@register("importance_by_class", f"""with {_CONTRIB},
    g as (select isFraud as class, feature, avg(abs(v)) as m from long group by isFraud, feature),
    k as (select *, row_number() over (partition by class order by m desc, feature) as rank from g)
    select class, cast(rank as integer) as rank, feature, {r('m')} as shap_mean from k where rank <= 15""")
def importance_by_class(spark: SparkSession, sf: str) -> DataFrame:
    out = attribution.importance(_wide(spark, sf), list(COEFFICIENTS), by="class", top=15)
    return round_columns(out.select("class", "rank", "feature", "shap_mean"), shap_mean=6)


def _explained(spark: SparkSession, sf: str) -> DataFrame:
    """Factors named like the engineered features, so that every kind of reason text occurs."""
    df = views.tx_events(spark, sf)
    night = ((F.hour("event_time") < 6) | (F.hour("event_time") >= 22)).cast("int")
    df = df.withColumns({"tx_is_night": night, "velocity_sum_24h": F.col("TransactionAmt"), "addr_distance_km": F.col("C1")})
    weights = {"tx_is_night": 0.8, "velocity_sum_24h": 0.01, "addr_distance_km": 0.004, "addr1": -0.002}
    df = attribution.linear_contributions(df, weights)
    score = F.least(F.lit(1.0), F.lit(0.35) * F.col("isFraud") + F.col("C1") / 120.0)
    return df.withColumns({"score": score, "factors": attribution.top_factors(F.col("contributions"), 5)})


_REASONS = f"""{TX_EVENTS},
    f as (select *, cast(extract(hour from event_time) < 6 or extract(hour from event_time) >= 22 as integer) as night,
            least(1.0::double, 0.35::double * isFraud + C1 / 120.0::double) as score from tx_events),
    m as (select avg(night) as mn, avg(TransactionAmt) as ma, avg(C1) as mc, avg(addr1) as md from f),
    long as (
      select TransactionID, 'tx_is_night' as feature, 0.8::double * (night - mn) as v,
        'Transaction occurred during off-hours' as reason from f, m
      union all select TransactionID, 'velocity_sum_24h', 0.01::double * (TransactionAmt - ma),
        printf('Unusually high 24h spend ($%.2f)', TransactionAmt) from f, m
      union all select TransactionID, 'addr_distance_km', 0.004::double * (C1 - mc),
        printf('Large billing/shipping distance (%.0fkm)', C1) from f, m
      union all select TransactionID, 'addr1', -0.002::double * (addr1 - md), 'Elevated addr1 risk factor' from f, m),
    top as (select *, row_number() over (partition by TransactionID order by abs(v) desc, feature) as rk from long),
    reasons as (select TransactionID, string_agg(reason, '; ' order by rk) filter (rk <= 3 and v > 0) as listed
                from top group by TransactionID)"""


@register("explain_rules", f"""with {_REASONS}
    select TransactionID, printf('Transaction $%.2f flagged with %.1f%% fraud probability. ', TransactionAmt, score * 100)
      || 'Key indicators: ' || coalesce(listed, 'Multiple risk factors detected') || '. Recommended action: '
      || case when score > 0.8::double then 'BLOCK' when score > 0.5::double then 'REVIEW' else 'MONITOR' end || '.'
      as explanation
    from f join reasons using (TransactionID)""")
def explain_rules(spark: SparkSession, sf: str) -> DataFrame:
    df = _explained(spark, sf)
    text = attribution.rule_explanation(df.columns, F.col("factors"), F.col("score"), F.col("TransactionAmt"))
    return df.select("TransactionID", text.alias("explanation"))


@register("prompt_text", f"""with {_REASONS},
    lines as (
      select TransactionID, string_agg('  ' || rk || '. ' || feature
          || case when v > 0 then ': ↑ increases' else ': ↓ decreases' end
          || printf(' fraud risk (SHAP=%+.4f)', v), chr(10) order by rk) as listed
      from top group by TransactionID)
    select TransactionID, printf('Transaction Details:' || chr(10) || '- Transaction ID: %s' || chr(10)
        || '- Amount: $%.2f' || chr(10) || '- Product Category: %s' || chr(10) || '- Card: ending in %s' || chr(10)
        || '- Fraud Probability Score: %.1f%%', cast(TransactionID as varchar), TransactionAmt, ProductCD,
        right(cast(card1 as varchar), 4), score * 100)
      || chr(10) || chr(10) || 'Top Risk Factors (SHAP analysis):' || chr(10) || listed || chr(10) || chr(10)
      || printf('AutoEncoder Anomaly Score: %.4f (threshold: %.4f)', TransactionAmt / 5000, 0.05::double)
      || chr(10) || chr(10) || 'Generate a fraud justification and recommended action.' as prompt
    from f join lines using (TransactionID)""")
def prompt_text(spark: SparkSession, sf: str) -> DataFrame:
    df = _explained(spark, sf)
    columns = {"id": "TransactionID", "amount": "TransactionAmt", "product": "ProductCD", "card": "card1"}
    prompt = attribution.analyst_prompt(
        F.col("factors"),
        F.col("score"),
        F.col("TransactionAmt") / 5000,
        F.lit(0.05),
        {k: F.col(v) for k, v in columns.items()},
    )
    return df.select("TransactionID", prompt.alias("prompt"))


# -- tumbling windows (batch twins of the stream) ----------------------------------------------


def _bucket(hours: int) -> str:
    return f"time_bucket(interval '{hours} hours', event_time, timestamp '1970-01-01')"


def tumbling_sql(hours: int, aggs: str, extra: str = "") -> str:
    return f"""with {TX_EVENTS}
    select card1, epoch_us({_bucket(hours)} + interval {hours} hour) as window_end_us, {aggs}
    from tx_events group by card1, {_bucket(hours)} {extra}"""


SUM_1H = (
    f"count(*) as velocity_count_1h, {r('sum(TransactionAmt)', 4)} as velocity_sum_1h, "
    f"{r('coalesce(stddev_samp(TransactionAmt), 0)', 4)} as velocity_std_1h"
)
SUM_24H = f"count(*) as velocity_count_24h, {r('sum(TransactionAmt)', 4)} as velocity_sum_24h"
STATS_7D = (
    f"{r('avg(TransactionAmt)', 4)} as card_avg_amt, "
    f"{r('coalesce(stddev_samp(TransactionAmt), 0)', 4)} as card_std_amt"
)


def flat(df: DataFrame) -> DataFrame:
    out = df.withColumn("window_end", F.unix_micros("window_end")).withColumnRenamed("window_end", "window_end_us")
    doubles = [f.name for f in out.schema.fields if f.dataType.typeName() == "double"]
    return round_columns(out, **{c: 4 for c in doubles})


@register("tumbling_1h", tumbling_sql(1, SUM_1H))
def tumbling_1h(spark: SparkSession, sf: str) -> DataFrame:
    return flat(enrich.tumbling_1h(views.tx_events(spark, sf)))


@register("tumbling_24h", tumbling_sql(24, SUM_24H))
def tumbling_24h(spark: SparkSession, sf: str) -> DataFrame:
    return flat(enrich.tumbling_24h(views.tx_events(spark, sf)))


@register("tumbling_7d", tumbling_sql(168, STATS_7D))
def tumbling_7d(spark: SparkSession, sf: str) -> DataFrame:
    return flat(enrich.tumbling_7d(views.tx_events(spark, sf)))
