"""Registered queries that run as streams: the events table arrives in parts, one micro-batch each.

A closing row far in the future lets the watermark pass every event where results wait for it. Tumbling windows that the
stream hasn't closed are left out, and their SQL twins keep closed windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.numeric import hash_uniform
from riskspark.operators import profiles
from riskspark.plans.drift_queries import STATS_7D, SUM_1H, SUM_24H, _bucket, alerts_by_part, flat, tumbling_sql
from riskspark.plans.feature_queries import _HAVERSINE, _POS
from riskspark.plans.features import build_features
from riskspark.plans.model import Settings, fit_model
from riskspark.plans.oracle import TX_EVENTS, r, u, velocity_columns, velocity_windows
from riskspark.plans.registry import register, round_columns
from riskspark.session import new_dir, stored
from riskspark.sources import views
from riskspark.streaming import drift, enrich, join, run
from riskspark.streaming.score import ScoringStream
from riskspark.streaming.sinks import TableSink
from riskspark.streaming.velocity import velocity_in_order

PARTS = 6
DELAY_DAYS = 2


def _in_order(df: DataFrame) -> Column:
    """Parts of equal time, without disorder between them."""
    return _parts(df, F.unix_micros("event_time"))


def _delayed() -> Column:
    """When a transaction arrives: a tenth of them up to two days late."""
    key = F.col("TransactionID")
    late = F.floor(hash_uniform("delay", key) * (DELAY_DAYS * 86400 * 1e6)).cast("bigint")
    return F.unix_micros("event_time") + F.when(hash_uniform("late", key) < 0.1, late).otherwise(0)


def _parts(df: DataFrame, arrival: Column) -> Column:
    low, high = df.agg(F.min(arrival), F.max(arrival)).first()
    if low is None:
        return F.lit(0)
    return F.least(F.lit(PARTS - 1), F.floor((arrival - F.lit(low)) * F.lit(PARTS) / F.lit(high - low + 1)).cast("int"))


#: The same in SQL.
PARTED = f"""{TX_EVENTS},
timed as (select *, epoch_us(event_time) + case when {u('late', 'TransactionID')} < 0.1::double
    then cast(floor({u('delay', 'TransactionID')} * {DELAY_DAYS * 86400 * 1e6!r}::double) as bigint) else 0 end as arrival from tx_events),
parted as (select *, least({PARTS - 1}, cast(floor((arrival - (select min(arrival) from timed)) * {PARTS}
    / cast((select max(arrival) - min(arrival) + 1 from timed) as double)) as integer)) as part from timed)"""


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    events = views.tx_events(spark, sf)
    return run.arriving(events, _in_order(events), PARTS, new_dir(spark, "events"))


def _closed_stream(events: DataFrame) -> DataFrame:
    """Delayed events, and at last one row of an unknown card, numbered -1, whose time closes everything."""
    newest = events.agg(F.max("event_time")).first()[0]
    known = {"event_time": (F.lit(newest) + F.expr("interval 60 days")).cast("timestamp"), "TransactionID": F.lit(-1), "card1": F.lit(-1)}
    end = events.sparkSession.range(1).select(*[known.get(c, F.lit(None)).cast(t).alias(c) for c, t in events.dtypes])
    part = F.when(F.col("TransactionID") < 0, F.lit(PARTS)).otherwise(_parts(events, _delayed()))
    return run.arriving(events.unionByName(end), part, PARTS + 1, new_dir(events.sparkSession, "events"))


def _closed(hours: int, late_hours: int) -> str:
    return (
        f"having {_bucket(hours)} + interval {hours} hour <= "
        f"(select date_trunc('millisecond', max(event_time)) from tx_events) - interval {late_hours} hour"
    )


def _tumbling(spark: SparkSession, sf: str, operator) -> DataFrame:
    return flat(run.run_to_table(operator(_stream(spark, sf)), new_dir(spark, "tumbling")))


@register("stream_tumbling_1h", tumbling_sql(1, SUM_1H, _closed(1, 1)))
def stream_tumbling_1h(spark: SparkSession, sf: str) -> DataFrame:
    return _tumbling(spark, sf, enrich.tumbling_1h)


@register("stream_tumbling_24h", tumbling_sql(24, SUM_24H, _closed(24, 24)))
def stream_tumbling_24h(spark: SparkSession, sf: str) -> DataFrame:
    return _tumbling(spark, sf, enrich.tumbling_24h)


@register("stream_tumbling_7d", tumbling_sql(168, STATS_7D, _closed(168, 168)))
def stream_tumbling_7d(spark: SparkSession, sf: str) -> DataFrame:
    return _tumbling(spark, sf, enrich.tumbling_7d)


@register(
    "stream_enrich",
    f"""with {TX_EVENTS}, p as (select *, {_POS} from tx_events)
    select TransactionID, {r('ln(1 + TransactionAmt)')} as log_amt,
      cast(extract(hour from event_time) as integer) as tx_hour,
      cast(extract(isodow from event_time) >= 6 as integer) as tx_is_weekend,
      cast(extract(hour from event_time) < 6 or extract(hour from event_time) >= 22 as integer) as tx_is_night,
      {r(_HAVERSINE, 4)} as addr_distance_km
    from p""",
)
def stream_enrich(spark: SparkSession, sf: str) -> DataFrame:
    stream = enrich.enrich(_stream(spark, sf))
    names = ("log_amt", "tx_hour", "tx_is_weekend", "tx_is_night", "addr_distance_km")
    out = run.run_to_table(stream.select("TransactionID", *names), new_dir(spark, "enrich"))
    return round_columns(out, log_amt=6, addr_distance_km=4)


@register(
    "stream_deduplicate",
    f"with {TX_EVENTS} select TransactionID, TransactionAmt from tx_events",
)
def stream_deduplicate(spark: SparkSession, sf: str) -> DataFrame:
    """Every event delivered twice, kept once."""
    stream = _stream(spark, sf).select("TransactionID", "event_time", "TransactionAmt")
    twice = stream.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    out = enrich.deduplicate(twice).select("TransactionID", "TransactionAmt")
    return run.run_to_table(out, new_dir(spark, "dedup"))


@register(
    "stream_profile_join",
    f"""with {TX_EVENTS},
    profile as (select ProductCD, avg(isFraud) as rate from tx_events group by ProductCD)
    select TransactionID, {r('rate')} as merchant_fraud_rate from tx_events join profile using (ProductCD)""",
)
def stream_profile_join(spark: SparkSession, sf: str) -> DataFrame:
    # Stored: every micro-batch reads it.
    profile = stored(profiles.risk_profile(views.tx_events(spark, sf)))
    joined = enrich.join_profile(_stream(spark, sf), profile, "ProductCD")
    out = run.run_to_table(joined.select("TransactionID", "merchant_fraud_rate"), new_dir(spark, "profile"))
    return round_columns(out, merchant_fraud_rate=6)


@register(
    "stream_velocity",
    f"""with {TX_EVENTS} select TransactionID, {velocity_columns([1, 6, 24], 4)} from tx_events
          {velocity_windows([1, 6, 24])}""",
)
def stream_velocity(spark: SparkSession, sf: str) -> DataFrame:
    """Every event in the order of the watermark, which trails by more than a part and the longest delay."""
    events = views.tx_events(spark, sf).select("TransactionID", "card1", "event_time", "TransactionAmt")
    out = run.run_to_table(velocity_in_order(_closed_stream(events), late="20 days"), new_dir(spark, "velocity"))
    out = out.filter("TransactionID >= 0").drop("card1", "event_time", "TransactionAmt")
    return round_columns(out, **{f"velocity_{s}_{h}h": 4 for h in (1, 6, 24) for s in ("sum", "std")})


@register(
    "stream_range_join",
    f"""with {TX_EVENTS}
    select a.TransactionID, count(b.TransactionID) as velocity_count_24h,
      {r('coalesce(sum(b.TransactionAmt), 0)', 4)} as velocity_sum_24h,
      {r('coalesce(stddev_samp(b.TransactionAmt), 0)', 4)} as velocity_std_24h
    from tx_events a left join tx_events b on a.card1 = b.card1
      and b.event_time >= a.event_time - interval 24 hour and b.event_time < a.event_time
    where a.card1 is not null group by a.TransactionID""",
)
def stream_range_join(spark: SparkSession, sf: str) -> DataFrame:
    events = views.tx_events(spark, sf).select("TransactionID", "card1", "event_time", "TransactionAmt")
    out = run.run_to_table(join.range_join(_closed_stream(events), 24, late="20 days"), new_dir(spark, "join"))
    return round_columns(out.filter("TransactionID >= 0"), velocity_sum_24h=4, velocity_std_24h=4)


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON messages with an offset; every 50th record is damaged."""
    events = views.tx_events(spark, sf)
    names = ("TransactionID", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "addr1", "addr2", "isFraud")
    text = F.to_json(F.struct(*names))
    value = F.when(F.col("TransactionID") % 50 == 0, F.substring(text, 1, 40)).otherwise(text)
    part = _parts(events, _delayed())
    messages = events.select(F.col("TransactionID").alias("offset"), value.alias("value"), part.alias("part"))
    return run.arriving(messages, F.col("part"), PARTS, new_dir(spark, "messages")).drop("part")


@register(
    "stream_score",
    f"""with {PARTED}, good as (select *, TransactionDT as t from parted where TransactionID % 50 <> 0),
    known as (
      select a.TransactionID, count(b.TransactionAmt) as n, coalesce(sum(b.TransactionAmt), 0) as s from good a
      left join good b on a.card1 = b.card1 and b.t >= a.t - 86400 and b.t < a.t and b.part <= a.part group by a.TransactionID)
    select TransactionID, 'scored' as outcome, n as velocity_count_24h, {r('s', 4)} as velocity_sum_24h, 1 as as_in_batch from known
    union all select TransactionID, 'MalformedRecord', 0, 0.0::double, 1 from parted where TransactionID % 50 = 0""",
)
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """Every valid event is scored on arrival with the history of its own part and earlier ones; its score is the batch
    score of the same features."""
    base = new_dir(spark, "score")
    train = views.tx_events(spark, sf).drop("C1")
    risk, cards = stored(profiles.risk_profile(train)), stored(profiles.card_stats(train))
    names = ["TransactionAmt", "log_amt", "addr_distance_km", "tx_hour", "velocity_count_24h", "velocity_sum_24h"]
    built = stored(build_features(train, risk, cards).select("TransactionID", "isFraud", *names))
    model = fit_model(built, names, Settings(kind="logistic", use_anomaly=False))
    scoring = ScoringStream(model, risk, cards, TableSink(base, "scores"), TableSink(base, "dead_letters"), keep=["offset"])
    writer = scoring.writer(_raw(spark, sf), f"{base}/checkpoint", availableNow=True)
    with run.state_by_cores(spark):
        query = writer.start()
    run.finish(query)
    scored = run.all_batches(spark, base, "scores")
    features = scored.select("TransactionID", "velocity_count_24h", "velocity_sum_24h")
    again = model.score(built.drop("velocity_count_24h", "velocity_sum_24h").join(features, "TransactionID"))
    again = again.select("TransactionID", F.col("raw_score").alias("want"))
    rows = scored.join(again, "TransactionID", "left").select(
        "TransactionID", F.lit("scored").alias("outcome"), "velocity_count_24h", "velocity_sum_24h",
        F.coalesce((F.abs(F.col("raw_score") - F.col("want")) < 1e-9).cast("int"), F.lit(0)).alias("as_in_batch"),
    )
    dead = run.all_batches(spark, base, "dead_letters").select(
        F.col("original_offset").alias("TransactionID"), F.col("error_type").alias("outcome"),
        F.lit(0).cast("bigint").alias("velocity_count_24h"), F.lit(0.0).alias("velocity_sum_24h"), F.lit(1).alias("as_in_batch"),
    )
    return round_columns(rows.unionByName(dead), velocity_sum_24h=4)


@register("stream_drift", alerts_by_part(PARTS))
def stream_drift(spark: SparkSession, sf: str) -> DataFrame:
    """The alerts of the newest 1000 scores after each part, against the baseline period."""
    baseline, _ = views.baseline_and_current(spark, sf)
    later = views.shifted_scores(views.scores(spark, sf))
    stream = run.arriving(later, _in_order(later), PARTS, new_dir(spark, "later"))
    out = run.run_to_table(drift.drift_alert_stream(stream, baseline), new_dir(spark, "drift"))
    return round_columns(out, current_value=6, baseline_value=6)
