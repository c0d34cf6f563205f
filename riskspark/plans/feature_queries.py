"""Registered queries: records, row features, profiles, velocity, the feature build."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions import transaction as tx
from riskspark.functions.numeric import rounded
from riskspark.operators import metrics, profiles
from riskspark.operators.velocity import velocity
from riskspark.plans.features import build_features, feature_values
from riskspark.plans.oracle import IDENTITY, TX_EVENTS, TX_ORDERS, r, velocity_columns, velocity_windows
from riskspark.plans.registry import register, round_columns
from riskspark.session import stored
from riskspark.sources import io, views
from riskspark.sources.schema import FEATURES

RAW = f"""{TX_EVENTS},
raw as (
  select *, case when TransactionID % 70 = 0 then -TransactionAmt else TransactionAmt end as amount,
         TransactionID % 50 = 0 as cut
  from tx_events)"""


# -- records -----------------------------------------------------------------------------------


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    raw = views.raw_json(spark, sf).select("value", F.col("TransactionID").alias("offset"))
    return io.with_error(io.parse_json_records(raw, keep=["offset"]))


@register(
    "parse_events_json",
    f"""with {RAW}
    select TransactionID as source_id,
      case when not cut then cast(TransactionID as double) end as TransactionID,
      case when not cut then cast(TransactionDT as double) end as TransactionDT,
      case when not cut then amount end as TransactionAmt,
      case when not cut then cast(card1 as double) end as card1,
      case when not cut then ProductCD end as ProductCD,
      cast(cut as integer) as corrupt
    from raw""",
)
def parse_events_json(spark: SparkSession, sf: str) -> DataFrame:
    corrupt = F.col(io.CORRUPT).isNotNull()
    numbers = ("TransactionID", "TransactionDT", "TransactionAmt", "card1")
    # The parser may fill the fields it met before the damage; a malformed record has no fields.
    return _parsed(spark, sf).select(
        F.col("offset").alias("source_id"),
        *[F.when(~corrupt, F.col(c).cast("double")).alias(c) for c in numbers],
        F.when(~corrupt, F.col("ProductCD")).alias("ProductCD"),
        corrupt.cast("int").alias("corrupt"),
    )


@register(
    "dlq_split",
    f"""with {RAW}
    select TransactionID as source_id,
      case when cut then 'MalformedRecord' when not amount > 0 then 'InvalidAmount' else 'ok' end as outcome
    from raw""",
)
def dlq_split(spark: SparkSession, sf: str) -> DataFrame:
    df = _parsed(spark, sf)
    good = io.valid_rows(df).select(F.col("offset").alias("source_id"), F.lit("ok").alias("outcome"))
    bad = io.dead_letters(df, topic="transactions")
    return good.unionByName(
        bad.select(F.col("original_offset").alias("source_id"), F.col("error_type").alias("outcome"))
    )


@register(
    "dlq_rate",
    f"""with {RAW},
    f as (select count(*) as n, count(case when cut or not amount > 0 then 1 end) as bad from raw)
    select n - bad as processed, bad as failed, {r('bad::double / n')} as failure_rate from f""",
)
def dlq_rate(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(metrics.failure_rate(_parsed(spark, sf)), failure_rate=6)


@register(
    "to_json_records",
    f"""with {TX_EVENTS}
    select cast(TransactionID as varchar) as key,
      '{{"TransactionID":' || TransactionID || ',"TransactionDT":' || TransactionDT || ',"ProductCD":"' || ProductCD
      || '","card1":' || card1 || ',"addr2":'
      || coalesce(cast(addr2 as varchar), 'null') || ',"isFraud":' || isFraud || '}}' as value
    from tx_events""",
)
def to_json_records(spark: SparkSession, sf: str) -> DataFrame:
    names = ("TransactionID", "TransactionDT", "ProductCD", "card1", "addr2", "isFraud")
    return io.to_json_records(views.tx_events(spark, sf).select(*names))


# -- row features ------------------------------------------------------------------------------


@register(
    "temporal_features",
    f"""with {TX_EVENTS},
    t as (select TransactionID, timestamp '2017-11-30' + to_seconds(TransactionDT) as t from tx_events)
    select TransactionID, cast(extract(hour from t) as integer) as tx_hour,
      cast(extract(isodow from t) - 1 as integer) as tx_day_of_week,
      cast(extract(isodow from t) >= 6 as integer) as tx_is_weekend,
      cast(extract(hour from t) < 6 or extract(hour from t) >= 22 as integer) as tx_is_night
    from t""",
)
def temporal_features(spark: SparkSession, sf: str) -> DataFrame:
    df = views.tx_events(spark, sf)
    cols = tx.calendar_features(tx.event_time(F.col("TransactionDT")))
    return df.select("TransactionID", *[c.alias(n) for n, c in cols.items()])


@register(
    "amount_features",
    f"""with {TX_EVENTS}
    select TransactionID, {r('ln(1 + TransactionAmt)')} as log_amt,
      cast(TransactionAmt % 1 = 0 as integer) as amt_is_round,
      ((cast(trunc(TransactionAmt * 100) as bigint) % 100) + 100) % 100 as amt_cents
    from tx_events""",
)
def amount_features(spark: SparkSession, sf: str) -> DataFrame:
    cols = tx.amount_features(F.col("TransactionAmt"))
    out = views.tx_events(spark, sf).select("TransactionID", *[c.alias(n) for n, c in cols.items()])
    return round_columns(out, log_amt=6)


_POS = ", ".join(
    f"30.0::double + (coalesce({a}, 0) % 100) / 10.0::double as lat{i}, "
    f"-90.0::double - (coalesce({a}, 0) % 50) / 10.0::double as lon{i}"
    for i, a in ((1, "addr1"), (2, "addr2"))
)
_HAVERSINE = (
    "2 * 6371.0::double * asin(sqrt(least(1.0::double, pow(sin(radians(lat2 - lat1) / 2), 2) "
    "+ cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))"
)
_MISMATCH = "cast(coalesce(addr1, 0) <> coalesce(addr2, 0) and coalesce(addr1, 0) > 0 and coalesce(addr2, 0) > 0 as integer)"


@register(
    "address_distance",
    f"""with {TX_EVENTS}, p as (select *, {_POS} from tx_events)
    select TransactionID, {r(_HAVERSINE, 4)} as addr_distance_km, {_MISMATCH} as addr_mismatch from p""",
)
def address_distance(spark: SparkSession, sf: str) -> DataFrame:
    cols = tx.address_features(F.col("addr1"), F.col("addr2"))
    out = views.tx_events(spark, sf).select("TransactionID", *[c.alias(n) for n, c in cols.items()])
    return round_columns(out, addr_distance_km=4)


@register(
    "one_hot_category",
    f"""with {TX_EVENTS}
    select TransactionID, """
    + ", ".join(f"cast(ProductCD = '{v}' as integer) as product_{v}" for v in ("click", "error", "purchase"))
    + " from tx_events",
)
def one_hot_category(spark: SparkSession, sf: str) -> DataFrame:
    cols = tx.one_hot(F.col("ProductCD"), ["click", "error", "purchase"], "product")
    return views.tx_events(spark, sf).select("TransactionID", *[c.alias(n) for n, c in cols.items()])


# -- profiles and joins ------------------------------------------------------------------------

_RISK = """profile as (
  select ProductCD, avg(isFraud) as merchant_fraud_rate, count(isFraud) as merchant_tx_count
  from tx_events where ProductCD is not null group by ProductCD)"""
_CARDS = """cards as (
  select card1, avg(TransactionAmt) as card_avg_amt, coalesce(stddev_samp(TransactionAmt), 0) as card_std_amt,
         count(TransactionAmt) as card_tx_count
  from {source} where card1 is not null group by card1)"""


@register(
    "risk_profile",
    f"with {TX_EVENTS}, {_RISK} select ProductCD, {r('merchant_fraud_rate')} as merchant_fraud_rate, "
    "merchant_tx_count from profile",
)
def risk_profile(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(profiles.risk_profile(views.tx_events(spark, sf)), merchant_fraud_rate=6)


@register(
    "merchant_risk",
    f"""with {TX_EVENTS}, {_RISK}
    select t.TransactionID, {r('coalesce(merchant_fraud_rate, 0)')} as merchant_fraud_rate,
      coalesce(merchant_tx_count, 0) as merchant_tx_count,
      cast(coalesce(merchant_fraud_rate, 0) > 0.1::double as integer) as high_risk_merchant
    from tx_events t left join profile p on t.ProductCD = p.ProductCD""",
)
def merchant_risk(spark: SparkSession, sf: str) -> DataFrame:
    df = views.tx_events(spark, sf)
    out = profiles.add_merchant_risk(df.select("TransactionID", "ProductCD"), stored(profiles.risk_profile(df)))
    return round_columns(out.drop("ProductCD"), merchant_fraud_rate=6)


@register(
    "card_stats",
    f"""with {TX_EVENTS}, {_CARDS.format(source='tx_events')}
    select card1, {r('card_avg_amt', 4)} as card_avg_amt, {r('card_std_amt', 4)} as card_std_amt, card_tx_count
    from cards""",
)
def card_stats(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(profiles.card_stats(views.tx_events(spark, sf)), card_avg_amt=4, card_std_amt=4)


# Statistics from the first half of the period only, so some later cards are unknown at sf0.001.
@register(
    "card_aggregates",
    f"""with {TX_ORDERS},
    train as (select * from tx_orders where event_time < timestamp '1998-01-01'),
    {_CARDS.format(source='train')},
    joined as (
      select t.TransactionID, t.TransactionAmt,
        coalesce(card_avg_amt, (select avg(card_avg_amt) from cards)) as m,
        coalesce(card_std_amt, 0) as s, coalesce(card_tx_count, 0) as n
      from tx_orders t left join cards c on t.card1 = c.card1)
    select TransactionID, {r('m', 2)} as card_avg_amt, {r('s', 2)} as card_std_amt, n as card_tx_count,
      case when s > 0 then {r('(TransactionAmt - m) / (s + 1e-6)', 4)} else {r('(TransactionAmt - m) / (s + 1e-6) * 1e-6', 2)} end as amt_zscore
    from joined""",
)
def card_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    df = views.tx_orders(spark, sf)
    train = df.filter(F.col("event_time") < F.to_timestamp(F.lit("1998-01-01")))
    out = profiles.add_card_aggregates(df.select("TransactionID", "card1", "TransactionAmt"), profiles.card_stats(train))
    # With std 0 the z-score is a million times the distance from the mean; it is shown in millions, to two places.
    z = F.when(F.col("card_std_amt") > 0, rounded(F.col("amt_zscore"), 4)).otherwise(rounded(F.col("amt_zscore") * 1e-6, 2))
    out = out.withColumn("amt_zscore", z).drop("card1", "TransactionAmt")
    return round_columns(out, card_avg_amt=2, card_std_amt=2)


@register(
    "identity_join",
    f"""with {TX_ORDERS}, {IDENTITY}
    select t.TransactionID, TransactionAmt, id_01, id_02, id_03
    from tx_orders t left join identity i on t.TransactionID = i.TransactionID""",
)
def identity_join(spark: SparkSession, sf: str) -> DataFrame:
    df = views.tx_orders(spark, sf).select("TransactionID", "TransactionAmt")
    return profiles.join_identity(df, views.identity(spark, sf))


@register(
    "identity_join_rate",
    f"""with {TX_ORDERS}, {IDENTITY}, keys as (select distinct TransactionID from tx_orders)
    select count(*) as identity_rows, count(b.TransactionID) as matched_rows,
      {r('count(b.TransactionID)::double / count(*)')} as join_rate
    from identity i left join keys b on i.TransactionID = b.TransactionID""",
)
def identity_join_rate(spark: SparkSession, sf: str) -> DataFrame:
    df = views.tx_orders(spark, sf)
    return round_columns(profiles.identity_join_rate(df, views.identity(spark, sf)), join_rate=6)


# -- velocity ----------------------------------------------------------------------------------


def _velocity_query(name: str, view: str, cte: str, hours: list[int], digits: int) -> None:
    sql = (
        f"with {cte} select TransactionID, {velocity_columns(hours, digits)} from {view} {velocity_windows(hours)}"
    )

    @register(name, sql)
    def query(spark: SparkSession, sf: str) -> DataFrame:
        df = getattr(views, view)(spark, sf).select("TransactionID", "card1", "event_time", "TransactionAmt")
        out = velocity(df, hours).drop("card1", "event_time", "TransactionAmt")
        doubles = {f"velocity_{s}_{h}h": digits for h in hours for s in ("sum", "std")}
        return round_columns(out, **doubles)


for _h in (1, 6, 24):
    _velocity_query(f"velocity_{_h}h", "tx_events", TX_EVENTS, [_h], 4)
_velocity_query("velocity_orders", "tx_orders", TX_ORDERS, [24, 168, 720], 2)
_velocity_query("velocity_hot_cards", "tx_events", TX_EVENTS, [1, 6, 24], 4)


# The row-wise definition of the same windows: the oracle really is a range self-join that counts rows.
@register(
    "velocity_range_join",
    f"""with {TX_EVENTS}
    select a.TransactionID, count(b.TransactionID) as velocity_count_24h,
      {r('coalesce(sum(b.TransactionAmt), 0)', 4)} as velocity_sum_24h,
      {r('coalesce(stddev_samp(b.TransactionAmt), 0)', 4)} as velocity_std_24h
    from tx_events a left join tx_events b on a.card1 = b.card1
      and b.event_time >= a.event_time - interval 24 hour and b.event_time < a.event_time
    group by a.TransactionID""",
)
def velocity_range_join(spark: SparkSession, sf: str) -> DataFrame:
    df = views.tx_events(spark, sf).select("TransactionID", "card1", "event_time", "TransactionAmt")
    out = velocity(df, [24], count_null_amounts=True).drop("card1", "event_time", "TransactionAmt")
    return round_columns(out, velocity_sum_24h=4, velocity_std_24h=4)


# -- the feature build -------------------------------------------------------------------------

_BUILD_SQL = f"""with {TX_EVENTS}, {_RISK}, {_CARDS.format(source='tx_events')},
p as (select *, {_POS} from tx_events),
v as (select *, {velocity_columns([1, 6, 24], 4)} from p {velocity_windows([1, 6, 24])})
select TransactionID, TransactionAmt, {r('ln(1 + TransactionAmt)')} as log_amt,
  cast(TransactionAmt % 1 = 0 as integer) as amt_is_round,
  ((cast(trunc(TransactionAmt * 100) as bigint) % 100) + 100) % 100 as amt_cents,
  {r(_HAVERSINE, 4)} as addr_distance_km, {_MISMATCH} as addr_mismatch,
  velocity_count_1h, velocity_sum_1h, velocity_std_1h, velocity_count_6h, velocity_sum_6h, velocity_std_6h,
  velocity_count_24h, velocity_sum_24h, velocity_std_24h,
  {r('coalesce(merchant_fraud_rate, 0)')} as merchant_fraud_rate, coalesce(merchant_tx_count, 0) as merchant_tx_count,
  cast(coalesce(merchant_fraud_rate, 0) > 0.1::double as integer) as high_risk_merchant,
  cast(extract(hour from event_time) as integer) as tx_hour,
  cast(extract(isodow from event_time) - 1 as integer) as tx_day_of_week,
  cast(extract(isodow from event_time) >= 6 as integer) as tx_is_weekend,
  cast(extract(hour from event_time) < 6 or extract(hour from event_time) >= 22 as integer) as tx_is_night,
  {r('card_avg_amt', 4)} as card_avg_amt, {r('card_std_amt', 4)} as card_std_amt, card_tx_count,
  {r('(TransactionAmt - card_avg_amt) / (card_std_amt + 1e-6)', 4)} as amt_zscore, coalesce(C1, 0) as C1
from v left join profile using (ProductCD) left join cards using (card1)"""


def features_of_events(spark: SparkSession, sf: str) -> DataFrame:
    df = views.tx_events(spark, sf)
    # Stored first, so that their sizes are known when the joins are planned.
    risk, cards = stored(profiles.risk_profile(df)), stored(profiles.card_stats(df))
    return build_features(df, risk_profile=risk, card_stats=cards)


@register("build_features", _BUILD_SQL)
def build_features_query(spark: SparkSession, sf: str) -> DataFrame:
    out = features_of_events(spark, sf)
    out = out.select("TransactionID", *[c for c in FEATURES if c in out.columns])
    four = {c: 4 for c in out.columns if c.startswith(("velocity_sum", "velocity_std", "card_avg", "card_std"))}
    return round_columns(out, log_amt=6, addr_distance_km=4, merchant_fraud_rate=6, amt_zscore=4, **four)


# A vector in model order: present features, an absent column and nulls become numbers.
_VECTOR = ["TransactionAmt", "addr2", "C1", "C2", "id_01"]


@register(
    "feature_vector",
    f"""with {TX_EVENTS}
    select TransactionID, TransactionAmt as f0, coalesce(addr2, 0) as f1, coalesce(C1, 0) as f2,
      0.0::double as f3, 0.0::double as f4
    from tx_events""",
)
def feature_vector(spark: SparkSession, sf: str) -> DataFrame:
    df = views.tx_events(spark, sf)
    vector = F.array(*feature_values(df.columns, _VECTOR))
    out = df.select("TransactionID", vector.alias("v"))
    return out.select("TransactionID", *[F.col("v")[i].alias(f"f{i}") for i in range(len(_VECTOR))])




@register(
    "decision",
    f"""with {TX_EVENTS},
    s as (select TransactionID, isFraud * 0.35::double + TransactionAmt / 1000 as p, TransactionAmt / 5000 as a,
            case when isFraud = 1 then 0.0::double end as thr from tx_events)
    select TransactionID, cast(p >= 0.4::double as integer) as is_fraud,
      cast(a > coalesce(nullif(thr, 0), 0.05::double) as integer) as anomaly_flag,
      {r('p')} as fraud_score, {r('a')} as anomaly_score
    from s""",
)
def decision(spark: SparkSession, sf: str) -> DataFrame:
    score = F.col("isFraud") * F.lit(0.35) + F.col("TransactionAmt") / 1000
    anomaly = F.col("TransactionAmt") / 5000
    threshold = F.when(F.col("isFraud") == 1, F.lit(0.0))
    flags = tx.decision_columns(score, anomaly, threshold, 0.4)
    return views.tx_events(spark, sf).select(
        "TransactionID",
        *[c.cast("int").alias(n) for n, c in flags.items()],
        rounded(score).alias("fraud_score"),
        rounded(anomaly).alias("anomaly_score"),
    )
