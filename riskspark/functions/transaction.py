"""Per-transaction feature expressions: amount, calendar, address. All stay in whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Second 0 of the TransactionDT clock, 2017-11-30T00:00:00Z (fixed value).
CLOCK_ORIGIN = 1512000000
EARTH_RADIUS_KM = 6371.0


def event_time(dt_seconds: Column) -> Column:
    return F.timestamp_seconds(dt_seconds + F.lit(CLOCK_ORIGIN))


def calendar_features(time: Column) -> dict[str, Column]:
    hour = F.hour(time)
    weekday = F.weekday(time)
    return {
        "tx_hour": hour,
        "tx_day_of_week": weekday,
        "tx_is_weekend": (weekday >= 5).cast("int"),
        "tx_is_night": ((hour < 6) | (hour >= 22)).cast("int"),
    }


def amount_features(amount: Column) -> dict[str, Column]:
    return {
        "log_amt": F.log1p(amount),
        "amt_is_round": F.coalesce((amount % F.lit(1.0) == 0).cast("int"), F.lit(0)),
        # Truncation happens on the binary product: 19.99 has 98 cents here.
        "amt_cents": F.pmod((amount * F.lit(100.0)).cast("bigint"), F.lit(100).cast("bigint")),
    }


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2.0) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), 2.0
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def address_features(addr1: Column, addr2: Column) -> dict[str, Column]:
    """Distance between the pseudo positions that the two address codes stand for."""
    first, second = (F.coalesce(a.cast("double"), F.lit(0.0)) for a in (addr1, addr2))

    def position(code: Column) -> tuple[Column, Column]:
        return F.lit(30.0) + (code % 100.0) / 10.0, F.lit(-90.0) - (code % 50.0) / 10.0

    return {
        "addr_distance_km": haversine_km(*position(first), *position(second)),
        "addr_mismatch": ((first != second) & (first > 0) & (second > 0)).cast("int"),
    }


def amount_zscore(amount: Column, mean: Column, std: Column) -> Column:
    """Null amount gives 0; a card with std 0 gives a huge value, as the definition implies."""
    return F.coalesce((amount - mean) / (std + F.lit(1e-6)), F.lit(0.0))


def one_hot(category: Column, values: list[str], prefix: str) -> dict[str, Column]:
    return {f"{prefix}_{v}": F.coalesce((category == v).cast("int"), F.lit(0)) for v in values}


def decision_columns(
    score: Column, anomaly: Column, anomaly_threshold: Column, threshold: float = 0.5
) -> dict[str, Column]:
    """Flags are taken on the raw scores; a missing or zero anomaly threshold means 0.05."""
    limit = F.coalesce(F.nullif(anomaly_threshold, F.lit(0.0)), F.lit(0.05))
    return {"is_fraud": score >= threshold, "anomaly_flag": anomaly > limit}


def valid_transaction(dt: Column, amount: Column) -> Column:
    """Time and amount are required and the amount is positive."""
    return dt.isNotNull() & amount.isNotNull() & F.coalesce(amount > 0, F.lit(False))
