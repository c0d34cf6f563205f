"""Transaction schema and the ordered model feature list."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG = ("TransactionID", "TransactionDT", "card1")
_STRING = ("ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain")
_ORDER = (
    ["TransactionID", "TransactionDT", "TransactionAmt", "ProductCD"]
    + [f"card{i}" for i in range(1, 7)]
    + ["addr1", "addr2", "dist1", "dist2", "P_emaildomain", "R_emaildomain"]
    + [f"C{i}" for i in range(1, 15)]
    + [f"D{i}" for i in range(1, 5)]
    + ["isFraud"]
)


def _type_of(name: str) -> T.DataType:
    if name in _LONG:
        return T.LongType()
    if name in _STRING:
        return T.StringType()
    return T.IntegerType() if name == "isFraud" else T.DoubleType()


# 35 nullable fields of a transaction record; ids are wide integers.
TRANSACTION = T.StructType([T.StructField(name, _type_of(name), True) for name in _ORDER])

# Model features in their fixed order.
AMOUNT = ["TransactionAmt", "log_amt", "amt_is_round", "amt_cents"]
ADDRESS = ["addr_distance_km", "addr_mismatch"]
VELOCITY = [f"velocity_{stat}_{h}h" for h in (1, 6, 24) for stat in ("count", "sum", "std")]
MERCHANT = ["merchant_fraud_rate", "merchant_tx_count", "high_risk_merchant"]
CALENDAR = ["tx_hour", "tx_day_of_week", "tx_is_weekend", "tx_is_night"]
CARD = ["card_avg_amt", "card_std_amt", "card_tx_count", "amt_zscore"]
IDENTITY = [f"id_{i:02d}" for i in (1, 2, 3, 5, 6, 9, 10, 11)]
FEATURES = (
    AMOUNT
    + ADDRESS
    + VELOCITY
    + MERCHANT
    + CALENDAR
    + CARD
    + ["dist1", "dist2"]
    + [f"C{i}" for i in range(1, 15)]
    + [f"D{i}" for i in range(1, 5)]
    + [f"V{i}" for i in range(1, 21)]
    + IDENTITY
)

IDENTITY_SCHEMA = T.StructType(
    [T.StructField("TransactionID", T.LongType())]
    + [T.StructField(name, T.DoubleType()) for name in IDENTITY]
)

# A record that could not be processed.
DEAD_LETTER = T.StructType(
    [
        T.StructField("original_topic", T.StringType()),
        T.StructField("original_partition", T.IntegerType()),
        T.StructField("original_offset", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("failed_at", T.StringType()),
    ]
)


def feature_columns(columns: list[str]) -> list[str]:
    """The model features that are present, in model order."""
    present = set(columns)
    return [c for c in FEATURES if c in present]
