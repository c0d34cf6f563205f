"""The feature build: every engineered column of a transaction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import transaction as tx
from riskspark.operators import profiles
from riskspark.operators.velocity import velocity
from riskspark.sources.schema import FEATURES


def row_features(columns: Sequence[str], time: str = "event_time") -> dict[str, Column]:
    """Features that need only the row itself; the stream enrichment uses the same expressions."""
    out = tx.calendar_features(F.col(time)) | tx.amount_features(F.col("TransactionAmt"))
    missing = F.lit(None).cast("double")
    addr = [F.col(a) if a in columns else missing for a in ("addr1", "addr2")]
    return out | tx.address_features(*addr)


def build_features(
    df: DataFrame,
    risk_profile: DataFrame | None = None,
    card_stats: DataFrame | None = None,
    hours: Sequence[int] = (1, 6, 24),
    history: DataFrame | None = None,
) -> DataFrame:
    """All features with nulls filled by 0.

    Pass profiles built on training rows. Without ``card_stats`` they are taken from ``df`` itself,
    which leaks on test rows; without ``risk_profile`` the three merchant columns are 0. Velocity
    columns that are already there, from a stream for instance, are kept.
    """
    if "event_time" not in df.columns:
        df = df.withColumn("event_time", tx.event_time(F.col("TransactionDT")))
    stats = profiles.card_stats(df) if card_stats is None else card_stats
    done = {f"velocity_{stat}_{h}h" for h in hours for stat in ("count", "sum", "std")} <= set(df.columns)
    out = df if done else velocity(df, hours, history=history)
    out = out.withColumns(row_features(df.columns))
    out = profiles.add_card_aggregates(out, stats)
    if risk_profile is None:
        out = out.withColumns(
            {
                "merchant_fraud_rate": F.lit(0.0),
                "merchant_tx_count": F.lit(0).cast("bigint"),
                "high_risk_merchant": F.lit(0),
            }
        )
    else:
        out = profiles.add_merchant_risk(out, risk_profile)
    return out.fillna(0, subset=[c for c in FEATURES if c in out.columns])


def expected_features(names: Sequence[str]) -> list[str]:
    """Input features of a model: those listed before its own anomaly and component columns."""
    names = list(names)
    return names[: names.index("ae_anomaly_score")] if "ae_anomaly_score" in names else names


def feature_values(columns: Sequence[str], expected: Sequence[str]) -> list[Column]:
    """The expected features as doubles; absent columns and nulls are 0."""
    return [
        (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in columns else F.lit(0.0)).alias(c) for c in expected
    ]


def drop_features(columns: Sequence[str], group: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in set(group)]
