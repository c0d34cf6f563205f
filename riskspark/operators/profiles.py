"""Category risk profiles, card statistics, and joining them back to transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.transaction import amount_zscore


def risk_profile(df: DataFrame, label: str = "isFraud", category: str = "ProductCD") -> DataFrame:
    """Fraud rate and labelled rows per category; a null category has no profile."""
    return (
        df.filter(F.col(category).isNotNull())
        .groupBy(category)
        .agg(
            F.avg(label).alias("merchant_fraud_rate"),
            F.count(label).alias("merchant_tx_count"),
        )
    )


def add_merchant_risk(df: DataFrame, profile: DataFrame, category: str = "ProductCD") -> DataFrame:
    """Hand over a stored profile: its size is then known and decides the join, a broadcast below
    ``spark.sql.autoBroadcastJoinThreshold``, else a shuffle join whose skewed partitions adaptive
    execution splits."""
    rate = F.coalesce(F.col("merchant_fraud_rate"), F.lit(0.0))
    joined = df.join(profile, category, "left")
    return joined.withColumns(
        {
            "merchant_fraud_rate": rate,
            "merchant_tx_count": F.coalesce(F.col("merchant_tx_count"), F.lit(0).cast("bigint")),
            "high_risk_merchant": (rate > 0.1).cast("int"),
        }
    ).select(*df.columns, "merchant_fraud_rate", "merchant_tx_count", "high_risk_merchant")


def card_stats(df: DataFrame, card: str = "card1", amount: str = "TransactionAmt") -> DataFrame:
    """Mean, sample std (0 for one row) and count of amounts per card; a null card has no statistics."""
    return (
        df.filter(F.col(card).isNotNull())
        .groupBy(card)
        .agg(
            F.avg(amount).alias("card_avg_amt"),
            F.coalesce(F.stddev_samp(amount), F.lit(0.0)).alias("card_std_amt"),
            F.count(amount).alias("card_tx_count"),
        )
    )


def add_card_aggregates(
    df: DataFrame, stats: DataFrame, card: str = "card1", amount: str = "TransactionAmt"
) -> DataFrame:
    """Unknown cards get the unweighted mean of the card means, std 0 and count 0."""
    fallback = stats.agg(F.avg("card_avg_amt")).scalar()
    joined = df.join(stats, card, "left").withColumns(
        {
            "card_avg_amt": F.coalesce(F.col("card_avg_amt"), fallback),
            "card_std_amt": F.coalesce(F.col("card_std_amt"), F.lit(0.0)),
            "card_tx_count": F.coalesce(F.col("card_tx_count"), F.lit(0).cast("bigint")),
        }
    )
    z = amount_zscore(F.col(amount), F.col("card_avg_amt"), F.col("card_std_amt"))
    return joined.withColumn("amt_zscore", z).select(
        *df.columns, "card_avg_amt", "card_std_amt", "card_tx_count", "amt_zscore"
    )


def join_identity(df: DataFrame, identity: DataFrame | None, key: str = "TransactionID") -> DataFrame:
    return df if identity is None else df.join(identity, key, "left")


def identity_join_rate(df: DataFrame, identity: DataFrame, key: str = "TransactionID") -> DataFrame:
    """Share of identity rows whose transaction exists. One join: a left join against the distinct
    keys tells matched rows from the others."""
    keys = df.select(key).distinct().withColumn("_hit", F.lit(1))
    return identity.join(keys, key, "left").agg(
        F.count(F.lit(1)).alias("identity_rows"),
        F.count("_hit").alias("matched_rows"),
        F.coalesce(F.try_divide(F.count("_hit").cast("double"), F.count(F.lit(1)).cast("double")), F.lit(0.0)).alias(
            "join_rate"
        ),
    )
