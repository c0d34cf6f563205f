"""Transaction-shaped views over the provided tables; ``plans.oracle`` defines the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.numeric import hash_uniform
from riskspark.functions.transaction import CLOCK_ORIGIN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(table(spark, sf_dir, "events"))


def as_transactions(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    time = F.col("ts").cast("timestamp")
    return (
        events.withColumn("k", k)
        .select(
            F.col("event_id").alias("TransactionID"),
            time.alias("event_time"),
            (F.floor(F.unix_micros(time) / 1000000) - F.lit(CLOCK_ORIGIN)).alias("TransactionDT"),
            F.col("value").alias("TransactionAmt"),
            F.col("event_type").alias("ProductCD"),
            F.col("user_id").alias("card1"),
            F.col("k").cast("double").alias("C1"),
            (F.lit(100) + (F.col("user_id") * 7) % 400).cast("double").alias("addr1"),
            F.when(F.col("k") % 10 != 0, F.lit(100) + (F.col("k") * 13) % 400).cast("double").alias("addr2"),
            (F.col("k") >= 90).cast("int").alias("isFraud"),
        )
    )


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("TransactionID"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.col("o_totalprice").alias("TransactionAmt"),
        F.col("o_orderpriority").alias("ProductCD"),
        F.col("o_custkey").alias("card1"),
        (F.lit(100) + F.col("c_nationkey") * 17).cast("double").alias("addr1"),
        (F.col("o_orderstatus") == "F").cast("int").alias("isFraud"),
    )


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("TransactionID"))
        .agg(
            F.min("l_quantity").alias("id_01"),
            F.max("l_discount").alias("id_02"),
            F.max("l_tax").alias("id_03"),
        )
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models' scores of every event; ``pb`` follows the label less than ``pa``."""
    return scores_of(tx_events(spark, sf_dir))


def scores_of(transactions: DataFrame) -> DataFrame:
    key = F.col("TransactionID")
    y = F.col("isFraud").cast("double")
    return transactions.select(
        "TransactionID",
        "event_time",
        "TransactionAmt",
        "card1",
        "ProductCD",
        F.col("isFraud").alias("y"),
        (F.lit(0.35) * y + F.lit(0.65) * hash_uniform("a", key)).alias("pa"),
        (F.lit(0.2) * y + F.lit(0.8) * hash_uniform("b", key)).alias("pb"),
    )


BASELINE_END = "2024-01-16 00:00:00"


def baseline_and_current(spark: SparkSession, sf_dir: str, shift: float = 0.15) -> tuple[DataFrame, DataFrame]:
    """Scores of the baseline period, and shifted scores of everything after it."""
    df = scores(spark, sf_dir)
    early = F.col("event_time") < F.to_timestamp(F.lit(BASELINE_END))
    baseline = df.filter(early).select("TransactionID", "event_time", F.col("pa").alias("score"), "y")
    return baseline, shifted_scores(df, shift)


def shifted_scores(df: DataFrame, shift: float = 0.15) -> DataFrame:
    shifted = F.least(F.lit(1.0), F.col("pa") + F.lit(shift))
    late = F.col("event_time") >= F.to_timestamp(F.lit(BASELINE_END))
    return df.filter(late).select("TransactionID", "event_time", shifted.alias("score"), "y")


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON text; every 50th record is cut off and every 70th amount is negative."""
    df = tx_events(spark, sf_dir)
    amount = F.when(F.col("TransactionID") % 70 == 0, -F.col("TransactionAmt")).otherwise(F.col("TransactionAmt"))
    text = F.to_json(
        F.struct("TransactionID", "TransactionDT", amount.alias("TransactionAmt"), "ProductCD", "card1", "isFraud")
    )
    cut = F.substring(text, 1, 40)
    return df.select("TransactionID", F.when(F.col("TransactionID") % 50 == 0, cut).otherwise(text).alias("value"))


def features64(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per embedding vector; label 0 is the minority class."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("TransactionID"),
        F.transform("embedding", lambda x: x.cast("double")).alias("values"),
        (F.col("label") == 0).cast("int").alias("isFraud"),
    )
