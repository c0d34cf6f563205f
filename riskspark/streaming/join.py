"""Range self-join of a stream: each event with the earlier events of its card, aggregated in the same query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.velocity import MICROS


def range_join(stream: DataFrame, hours: int = 24, late: str = "1 hour", key: str = "TransactionID", card: str = "card1", time: str = "event_time", amount: str = "TransactionAmt") -> DataFrame:
    """``key`` with ``velocity_{count,sum,std}_{h}h`` over the rows of the card in [t - h, t), by a stream-stream join.

    Both sides are dealt by card and time bucket, an event to its own bucket and, as a possible partner, to the next one
    too, so a card with many rows spreads over time. Both have a watermark and the join a time range, so Spark drops
    partners that can't match any more. An event is its own partner, which keeps events without earlier ones; pairs are
    aggregated in the tasks that make them, before the exchange to the final sums. Rows without card or time have no
    partners and no result.
    """
    span = F.expr(f"interval {hours} hours")
    bucket = F.floor(F.unix_micros(time) / (hours * 3600 * MICROS))
    seen = stream.withWatermark(time, late).filter(F.col(card).isNotNull() & F.col(time).isNotNull() & F.col(key).isNotNull())
    events = seen.select(F.col(key), F.col(card).alias("_card"), F.col(time).alias("_at"), bucket.alias("_bucket"))
    partners = seen.select(
        F.col(key).alias("_partner"), F.col(card).alias("_partner_card"), F.col(time).alias("_partner_at"), F.col(amount).cast("double").alias("_amount"), F.explode(F.array(bucket, bucket + 1)).alias("_partner_bucket")
    )
    itself = F.col("_partner") == F.col(key)
    joined = events.join(
        partners,
        (F.col("_card") == F.col("_partner_card"))
        & (F.col("_bucket") == F.col("_partner_bucket"))
        & (F.col("_partner_at") >= F.col("_at") - span)
        & (F.col("_partner_at") <= F.col("_at"))
        & ((F.col("_partner_at") < F.col("_at")) | itself),
    )
    earlier = F.col("_partner_at") < F.col("_at")
    amounts = F.when(earlier, F.col("_amount"))
    found = joined.groupBy(key, "_at").agg(
        F.count(F.when(earlier, F.lit(1))).alias(f"velocity_count_{hours}h"),
        F.coalesce(F.sum(amounts), F.lit(0.0)).alias(f"velocity_sum_{hours}h"),
        F.coalesce(F.stddev_samp(amounts), F.lit(0.0)).alias(f"velocity_std_{hours}h"),
    )
    return found.drop("_at")
