"""Stream transformations. Each one also runs on a batch table, where the watermark has no effect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from riskspark.functions import transaction as tx
from riskspark.plans.features import row_features
from riskspark.sources import io
from riskspark.sources.schema import TRANSACTION


def read_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    path: str | None = None,
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """A source stream. ``fmt="kafka"`` takes ``kafka.bootstrap.servers`` and ``subscribe`` as options and
    starts at the newest offsets without failing on lost data; file formats take a path and a schema."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"startingOffsets": "latest", "failOnDataLoss": "false"} | options
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**options)
    return reader.load(path) if path else reader.load()


def parse(stream: DataFrame, schema: T.StructType = TRANSACTION, keep: Sequence[str] = ()) -> DataFrame:
    """JSON records to typed columns with ``event_time`` and the error columns of the dead-letter split."""
    parsed = io.with_error(io.parse_json_records(stream, schema=schema, keep=keep))
    return parsed.withColumn("event_time", tx.event_time(F.col("TransactionDT")))


def enrich(df: DataFrame) -> DataFrame:
    """The row features of the batch build; nothing here needs state."""
    return df.withColumns(row_features(df.columns))


def _tumbling(df: DataFrame, length: str, late: str, aggs: dict[str, Column]) -> DataFrame:
    """Per card and window. The partial aggregation before the shuffle keeps a hot card to one row per
    task and window."""
    return (
        df.withWatermark("event_time", late)
        .groupBy("card1", F.window("event_time", length))
        .agg(*[c.alias(n) for n, c in aggs.items()])
        .select("card1", F.col("window.end").alias("window_end"), *aggs)
    )


def tumbling_1h(df: DataFrame, late: str = "1 hour") -> DataFrame:
    amount = F.col("TransactionAmt")
    return _tumbling(
        df,
        "1 hour",
        late,
        {
            "velocity_count_1h": F.count(F.lit(1)),
            "velocity_sum_1h": F.sum(amount),
            "velocity_std_1h": F.coalesce(F.stddev_samp(amount), F.lit(0.0)),
        },
    )


def tumbling_24h(df: DataFrame, late: str = "24 hours") -> DataFrame:
    return _tumbling(
        df,
        "24 hours",
        late,
        {"velocity_count_24h": F.count(F.lit(1)), "velocity_sum_24h": F.sum("TransactionAmt")},
    )


def tumbling_7d(df: DataFrame, late: str = "7 days") -> DataFrame:
    """The mean adds the amounts up in order of time: means of cents often end in a half, where another order of the same
    sum is rounded the other way. So a window keeps its amounts until it closes."""
    amount = F.col("TransactionAmt")
    pairs = F.collect_list(F.when(amount.isNotNull(), F.struct("event_time", amount.cast("double").alias("amount"))))
    total = F.aggregate(F.array_sort(pairs), F.lit(0.0), lambda acc, x: acc + x["amount"])
    return _tumbling(
        df,
        "7 days",
        late,
        {"card_avg_amt": total / F.nullif(F.size(pairs), F.lit(0)), "card_std_amt": F.coalesce(F.stddev_samp(amount), F.lit(0.0))},
    )


def deduplicate(df: DataFrame, key: str = "TransactionID", late: str = "1 hour") -> DataFrame:
    """Drops redelivered records; state is kept only as long as the watermark allows late ones."""
    return df.withWatermark("event_time", late).dropDuplicatesWithinWatermark([key])


def join_profile(df: DataFrame, profile: DataFrame, key: str) -> DataFrame:
    """Stream with a static profile, read anew for every micro-batch."""
    return df.join(profile, key, "left")


def write_stream(
    df: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    path: str | None = None,
    trigger: dict | None = None,
    mode: str = "append",
    **options: str,
) -> DataStreamWriter:
    """A writer for (key, value) records or tables; call ``start`` on it. Every 5 seconds by default."""
    writer = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.options(**options).trigger(**(trigger or {"processingTime": "5 seconds"}))
    return writer.option("path", path) if path else writer


def write_enriched(stream: DataFrame, checkpoint: str, **sink) -> DataStreamWriter:
    """Raw JSON stream to enriched JSON records keyed by transaction; malformed rows are left to the
    scoring stream's dead letters."""
    good = io.valid_rows(parse(stream))
    return write_stream(io.to_json_records(enrich(good)), checkpoint, **sink)
