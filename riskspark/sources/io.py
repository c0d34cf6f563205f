"""Batch readers and writers, and the JSON record boundary with its dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.transaction import valid_transaction
from riskspark.sources.schema import IDENTITY_SCHEMA, TRANSACTION

CORRUPT = "_corrupt_record"


def read_transactions(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION) -> DataFrame:
    """CSV with a header; columns are matched by name, so files may hold more of them."""
    return _read_csv(spark, path, schema)


def read_identity(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The identity table, or None when there is none."""
    if not path:
        return None
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return _read_csv(spark, path, IDENTITY_SCHEMA) if fs.exists(hadoop_path) else None


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    present = set(raw.columns)
    return raw.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """A metrics table, bounded by the number of metrics, as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def to_json_records(df: DataFrame, key: str = "TransactionID", max_records: int | None = None) -> DataFrame:
    """Rows as (key, value) messages, the first ``max_records`` by key when that is given. NaN becomes
    null and null fields stay in the JSON."""
    df = df if max_records is None else df.orderBy(key, *[c for c in df.columns if c != key]).limit(max_records)
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    fields = [
        (F.when(~F.isnan(c), F.col(c)) if c in floating else F.col(c)).alias(c) for c in df.columns
    ]
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def parse_json_records(
    df: DataFrame, value: str = "value", schema: T.StructType = TRANSACTION, keep: Sequence[str] = ()
) -> DataFrame:
    """Typed columns from JSON text, plus the original text in ``_corrupt_record`` where it is malformed."""
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(value).cast("string"), wide, options)
    return df.select(*keep, F.col(value).cast("string").alias("payload"), parsed.alias("_r")).select(
        *keep, "payload", "_r.*"
    )


def with_error(df: DataFrame, dt: str = "TransactionDT", amount: str = "TransactionAmt") -> DataFrame:
    """Adds ``error_type`` and ``error_message``, both null on good rows."""
    corrupt = F.col(CORRUPT).isNotNull() | F.col("payload").isNull()
    kind = (
        F.when(corrupt, F.lit("MalformedRecord"))
        .when(F.col(dt).isNull(), F.lit("MissingTime"))
        .when(F.col(amount).isNull(), F.lit("MissingAmount"))
        .when(~valid_transaction(F.col(dt), F.col(amount)), F.lit("InvalidAmount"))
    )
    message: Column = (
        F.when(corrupt, F.concat(F.lit("cannot parse: "), F.coalesce(F.col("payload"), F.lit(""))))
        .when(F.col(dt).isNull(), F.lit(f"{dt} is required"))
        .when(F.col(amount).isNull(), F.lit(f"{amount} is required"))
        .when(
            ~valid_transaction(F.col(dt), F.col(amount)),
            F.concat(F.lit(f"{amount} must be positive, got "), F.col(amount).cast("string")),
        )
    )
    return df.withColumn("error_type", kind).withColumn("error_message", F.substring(message, 1, 500))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("error_type").isNull()).drop(CORRUPT, "payload", "error_type", "error_message")


def dead_letters(df: DataFrame, topic: str = "", retries: int = 0) -> DataFrame:
    """Dead-letter records of the failed rows. Origin columns are used when the source has them."""
    present = set(df.columns)

    def origin(name: str, kind: str, default: Column) -> Column:
        return (F.col(name) if name in present else default).cast(kind)

    return df.filter(F.col("error_type").isNotNull()).select(
        origin("topic", "string", F.lit(topic)).alias("original_topic"),
        origin("partition", "int", F.lit(None)).alias("original_partition"),
        origin("offset", "bigint", F.lit(None)).alias("original_offset"),
        "payload",
        "error_type",
        "error_message",
        F.lit(retries).alias("retry_count"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("failed_at"),
    )
