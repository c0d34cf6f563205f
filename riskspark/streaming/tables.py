"""Batch-numbered tables in shared storage: writing a batch again replaces it, so a replay after a
failure leaves every table as if the batch had run once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def batch_path(base: str, table: str, batch_id: int) -> str:
    return f"{base}/{table}/batch={batch_id}"


def put(df: DataFrame, base: str, table: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(batch_path(base, table, batch_id))
