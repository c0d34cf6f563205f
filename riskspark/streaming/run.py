"""Running a bounded stream to its end and reading what it wrote."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.session import stored


def arriving(df: DataFrame, part: Column, parts: int, base: str, files: int = 2) -> DataFrame:
    """The table as a file stream that brings the rows of ``part`` 0, 1, ... in turn, one micro-batch each. Every part is
    written as ``files`` files, and as many are read at a time."""
    rows = stored(df.withColumn("_part", part))
    for k in range(parts):
        rows.filter(F.col("_part") == k).drop("_part").repartition(files).write.mode("append").parquet(f"{base}/arriving")
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/arriving")


#: Partitions of a stream's state for each core at most.
STATE_PARTITIONS = 2


@contextmanager
def state_by_cores(spark: SparkSession) -> Iterator[None]:
    """Streams started inside have at most ``STATE_PARTITIONS`` partitions of state for each core. Each one is a store that
    every micro-batch opens, commits and uploads, whether it holds anything or not. The session's own number of shuffle
    partitions is set again afterwards; a stream keeps what it was started with."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), STATE_PARTITIONS * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run_to_table(stream: DataFrame, base: str, mode: str = "append") -> DataFrame:
    """Everything available now through the stream into a parquet table."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
    )
    with state_by_cores(stream.sparkSession):
        query = writer.start(f"{base}/out")
    finish(query)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/out")


def all_batches(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.option("basePath", f"{base}/{table}").parquet(f"{base}/{table}/batch=*")
