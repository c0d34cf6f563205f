"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "riskspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution.

    On a cluster ``master`` stays unset and sizing (executors, shuffle partitions) comes from
    spark-submit; tests pass ``local[n]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config(
            "spark.ui.showConsoleProgress", "false"
        )
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a fresh one when it is unset."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is None:
        if not configured and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="riskspark-"))
        current = context.getCheckpointDir()
    return configured or current


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared storage."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_opened: ContextVar[list[str] | None] = ContextVar("_opened", default=None)


def stored(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back: lineage is cut, lost executors cost
    nothing, and later reads are columnar with known sizes. Unlike an eager checkpoint the input is
    computed once."""
    path = new_dir(df.sparkSession, "stored")
    opened = _opened.get()
    if opened is not None:
        opened.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Fits that run at the same time: a fit is a row of many short jobs, which leave cores idle between them.
TOGETHER = 4


def at_once(work: Callable[[Any], Any], items: Iterable[Any], together: int = TOGETHER) -> list[Any]:
    """The results of ``work`` on each item, in order of the items. Jobs are submitted from ``together`` threads, and Spark
    shares the cores among them."""
    session = SparkSession.getActiveSession()
    with ThreadPoolExecutor(together) as pool:
        runs = [pool.submit(copy_context().run, inheritable_thread_target(session)(work), item) for item in items]
        return [run.result() for run in runs]


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that ``stored`` wrote inside, so that a stream that runs for months leaves
    nothing behind. Results must have been written or collected by then."""
    token = _opened.set([])
    try:
        yield
    finally:
        delete_paths(spark, _opened.get() or [])
        _opened.reset(token)


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
