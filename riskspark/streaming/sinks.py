"""Where micro-batches go: tables and topics that a replayed batch does not fill twice."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.sources import io
from riskspark.streaming import tables

#: Receives the rows of a micro-batch and its number; it may see a batch again after a failure.
Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class TableSink:
    """A batch-numbered table: writing a batch again replaces it."""

    base: str
    table: str

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        tables.put(rows, self.base, self.table, batch_id)


@dataclass(frozen=True)
class TopicSink:
    """(key, JSON value) records for a topic.

    A broker keeps what a failed attempt has sent, so every value carries its ``batch_id``: with the key it names a record,
    and a reader keeps one of each. ``fmt="kafka"`` takes ``kafka.bootstrap.servers`` and ``topic`` as options; file
    formats take a ``path`` and write one folder a batch, which a replay replaces.
    """

    key: str
    fmt: str = "kafka"
    options: dict[str, str] = field(default_factory=dict)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        records = io.to_json_records(rows.withColumn("batch_id", F.lit(batch_id)), self.key)
        options = dict(self.options)
        path = options.pop("path", None)
        writer = records.write.format(self.fmt).options(**options)
        if path is None:
            writer.mode("append").save()
        else:
            writer.mode("overwrite").save(f"{path}/batch={batch_id}")


def to_all(*sinks: Sink) -> Sink:
    def write(rows: DataFrame, batch_id: int) -> None:
        for sink in sinks:
            sink(rows, batch_id)

    return write
