"""Scoring on arrival: JSON records in; scored rows and dead letters out, both from one micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from riskspark.plans.model import RiskModel
from riskspark.plans.scoring import score_batch
from riskspark.sources import io
from riskspark.streaming import velocity
from riskspark.streaming.enrich import parse
from riskspark.streaming.sinks import Sink


class ScoringStream:
    """Every valid record is scored in the micro-batch that brings it, however late it is, with the velocity of what had
    arrived by then; every other record becomes a dead letter of the same micro-batch.

    ``scores`` and ``dead_letters`` receive (rows, batch_id): see ``sinks``. Velocity lives in Spark's state, so a replayed
    micro-batch sees the same history and gives the same rows. A record that is redelivered inside a micro-batch is
    scored once. ``model_path`` adds factors and explanations.
    """

    def __init__(
        self,
        model: RiskModel,
        risk_profile: DataFrame,
        card_stats: DataFrame,
        scores: Sink,
        dead_letters: Sink,
        threshold: float = 0.5,
        topic: str = "transactions",
        keep: Sequence[str] = (),
        model_path: str | None = None,
        hours: Sequence[int] = velocity.HOURS,
    ) -> None:
        self.model, self.threshold, self.topic = model, threshold, topic
        self.risk_profile, self.card_stats = risk_profile, card_stats
        self.scores, self.dead_letters = scores, dead_letters
        self.keep, self.model_path, self.hours = tuple(keep), model_path, tuple(hours)

    def with_history(self, raw: DataFrame) -> DataFrame:
        """The records of a raw stream (value, and ``keep``): valid ones with their velocity, the others with their error."""
        parsed = parse(raw, keep=self.keep)
        good = velocity.velocity_on_arrival(io.valid_rows(parsed), self.hours)
        return good.unionByName(parsed.filter(F.col("error_type").isNotNull()), allowMissingColumns=True)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` function of ``with_history``."""
        batch = batch.persist()
        try:
            self.dead_letters(io.dead_letters(batch, self.topic), batch_id)
            good = io.valid_rows(batch).dropDuplicates(["TransactionID"])
            scored = score_batch(
                good, self.model, self.risk_profile, self.card_stats, threshold=self.threshold, model_path=self.model_path, also=velocity.names(self.hours)
            )
            self.scores(scored.withColumn("scored_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")), batch_id)
        finally:
            batch.unpersist()

    def writer(self, raw: DataFrame, checkpoint: str, **trigger) -> DataStreamWriter:
        """Call ``start`` on it. Every 5 seconds by default."""
        writer = self.with_history(raw).writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
