"""Exact per-event velocity on a stream, in Spark's own keyed state.

State is keyed by slot, a hash of the card, and time block, a block being as long as the longest window, so a window touches
the block of its event and the one before. Every event therefore travels twice: to its own block, where it will be emitted,
and as context to the next one. A key holds many cards, whose windows are taken together; the rows of a micro-batch are one
value of its state, so state is read and written a few times for a key, whatever number of events it gets. Cards with
long windows go by time grains that divide every window: a window is the end of one grain, some whole grains of which only
count, sum and spread are needed, and the beginning of the event's own grain.

``velocity_in_order`` holds an event until Spark's watermark has passed it, when all earlier events of its card have
arrived, so its windows equal the batch operator's. Later ones are dropped by Spark. ``velocity_on_arrival`` emits every
event in its own micro-batch, however late, with the windows over what had arrived by then, its own micro-batch included.
There the blocks share a ring of ``RING`` keys for each slot. After a micro-batch a key forgets what lies more than two
blocks behind a card's newest event, so what is kept of a card is bounded without any clock.

Watermark, timers, checkpoints and replay are Spark's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from riskspark.operators.velocity import MICROS

HOURS = (1, 6, 24)
RING = 8
SLOTS = 16
#: Windows of up to so many events are added up event by event, in order of time.
SHORT = 64
#: Values of a key's state before they are put together.
PIECES = 16
AMOUNTS = np.dtype([("at", "<i8"), ("amount", "<f8")])
CELLS = np.dtype([("grain", "<i8"), ("n", "<f8"), ("sum", "<f8"), ("mean", "<f8"), ("m2", "<f8")])
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def names(hours: Sequence[int]) -> list[str]:
    return [f"velocity_{stat}_{h}h" for h in hours for stat in ("count", "sum", "std")]


class Windows:
    """The amounts of a key by grain, and windows over them. ``read`` gives a grain's stored amounts, ``cells`` all sums."""

    def __init__(self, hours: Sequence[int], read, cells: np.ndarray):
        self.spans = [h * 3600 * MICROS for h in hours]
        self.grain = reduce(gcd, self.spans)
        self.read, self.rows, self.cells = read, {}, cells

    def amounts(self, grain: int) -> np.ndarray:
        if grain not in self.rows:
            data = self.read(grain)
            self.rows[grain] = np.frombuffer(data, AMOUNTS) if data else np.zeros(0, AMOUNTS)
        return self.rows[grain]

    def add(self, at: np.ndarray, amount: np.ndarray) -> list[int]:
        """Adds amounts, of which none is missing; returns the grains that changed."""
        grains = at // self.grain
        changed = np.unique(grains).tolist()
        for g in changed:
            mine = grains == g
            new = np.empty(int(mine.sum()), AMOUNTS)
            new["at"], new["amount"] = at[mine], amount[mine]
            rows = np.concatenate((self.amounts(g), new))
            self.rows[g] = rows[np.argsort(rows["at"], kind="stable")]
        kept = self.cells[~np.isin(self.cells["grain"], changed)]
        fresh = np.empty(len(changed), CELLS)
        for cell, g in zip(fresh, changed, strict=True):
            a = self.rows[g]["amount"]
            cell["grain"], cell["n"], cell["sum"], cell["mean"], cell["m2"] = g, len(a), a.sum(), a.mean(), ((a - a.mean()) ** 2).sum()
        self.cells = np.concatenate((kept, fresh))
        return changed

    def over(self, at: np.ndarray) -> dict[str, np.ndarray]:
        """Count, sum and sample deviation of the amounts in [t - span, t) for each span and each time t."""
        out = np.zeros((len(self.spans), 3, len(at)))
        grains = at // self.grain
        for g in np.unique(grains).tolist():
            mine = np.flatnonzero(grains == g)
            own, t = self.amounts(g), at[mine]
            for k, span in enumerate(self.spans):
                edge = self.amounts(g - span // self.grain)
                before = self.cells[(self.cells["grain"] > g - span // self.grain) & (self.cells["grain"] < g)]
                out[k][:, mine] = self._pieces(own, edge, before, t, t - span)
        return out

    @staticmethod
    def _pieces(own: np.ndarray, edge: np.ndarray, whole: np.ndarray, upto: np.ndarray, since: np.ndarray) -> np.ndarray:
        n_whole = whole["n"].sum()
        seen = np.concatenate((own["amount"], edge["amount"], whole["mean"]))
        centre = seen.mean() if len(seen) else 0.0

        def running(rows: np.ndarray) -> list[np.ndarray]:
            a = rows["amount"]
            return [np.concatenate(([0.0], np.cumsum(x))) for x in (a, a - centre, (a - centre) ** 2)]

        first, last = np.searchsorted(own["at"], upto, "left"), np.searchsorted(edge["at"], since, "left")
        n = first + (len(edge) - last) + n_whole
        mine, theirs = running(own), running(edge)
        total, off, square = (x[first] + y[-1] - y[last] for x, y in zip(mine, theirs, strict=True))
        total = total + whole["sum"].sum()
        off = off + (whole["n"] * (whole["mean"] - centre)).sum()
        square = square + (whole["m2"] + whole["n"] * (whole["mean"] - centre) ** 2).sum()
        spread = np.maximum(square - off * off / np.maximum(n, 1), 0) / np.maximum(n - 1, 1)
        return np.stack((n, np.where(n > 0, total, 0.0), np.where(n > 1, np.sqrt(spread), 0.0)))


def windows_of_cards(hours: Sequence[int], known: pd.DataFrame, wanted: pd.DataFrame) -> np.ndarray:
    """Count, sum and sample deviation in [t - span, t) for each span and each of ``wanted`` (card, at), over ``known``
    (card, at, amount), of which no amount is missing."""
    spans = [h * 3600 * MICROS for h in hours]
    codes = pd.factorize(pd.concat([known["card"], wanted["card"]]))[0]
    order = np.lexsort((known["at"].to_numpy(), codes[: len(known)]))
    card, mine = codes[: len(known)][order], codes[len(known) :]
    at, amount, upto = known["at"].to_numpy(np.int64)[order], known["amount"].to_numpy(float)[order], wanted["at"].to_numpy(np.int64)
    # Card and time as one number: times are counted, so that the product stays small.
    times = np.unique(np.concatenate([at, upto, *(upto - span for span in spans)]))
    place = lambda c, t: c.astype(np.int64) * len(times) + np.searchsorted(times, t)
    placed, last = place(card, at), place(mine, upto)
    end = np.searchsorted(placed, last, "left")
    out = np.zeros((len(spans), 3, len(upto)))
    long = np.zeros(len(upto), bool)
    for k, span in enumerate(spans):
        start = np.searchsorted(placed, place(mine, upto - span), "left")
        n = end - start
        long |= n > SHORT
        total, square = np.zeros(len(upto)), np.zeros(len(upto))
        for i in range(min(SHORT, int(n.max(initial=0)))):
            has = np.flatnonzero(n > i)
            total[has] += amount[start[has] + i]
        mean = total / np.maximum(n, 1)
        for i in range(min(SHORT, int(n.max(initial=0)))):
            has = np.flatnonzero(n > i)
            square[has] += (amount[start[has] + i] - mean[has]) ** 2
        out[k] = n, total, np.sqrt(square / np.maximum(n - 1, 1))
    for c in np.unique(mine[long]).tolist():
        rows = slice(*np.searchsorted(card, [c, c + 1]))
        windows = Windows(hours, lambda grain: None, np.zeros(0, CELLS))
        windows.add(at[rows], amount[rows])
        own = np.flatnonzero(long & (mine == c))
        out[:, :, own] = windows.over(upto[own])
    return out


def _written(rows: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


class VelocityState(StatefulProcessor):
    """Amounts of the cards of a slot around one block; with ``in_order`` also the events that wait for the watermark."""

    def __init__(self, hours: Sequence[int], in_order: bool):
        self.hours, self.in_order = tuple(hours), in_order
        self.block = max(hours) * 3600 * MICROS
        self.columns = ["card", "at", "amount"] + (["row"] if in_order else [])

    def init(self, handle) -> None:
        self.handle = handle
        # Rows of one or more micro-batches each; of an event that is not emitted here, ``row`` is null.
        self.pieces = handle.getListState("pieces", "rows binary")
        if self.in_order:
            self.passed = handle.getValueState("passed", "at long")
            self.timer = handle.getValueState("timer", "at long")

    def close(self) -> None:
        pass

    def _read(self) -> list[pd.DataFrame]:
        return [pa.ipc.open_stream(bytes(piece[0])).read_pandas() for piece in self.pieces.get()]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        new = pd.DataFrame({"card": new["s_card"], "at": new["s_at"].astype(np.int64), "amount": new["s_amount"].astype(float), "row": new["s_row"], "mine": new["s_mine"]})
        if self.in_order:
            self.pieces.appendValue((_written(new[self.columns]),))
            self._wake(min([*new["at"][new["mine"]].tolist(), (key[1] + 1) * self.block]))
            return
        fresh = new.loc[new["amount"].notna(), self.columns]
        pieces = self._read()
        known = pd.concat([*pieces, fresh], ignore_index=True)
        mine = new[new["mine"]]
        if len(mine):
            yield self._emitted(known, mine)
        # Only now, since one micro-batch may bring events of blocks that share this key.
        kept = known[known["at"] >= known.groupby("card")["at"].transform("max") - 2 * self.block]
        if len(kept) < len(known) or len(pieces) >= PIECES:
            self.pieces.put([(_written(kept),)])
        elif len(fresh):
            self.pieces.appendValue((_written(fresh),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        upto, held = timerValues.getCurrentWatermarkInMs() * 1000, self.passed.get()
        pieces = self._read()
        rows = pd.concat(pieces, ignore_index=True)
        waiting = rows[rows["row"].notna() & (rows["at"] > (held[0] if held is not None else np.iinfo(np.int64).min))]
        due, rest = waiting[waiting["at"] <= upto], waiting["at"][waiting["at"] > upto]
        if len(due):
            yield self._emitted(rows[rows["amount"].notna()], due.sort_values("at", kind="stable"))
        end = (key[1] + 1) * self.block
        if upto >= end and not len(rest):
            self.pieces.clear()
            self.passed.clear()
            return
        # Spark drops what comes at or before the watermark, so nothing joins those that have been emitted.
        self.passed.update((upto,))
        if len(pieces) >= PIECES:
            rows["row"] = rows["row"].where(rows["at"] > upto, None)
            self.pieces.put([(_written(rows),)])
        self._wake(min([*rest.tolist(), max(end, upto + 1)]))

    def _wake(self, at: int) -> None:
        """One timer, at the first waiting event or at the end of the block, when nothing more can come."""
        at_ms, held = -(-int(at) // 1000), self.timer.get()
        if held is not None and held[0] <= at_ms:
            return
        if held is not None:
            self.handle.deleteTimer(held[0])
        self.handle.registerTimer(at_ms)
        self.timer.update((at_ms,))

    def _emitted(self, known: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = windows_of_cards(self.hours, known, wanted)
        out = {"s_row": wanted["row"].tolist()}
        for k, h in enumerate(self.hours):
            out[f"velocity_count_{h}h"] = found[k, 0].astype(np.int64)
            out[f"velocity_sum_{h}h"], out[f"velocity_std_{h}h"] = found[k, 1], found[k, 2]
        return pd.DataFrame(out)


def velocity_in_order(
    stream: DataFrame, hours: Sequence[int] = HOURS, late: str = "1 hour", card: str = "card1", time: str = "event_time", amount: str = "TransactionAmt"
) -> DataFrame:
    """The stream's rows with ``velocity_{count,sum,std}_{h}h``, emitted when the watermark ``late`` behind the newest
    event has passed them. Rows without card or time have zeros and do not wait."""
    return _velocity(stream.withWatermark(time, late), hours, card, time, amount, VelocityState(hours, True), "EventTime")


def velocity_on_arrival(
    stream: DataFrame, hours: Sequence[int] = HOURS, card: str = "card1", time: str = "event_time", amount: str = "TransactionAmt"
) -> DataFrame:
    """The stream's rows with their windows over what has arrived, in the micro-batch that brings them. Of a card that has
    newer events ``RING`` - 2 blocks later, older ones may be forgotten already."""
    return _velocity(stream, hours, card, time, amount, VelocityState(hours, False), "None")


def _velocity(stream, hours, card, time, amount, processor: VelocityState, mode: str) -> DataFrame:
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    fields = stream.schema.fields
    stamps = {f.name for f in fields if isinstance(f.dataType, T.TimestampType)}
    # A row waits as JSON; timestamps as microseconds, since their text has fewer digits.
    packed = F.to_json(F.struct(*[(F.unix_micros(f.name) if f.name in stamps else F.col(f.name)).alias(f.name) for f in fields]))
    narrow = T.StructType([T.StructField(f.name, T.LongType() if f.name in stamps else f.dataType) for f in fields])
    placed = F.col(card).isNotNull() & F.col(time).isNotNull()
    at = F.unix_micros(time)
    block = F.floor(at / F.lit(max(hours) * 3600 * MICROS))
    both = F.array(F.struct(block.alias("block"), F.lit(True).alias("mine")), F.struct((block + 1).alias("block"), F.lit(False).alias("mine")))
    slot = F.pmod(F.xxhash64(F.col(card).cast("string")), F.lit(SLOTS)).cast("int")
    sent = stream.filter(placed).select(time, slot.alias("s_slot"), F.col(card).cast("string").alias("s_card"), at.alias("s_at"), F.col(amount).cast("double").alias("s_amount"), packed.alias("s_row"), F.explode(both).alias("s_to"))
    sent = sent.select("*", F.col("s_to.block").alias("s_block"), F.col("s_to.mine").alias("s_mine")).drop("s_to")
    # Only the copy that will be emitted carries its row.
    sent = sent.withColumn("s_row", F.when(F.col("s_mine"), F.col("s_row")))
    if not processor.in_order:
        sent = sent.withColumn("s_block", F.pmod("s_block", F.lit(RING).cast("bigint")))
    out = "s_row string, " + ", ".join(f"{n} {'bigint' if '_count_' in n else 'double'}" for n in names(hours))
    found = sent.groupBy("s_slot", "s_block").transformWithStateInPandas(processor, out, "Append", mode)
    row = F.from_json("s_row", narrow).alias("r")
    found = found.select(row, *names(hours)).select(
        *[(F.timestamp_micros(F.col(f"r.{f.name}")) if f.name in stamps else F.col(f"r.{f.name}")).alias(f.name) for f in fields], *names(hours)
    )
    zeros = [(F.lit(0).cast("bigint") if "_count_" in n else F.lit(0.0)).alias(n) for n in names(hours)]
    return found.unionByName(stream.filter(~placed).select("*", *zeros))
