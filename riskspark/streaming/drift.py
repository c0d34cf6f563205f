"""Stream drift: the newest scores against a baseline, alerts with cooldown, all in Spark's keyed state.

The baseline is read once. Its metrics and bin edges become numbers of the plan, and its distinct scores with their counts
the initial state of the operator that finds each new score's place among them, keyed by slot of the score range. From
then on a micro-batch touches only the state of the slots that its scores fall in. A second operator holds the newest
scores with their places, from which every measure follows; a third holds, for each metric, when it last raised an alert.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from riskspark.operators.drift import EMPTY_SHARE, alerts_of, ks_p_value, psi_edges, side_metrics, sides
from riskspark.session import stored
from riskspark.streaming.velocity import PROVIDER

#: Distinct baseline scores of a slot, and slots at most.
SLOT_CELLS, MOST_SLOTS = 4096, 4096
CELL = np.dtype([("score", "<f8"), ("n", "<i8")])
ROW = np.dtype([("us", "<i8"), ("id", "<i8"), ("score", "<f8"), ("y", "<f8"), ("below", "<i8"), ("upto", "<i8")])
PLACED = "id long, us long, score double, y double, below long, upto long"
MEASURED = "checked_us long, n_current long, ks_stat double, psi double, cur_precision double, cur_recall double, cur_labelled long"


class Places(StatefulProcessor):
    """Key: a slot. How many baseline scores lie below and up to each new score; ``before`` counts those of lower slots."""

    def __init__(self, before: np.ndarray):
        self.before = before

    def init(self, handle) -> None:
        self.cells = handle.getValueState("cells", "rows binary")

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initialState, timerValues) -> None:
        rows = initialState.sort_values("score")
        held = np.empty(len(rows), CELL)
        held["score"], held["n"] = rows["score"], rows["n"]
        self.cells.update((held.tobytes(),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self.cells.get()
        held = np.zeros(0, CELL) if found is None else np.frombuffer(bytes(found[0]), CELL)
        counts = self.before[key[0]] + np.concatenate(([0], np.cumsum(held["n"])))
        for new in rows:
            x = new["score"].to_numpy(float)
            below, upto = (counts[np.searchsorted(held["score"], x, side)] for side in ("left", "right"))
            yield pd.DataFrame({"id": new["id"], "us": new["us"], "score": x, "y": new["y"], "below": below, "upto": upto})


class Newest(StatefulProcessor):
    """One key. The newest ``window`` rows and, for each micro-batch, the measures of them."""

    def __init__(self, window: int, edges: list[float], shares: list[float], n_baseline: int, threshold: float):
        self.window, self.edges, self.shares = window, np.array(edges), np.array(shares)
        self.n_baseline, self.threshold = n_baseline, threshold

    def init(self, handle) -> None:
        self.held = handle.getValueState("rows", "rows binary")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = self.held.get()
        held = np.zeros(0, ROW) if found is None else np.frombuffer(bytes(found[0]), ROW)
        for new in rows:
            more = np.empty(len(new), ROW)
            for c in ROW.names:
                more[c] = new[c].astype(float) if c == "y" else new[c]
            held = newest(np.concatenate((held, more)), self.window)
        self.held.update((held.tobytes(),))
        yield pd.DataFrame([self.measures(held)])

    def measures(self, rows: np.ndarray) -> dict[str, float]:
        x = np.sort(rows["score"])
        n = max(self.n_baseline, 1)
        # Between two points of the window its own curve is flat, so the largest gap is at a point, from either side.
        up = np.abs(rows["upto"] / n - np.searchsorted(x, rows["score"], "right") / len(x))
        low = np.abs(rows["below"] / n - np.searchsorted(x, rows["score"], "left") / len(x))
        bins = np.bincount(np.searchsorted(self.edges, rows["score"], "right"), minlength=len(self.shares)) / len(x)
        b, c = (np.where(s == 0, EMPTY_SHARE, s) for s in (self.shares, bins))
        known, flagged = ~np.isnan(rows["y"]), rows["score"] >= self.threshold
        positive = rows["y"] == 1
        hits = int((flagged & positive).sum())
        return {
            "checked_us": int(rows["us"].max()),
            "n_current": len(rows),
            "ks_stat": float(max(up.max(), low.max())),
            "psi": float(((c - b) * np.log(c / b)).sum()),
            "cur_precision": hits / max(int((flagged & known).sum()), 1),
            "cur_recall": hits / max(int(positive.sum()), 1),
            "cur_labelled": int(known.sum()),
        }


def newest(rows: np.ndarray, window: int) -> np.ndarray:
    return rows[np.lexsort((rows["id"], rows["us"]))[-window:]]


class Cooldown(StatefulProcessor):
    """Key: a metric. Lets an alert pass if the last one that passed is at least ``gap`` microseconds older."""

    def __init__(self, gap: int, columns: list[str]):
        self.gap, self.columns = gap, columns

    def init(self, handle) -> None:
        self.sent = handle.getValueState("sent", "us long")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("sent_us", kind="stable")
        last, passed = self.sent.get(), []
        last = None if last is None else last[0]
        for at in new["sent_us"].tolist():
            passed.append(last is None or at - last >= self.gap)
            last = at if passed[-1] else last
        if any(passed):
            self.sent.update((last,))
            yield new[self.columns][passed]


def cooldown(alerts: DataFrame, seconds: int = 3600) -> DataFrame:
    """The alerts of a stream (metric, sent_us, ...) that are at least ``seconds`` after the last one of their metric that
    was let through. Alerts of one micro-batch are taken in the order of their times."""
    alerts.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in alerts.schema)
    processor = Cooldown(seconds * 1_000_000, alerts.columns)
    return alerts.groupBy("metric").transformWithStateInPandas(processor, schema, "Append", "None")


def drift_alert_stream(
    stream: DataFrame, baseline: DataFrame, window: int = 1000, cooldown_seconds: int = 3600, threshold: float = 0.5
) -> DataFrame:
    """The alerts of a stream of TransactionID, event_time, score, y: after every micro-batch its newest ``window`` scores
    are compared with the baseline. ``sent_us`` is the time of the newest of them."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    scored = stored(baseline.filter("score is not null and not isnan(score)").select(F.col("score").cast("double"), "y"))
    edges = [e for e in psi_edges(scored, "score").first()[0] if e is not None]
    bin_of = sum(((F.col("score") >= e).cast("int") for e in edges), F.lit(0))
    counts = {r["bin"]: r["n"] for r in scored.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    shares = [counts.get(i, 0) / max(n, 1) for i in range(len(edges) + 1)]
    empty = spark.createDataFrame([], scored.schema)
    known = side_metrics(_cells(scored, empty), "score", threshold).first()
    cuts, cells, before = _slots(scored)

    slot = slot_of(cuts, F.col("score"))
    # Per task only the newest rows can be among the newest of all.
    rows = stream.select(F.col("TransactionID").alias("id"), F.unix_micros("event_time").alias("us"), F.col("score").cast("double").alias("score"), F.col("y").cast("double").alias("y"))
    rows = rows.filter("id is not null and us is not null and score is not null and not isnan(score)")
    placed = rows.withColumn("slot", slot).groupBy("slot").transformWithStateInPandas(Places(before), PLACED, "Append", "None", cells.groupBy("slot"))
    few = placed.mapInPandas(lambda batches: _few(batches, window), PLACED)
    measured = few.withColumn("all", F.lit(0)).groupBy("all").transformWithStateInPandas(Newest(window, edges, shares, n, threshold), MEASURED, "Append", "None")
    constants = {"n_baseline": F.lit(n), "base_precision": F.lit(known["base_precision"]), "base_recall": F.lit(known["base_recall"])}
    p = ks_p_value(F.col("ks_stat"), F.lit(n), F.col("n_current"))
    found = alerts_of(measured.withColumns(constants | {"p_value": p}), keep=["checked_us"])
    return cooldown(found.withColumnRenamed("checked_us", "sent_us"), cooldown_seconds)


def _few(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat((held, batch))
        held = held.sort_values(["us", "id"]).tail(window)
    if held is not None:
        yield held


def _cells(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """The counts that ``side_metrics`` needs, a row for each distinct score."""
    both = sides(baseline, current, ["score", "y"])
    sums = {}
    for name, side in (("b", 0), ("c", 1)):
        mine = F.col("current") == side
        sums[name] = F.sum(mine.cast("bigint"))
        sums[f"{name}_pos"] = F.sum(F.coalesce(mine & (F.col("y") == 1), F.lit(False)).cast("bigint"))
        sums[f"{name}_known"] = F.sum((mine & F.col("y").isNotNull()).cast("bigint"))
    return both.groupBy("score").agg(*[c.alias(n) for n, c in sums.items()])


def slot_of(cuts: Sequence[float], value: Column) -> Column:
    """How many of the ordered ``cuts`` a value reaches. The group of cuts is looked for first and then the place in it, so a
    row is compared with few of them however many there are."""
    if not cuts:
        return F.lit(0)
    group = isqrt(len(cuts) - 1) + 1
    reached = lambda some: F.size(F.filter(some, lambda c: c <= value))
    listed = lambda some: F.array(*[F.lit(float(c)) for c in some]).cast("array<double>")
    groups = reached(listed(cuts[group - 1 :: group])) * group
    return groups + reached(F.slice(listed(cuts), groups + 1, group))


def _slots(scored: DataFrame) -> tuple[list[float], DataFrame, np.ndarray]:
    """Borders of the slots, the baseline's distinct scores (slot, score, n), and how many scores lie in lower slots."""
    distinct = scored.select(F.approx_count_distinct("score")).first()[0]
    n = min(MOST_SLOTS, max(1, -(-distinct // SLOT_CELLS)))
    found = scored.select(F.percentile_approx("score", [i / n for i in range(1, n)] or [0.5], 4 * n)).first()[0] if n > 1 else None
    cuts = sorted(set(found or []))
    slot = slot_of(cuts, F.col("score"))
    cells = stored(scored.groupBy("score").agg(F.count("*").alias("n")).select(slot.alias("slot"), "score", "n"))
    counts = np.zeros(len(cuts) + 1, np.int64)
    for row in cells.groupBy("slot").agg(F.sum("n").alias("n")).collect():  # one row per slot
        counts[row["slot"]] = row["n"]
    return cuts, cells, np.cumsum(counts) - counts
