"""Per-card time-range velocity: count, sum and sample std of amounts in ``[t - w, t)``.

A card without more than ``SPARSE`` rows in any block of the longest window goes through plain range windows over its rows:
a row then looks at twice that number of rows at most, and travels once. The other cards go by grains.

By grains, time is cut into grains that divide every window, so a window is a suffix of one grain, some whole
grains, and a prefix of the row's own grain. Prefix and suffix are running aggregates inside
(card, grain), linear in the rows; whole grains come from a pre-aggregated (card, grain) table. Work is
keyed by (card, grain), so a card with a large share of all rows spreads over as many tasks as it has
grains, and no row is compared with another one. A row travels once with its payload and once per window
as a narrow context record. Rows without card or time have no history; they are split off before any
shuffle and get zeros where they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.session import stored

MICROS = 1_000_000
#: Rows of a card in a block of time as long as the longest window, up to which range windows are cheaper than grains.
SPARSE = 64


def velocity(
    df: DataFrame,
    hours: Sequence[int] = (1, 6, 24),
    card: str = "card1",
    time: str = "event_time",
    amount: str = "TransactionAmt",
    grain_seconds: int | None = None,
    count_null_amounts: bool = False,
    history: DataFrame | None = None,
) -> DataFrame:
    """Adds ``velocity_{count,sum,std}_{w}h`` for every window.

    ``history`` adds earlier rows (card, time, amount) to the windows without emitting them.
    Rows without card or time get zeros. ``count_null_amounts`` counts rows instead of amounts.
    ``grain_seconds`` is the greatest common divisor of the windows unless it is given.
    """
    windows = [h * 3600 for h in hours]
    grain = grain_seconds or reduce(gcd, windows)
    if any(w % grain for w in windows):
        raise ValueError("the grain must divide every window")
    placed = F.col(card).isNotNull() & F.col(time).isNotNull()
    payload = F.struct(*[F.col(c) for c in df.columns])
    narrow = [F.col(card).alias("_card"), F.unix_micros(F.col(time)).alias("_us"), F.col(amount).alias("_amt")]
    rows = df.filter(placed).select(*narrow, payload.alias("_row"))
    if history is not None:
        rows = rows.unionByName(history.filter(placed).select(*narrow), allowMissingColumns=True)
    dense = _dense_cards(rows, max(windows))
    if dense.isEmpty():
        done = _ranges(rows, df.columns, hours, windows, count_null_amounts)
    else:
        few, many = rows.join(dense, "_card", "left_anti"), rows.join(dense, "_card", "left_semi")
        done = _ranges(few, df.columns, hours, windows, count_null_amounts).unionByName(
            _grains(many, df.columns, hours, windows, grain, count_null_amounts)
        )
    names = [f"velocity_{stat}_{h}h" for h in hours for stat in ("count", "sum", "std")]
    return done.unionByName(df.filter(~placed).select("*", *[_zero(n).alias(n) for n in names]))


def _zero(name: str) -> Column:
    return F.lit(0).cast("bigint") if "_count_" in name else F.lit(0.0)


def _dense_cards(rows: DataFrame, longest: int) -> DataFrame:
    """Cards with more than ``SPARSE`` rows in a block of time. Stored, so that its size decides how it is joined."""
    block = F.floor(F.col("_us") / (longest * MICROS)).alias("_block")
    counts = rows.groupBy("_card", block).agg(F.count(F.lit(1)).alias("_n"))
    return stored(counts.filter(F.col("_n") > SPARSE).select("_card").distinct())


def _ranges(rows: DataFrame, columns, hours, windows, count_null_amounts) -> DataFrame:
    """Range windows over the rows of each card."""
    stats: dict[str, Column] = {}
    for h, w in zip(hours, windows):
        frame = W.partitionBy("_card").orderBy("_us").rangeBetween(-w * MICROS, -1)
        stats[f"velocity_count_{h}h"] = F.count(F.lit(1) if count_null_amounts else F.col("_amt")).over(frame)
        stats[f"velocity_sum_{h}h"] = F.sum("_amt").over(frame)
        stats[f"velocity_std_{h}h"] = F.stddev_samp("_amt").over(frame)
    found = rows.select("_row", *[c.alias(n) for n, c in stats.items()]).filter("_row is not null")
    keep = [F.col("_row")[c].alias(c) for c in columns]
    return found.select(*keep, *[F.coalesce(F.col(n), _zero(n)).alias(n) for n in stats])


def _grains(rows: DataFrame, columns, hours, windows, grain, count_null_amounts) -> DataFrame:
    grain_us = grain * MICROS

    # Shift 0 is the row itself, shift w the record that leaves the w-window of later rows.
    shifts = F.array(*[F.lit(w) for w in [0, *windows]])
    if not count_null_amounts:
        shifts = F.when(F.col("_amt").isNotNull(), shifts).otherwise(F.array(F.lit(0)))
    at = F.col("_us") + F.col("_shift").cast("bigint") * MICROS
    records = rows.withColumn("_shift", F.explode(shifts)).select(
        "_card",
        at.alias("_at"),
        F.floor(at / grain_us).alias("_grain"),
        "_shift",
        "_amt",
        F.when(F.col("_shift") == 0, F.col("_row")).alias("_row"),
    )

    own = W.partitionBy("_card", "_grain").orderBy("_at")
    before = own.rangeBetween(W.unboundedPreceding, -1)
    # Descending order with peers: context records at or after this row's time are still inside.
    since = W.partitionBy("_card", "_grain").orderBy(F.col("_at").desc()).rangeBetween(
        W.unboundedPreceding, W.currentRow
    )
    pieces = _moments("_pre", 0, before, count_null_amounts)
    for w in windows:
        pieces |= _moments(f"_suf{w}", w, since, count_null_amounts)
    targets = (
        records.select("_card", "_grain", "_shift", "_row", *[c.alias(n) for n, c in pieces.items()])
        .filter((F.col("_shift") == 0) & F.col("_row").isNotNull())
        .drop("_shift")
    )

    whole = _whole_grains(rows, windows, grain, grain_us, count_null_amounts)
    joined = targets if whole is None else targets.join(whole, ["_card", "_grain"], "left")

    stats: dict[str, Column] = {}
    for h, w in zip(hours, windows):
        parts = ["_pre", f"_suf{w}"] + ([f"_mid{w}"] if w > grain else [])
        n, mean, m2 = _merge([_piece(p) for p in parts])
        total = sum((F.coalesce(F.col(f"{p}_s"), F.lit(0.0)) for p in parts), F.lit(0.0))
        rows_in = sum((F.coalesce(F.col(f"{p}_c"), F.lit(0)) for p in parts), F.lit(0))
        stats[f"velocity_count_{h}h"] = rows_in.cast("bigint")
        stats[f"velocity_sum_{h}h"] = total
        stats[f"velocity_std_{h}h"] = F.when(n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1)))
    keep = [F.col("_row")[c].alias(c) for c in columns]
    return joined.select(*keep, *[F.coalesce(c, _zero(n)).alias(n) for n, c in stats.items()])


def _moments(prefix: str, shift: int, window, count_null_amounts: bool) -> dict[str, Column]:
    mine = F.col("_shift") == shift
    amt = F.when(mine, F.col("_amt"))
    return {
        f"{prefix}_c": F.count(F.when(mine, F.lit(1)) if count_null_amounts else amt).over(window),
        f"{prefix}_n": F.count(amt).over(window).cast("double"),
        f"{prefix}_s": F.sum(amt).over(window),
        f"{prefix}_v": F.var_pop(amt).over(window),
    }


def _piece(prefix: str) -> tuple[Column, Column, Column]:
    """(n, mean, M2) of one piece, zeros when it is empty."""
    n = F.coalesce(F.col(f"{prefix}_n"), F.lit(0.0))
    mean = F.coalesce(F.try_divide(F.col(f"{prefix}_s"), F.col(f"{prefix}_n")), F.lit(0.0))
    return n, mean, F.coalesce(F.col(f"{prefix}_v") * F.col(f"{prefix}_n"), F.lit(0.0))


def _merge(pieces: list[tuple[Column, Column, Column]]) -> tuple[Column, Column, Column]:
    """Joins disjoint pieces around their common mean, so no large squares cancel."""
    n = sum((p[0] for p in pieces), F.lit(0.0))
    mean = F.coalesce(F.try_divide(sum((p[0] * p[1] for p in pieces), F.lit(0.0)), n), F.lit(0.0))
    m2 = sum((p[2] + p[0] * (p[1] - mean) * (p[1] - mean) for p in pieces), F.lit(0.0))
    return n, mean, m2


def _whole_grains(rows, windows, grain, grain_us, count_null_amounts) -> DataFrame | None:
    """Moments of the whole grains strictly between suffix and prefix, per (card, grain)."""
    wide = [w for w in windows if w > grain]
    if not wide:
        return None
    cells = rows.groupBy("_card", F.floor(F.col("_us") / grain_us).alias("_grain")).agg(
        F.count(F.lit(1) if count_null_amounts else F.col("_amt")).alias("c"),
        F.count("_amt").cast("double").alias("n"),
        F.sum("_amt").alias("s"),
        F.var_pop("_amt").alias("v"),
    )
    # Grain means are taken relative to the card's mean grain, which keeps the sum of squares small.
    card_all = W.partitionBy("_card")
    mean = F.try_divide(F.col("s"), F.col("n"))
    cells = cells.withColumn("d", mean - F.avg(mean).over(card_all))
    out = [F.col("_card"), F.col("_grain")]
    ordered = W.partitionBy("_card").orderBy("_grain")
    for w in wide:
        frame = ordered.rangeBetween(-(w // grain) + 1, -1)
        n, sd = F.sum("n").over(frame), F.sum(F.col("n") * F.col("d")).over(frame)
        within = F.sum(F.col("n") * F.col("v")).over(frame)
        between = F.sum(F.col("n") * F.col("d") * F.col("d")).over(frame) - F.try_divide(sd * sd, n)
        out += [
            F.sum("c").over(frame).alias(f"_mid{w}_c"),
            n.alias(f"_mid{w}_n"),
            F.sum("s").over(frame).alias(f"_mid{w}_s"),
            F.try_divide(within + F.greatest(between, F.lit(0.0)), n).alias(f"_mid{w}_v"),
        ]
    return cells.select(*out)
