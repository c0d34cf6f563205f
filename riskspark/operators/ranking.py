"""Global cumulative sums, exact percentiles and exact ranks without a single-task window.

Rows are first summed per distinct value (map-side combined, so a value shared by a third of all
rows is one cell). Cells are then cut into value buckets; a window runs inside each bucket and the
sums of all earlier buckets are added from a table of one row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor, inf, isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.functions.numeric import hash_uniform

def _bucket_count(df: DataFrame, buckets: int | None) -> int:
    """Twice the shuffle partitions, so the cut follows the size the session is set up for."""
    return buckets or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cut_points(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """Bucket borders by approximate quantiles: one mergeable sketch, a few numbers to the driver."""
    n = _bucket_count(df, buckets)
    probabilities = [i / n for i in range(1, n)] or [0.5]
    found = df.agg(F.percentile_approx(F.col(value).cast("double"), probabilities, 4 * n)).first()[0] or []
    return sorted({c for c in found if isfinite(c)} or {0.0})


def _bucketed(df: DataFrame, value: str, cuts: Sequence[float]) -> DataFrame:
    """Adds ``_bucket`` by a JVM binary search. Null and NaN share one more bucket of their own."""
    splits = [-inf, *cuts, inf]
    bucketizer = Bucketizer(splits=splits, inputCol=value, outputCol="_bucket", handleInvalid="keep")
    return bucketizer.transform(df).withColumn("_bucket", F.col("_bucket").cast("int"))


def _slot(by: Sequence[str]) -> Column:
    """Group and bucket as one key. Struct keys treat nulls as equal, so a null group keeps its rows,
    and the window and the join on the same key share one shuffle."""
    return F.struct(*by, "_bucket")


def cumulative(
    df: DataFrame,
    value: str,
    sums: dict[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """One row per (by, value) with each sum ``s``, its running total ``cum_s`` up to and including
    the value, and the grand total ``total_s``.

    The input is read twice, by the sketch and by the sums, so hand over a stored table when it is
    expensive to compute, or ``cuts`` that are known already.
    """
    cuts = cut_points(df, value, buckets) if cuts is None else cuts
    narrow = df.select(*by, F.col(value).cast("double").alias(value), *[c.alias(n) for n, c in sums.items()])
    rows = _bucketed(narrow, value, cuts)
    cells = rows.groupBy(*by, "_bucket", value).agg(*[F.expr(f"sum(`{n}`) as `{n}`") for n in sums])
    cells = cells.select(_slot(by).alias("_slot"), *by, value, *sums)
    direction = "desc" if descending else "asc"
    group = "partition by " + ", ".join(f"_slot.`{c}`" for c in by) if by else ""
    earlier = f"({group} order by _slot._bucket {direction} rows between unbounded preceding and 1 preceding)"
    # At most one row per bucket and group.
    totals = (
        cells.groupBy("_slot")
        .agg(*[F.expr(f"sum(`{n}`) as `{n}`") for n in sums])
        .selectExpr(
            "_slot",
            *[f"coalesce(sum(`{n}`) over {earlier}, 0) as `_off_{n}`" for n in sums],
            *[f"sum(`{n}`) over ({group}) as `total_{n}`" for n in sums],
        )
    )
    running = f"(partition by _slot order by `{value}` {direction} rows between unbounded preceding and current row)"
    placed = cells.selectExpr("*", *[f"sum(`{n}`) over {running} as `_run_{n}`" for n in sums])
    return placed.join(totals, "_slot").selectExpr(
        *[f"`{c}`" for c in [*by, value, *sums]],
        *[f"`_run_{n}` + `_off_{n}` as `cum_{n}`" for n in sums],
        *[f"`total_{n}`" for n in sums],
    )


def percentile_cells(cells: DataFrame, probabilities: Sequence[float], n: str = "n") -> DataFrame:
    """The few ``cumulative`` cells that hold a wanted rank; the aggregation then has next to no input."""
    listed = ", ".join(f"{float(p)!r}D" for p in probabilities)
    rank = f"p * (total_{n} - 1)"
    return cells.filter(
        F.expr(f"exists(array({listed}), p -> floor({rank}) < cum_{n} and ceil({rank}) >= cum_{n} - {n})")
    )


def percentile_picks(value: str, probabilities: Sequence[float], n: str = "n") -> list[Column]:
    """Aggregates over ``percentile_cells`` from which ``interpolated`` takes the percentiles."""
    first, last = f"cum_{n} - {n}", f"cum_{n} - 1"
    out = []
    for i, p in enumerate(probabilities):
        rank = f"({float(p)!r}D * (total_{n} - 1))"
        for name, at in (("lo", f"floor({rank})"), ("hi", f"ceil({rank})")):
            out.append(F.expr(f"max(if({at} between {first} and {last}, `{value}`, null)) as _{name}{i}"))
        out.append(F.expr(f"max({rank} - floor({rank})) as _part{i}"))
    return out


def interpolated(i: int) -> Column:
    return F.expr(f"_lo{i} + _part{i} * (_hi{i} - _lo{i})")


def exact_percentiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Linearly interpolated percentiles, one row per group with an array column ``percentiles``."""
    cells = cumulative(df.filter(F.col(value).isNotNull()), value, {"n": F.lit(1)}, by, buckets=buckets)
    cells = percentile_cells(cells, probabilities)
    picks = percentile_picks(value, probabilities)
    out = cells.groupBy(*by).agg(*picks) if by else cells.agg(*picks)
    return out.select(*by, F.array(*[interpolated(i) for i in range(len(probabilities))]).alias("percentiles"))


#: Ranks that a sketch may be off by, of so many rows, and values of a bracket that are listed.
SKETCH, FEW = 10_000, 256


def column_percentiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, list[float]]:
    """Exact, linearly interpolated percentiles of many columns at once, nulls left out.

    Two sketched quantiles bracket each rank; counting what lies below and inside them narrows the brackets, each round by
    a factor of thousands, in one wide aggregate over the table. At last the few distinct values inside, with their counts,
    are listed. No value but these is moved. Columns without values have no percentiles.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    sizes = df.agg(*[F.count(v).alias(c) for c, v in values.items()]).first()
    # A bracket holds the values of two neighbouring ranks: [low, high], how many lie below it, and how many inside.
    wanted = {(c, i): p * (sizes[c] - 1) for c in columns for i, p in enumerate(probabilities) if sizes[c]}
    if not wanted:
        return {c: [] for c in columns}
    brackets = {k: (-inf, inf, 0, sizes[k[0]]) for k in wanted}
    todo = set(wanted)
    while todo:
        order = sorted(todo, key=str)
        inside = {k: F.when((values[k[0]] >= brackets[k][0]) & (values[k[0]] <= brackets[k][1]), values[k[0]]) for k in order}

        def around(k: tuple[str, int]) -> Column:
            low, high, below, n = brackets[k]
            ranks = ((floor(wanted[k]) - below) / n - 2 / SKETCH, (ceil(wanted[k]) + 1 - below) / n + 2 / SKETCH)
            return F.percentile_approx(inside[k], [min(1.0, max(0.0, r)) for r in ranks], SKETCH)

        found = df.agg(*[around(k).alias(f"q{n}") for n, k in enumerate(order)]).first()
        narrower = dict(zip(order, found))
        counts = df.agg(
            *[F.count(F.when(values[k[0]] < narrower[k][0], F.lit(1))).alias(f"b{n}") for n, k in enumerate(order)],
            *[F.count(F.when((values[k[0]] >= narrower[k][0]) & (values[k[0]] <= narrower[k][1]), F.lit(1))).alias(f"i{n}") for n, k in enumerate(order)],
        ).first()
        for n, k in enumerate(order):
            before, brackets[k] = brackets[k], (*narrower[k], counts[f"b{n}"], counts[f"i{n}"])
            low, high, _, held = brackets[k]
            if held <= FEW or low == high or held == before[3]:
                todo.discard(k)
    order = sorted(wanted, key=str)
    listed = F.array_compact(F.array(*[
        F.when((values[k[0]] >= brackets[k][0]) & (values[k[0]] <= brackets[k][1]), F.struct(F.lit(n).alias("n"), values[k[0]].alias("value"))) for n, k in enumerate(order)
    ]))
    cells = df.select(F.explode(listed).alias("x")).groupBy("x.n", "x.value").agg(F.count(F.lit(1)).alias("times")).collect()
    held: dict[int, list[tuple[float, int]]] = {}
    for row in cells:
        held.setdefault(row["n"], []).append((row["value"], row["times"]))
    out: dict[str, list[float]] = {c: [] for c in columns}
    for c in columns:
        for i in range(len(probabilities)):
            if (c, i) in wanted:
                n, rank = order.index((c, i)), wanted[c, i]
                low, high = (_at_rank(sorted(held[n]), r - brackets[c, i][2]) for r in (floor(rank), ceil(rank)))
                out[c].append(low + (rank - floor(rank)) * (high - low))
    return out


def _at_rank(cells: Sequence[tuple[float, int]], rank: int) -> float:
    for value, times in cells:
        rank -= times
        if rank < 0:
            return value
    return cells[-1][0]


def hash_rank(
    df: DataFrame, seed: str, key: str = "TransactionID", by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Adds the 0-based rank ``hash_rank`` of each row in a seeded pseudo-random order within its
    group, and the group size ``group_rows``. Hash values are uniform, so equal slices of [0, 1) are
    balanced buckets even when one group holds nearly all rows."""
    buckets = _bucket_count(df, buckets)
    u = hash_uniform(seed, F.col(key), digits=13)
    bucket = F.floor(F.col("_u") * buckets).cast("int").alias("_bucket")

    def placed(rows: DataFrame, *keep: str) -> DataFrame:
        return rows.withColumn("_u", u).select("*", bucket).select(*keep, "_u", _slot(by).alias("_slot"))

    groups = [f"_slot.{c}" for c in by]
    earlier = W.partitionBy(*groups).orderBy("_slot._bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = (
        placed(df)
        .groupBy("_slot")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_slot",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"),
            F.sum("_n").over(W.partitionBy(*groups)).alias("group_rows"),
        )
    )
    inside = W.partitionBy("_slot").orderBy("_u", key)
    ranked = placed(df, *df.columns).withColumn("_place", F.row_number().over(inside) - 1)
    return ranked.join(totals, "_slot").select(
        *df.columns, (F.col("_place") + F.col("_off")).alias("hash_rank"), "group_rows"
    )
