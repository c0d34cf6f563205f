"""Synthetic minority rows between a minority row and one of its nearest minority neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.functions.numeric import hash_uniform
from riskspark.operators.ranking import hash_rank
from riskspark.session import stored

#: Rows of a block that are compared with it at once, which bounds the matrix of a task.
TOGETHER = 256
#: Rows of a cell, which bounds the memory of a task, and of the parts that a cell is cut into.
CELL_ROWS, PART_ROWS = 32_768, 512
#: Rows that decide where cells are cut. No result depends on them.
CUT_ROWS = 20_000


def nearest_neighbours(
    rows: DataFrame, k: int = 5, key: str = "TransactionID", values: str = "values", block_rows: int = 2048, lines: int = 12, seed: int = 42
) -> DataFrame:
    """``key, rank, neighbour, distance`` of the ``k`` nearest other rows. Equal distances are ordered by key.

    Rows are put in order along a few random directions, and on each of them cut into blocks by rank. A row is compared
    exactly with all rows of its block and with the nearer halves of both neighbouring blocks, and every block is one
    bounded matrix product. What the lines have found is merged; then the neighbours of a row's neighbours are tried as
    its own once. This is all while the rows fit a block. Otherwise it bounds how far a row's neighbours can be, and every
    row within that bound is looked at (``_within_reach``).
    """
    vectors = stored(rows.select(F.col(key).cast("long").alias("id"), F.col(values).alias("v")).filter("id is not null and v is not null"))
    found = stored(_best(_along_lines(_projected(vectors, lines, seed), lines, block_rows, k), k))
    # What a neighbour's neighbours add: at most k * k pairs a row.
    ahead = found.select(F.col("id").alias("neighbour"), F.col("neighbour").alias("further"))
    pairs = found.select("id", "neighbour").join(ahead, "neighbour").select("id", F.col("further").alias("neighbour")).filter("id <> neighbour")
    pairs = pairs.distinct().join(found.select("id", "neighbour"), ["id", "neighbour"], "left_anti")
    mine, theirs = vectors.toDF("id", "v"), vectors.toDF("neighbour", "w")
    square = F.aggregate(F.zip_with("v", "w", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    tried = pairs.join(mine, "id").join(theirs, "neighbour").select("id", "neighbour", F.sqrt(square).alias("distance"))
    merged = _best(found.select("id", "neighbour", "distance").unionByName(tried), k)
    if vectors.count() > block_rows:
        merged = stored(merged)
        merged = _best(merged.select("id", "neighbour", "distance").unionByName(_within_reach(vectors, merged, k)), k)
    return merged.select(F.col("id").alias(key), "rank", "neighbour", "distance")


def _within_reach(vectors: DataFrame, found: DataFrame, k: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """id, neighbour, distance: at least the ``k`` nearest of each row, given ``k`` others of each row (fewer if there are no more).

    The ``k``-th of those is how far a row has to look. Rows are dealt to cells of neighbouring rows. Two cells meet unless
    the boxes around them are further apart than any row of the first has to look, and so do the parts of two cells.
    """
    far = found.filter(F.col("rank") == k).select("id", F.col("distance").alias("reach"))
    rows = stored(_in_cells(vectors.join(far, "id", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf")))), cell_rows))
    width = rows.agg(F.max(F.size("v"))).first()[0]
    sides = [F.array(*[side(F.get("v", F.lit(i))) for i in range(width)]) for side in (F.min, F.max)]
    boxes = stored(rows.groupBy("cell").agg(sides[0].alias("low"), sides[1].alias("high"), F.max("reach").alias("reach")))
    mine, theirs = boxes.toDF("mine", "low", "high", "reach"), boxes.select("cell", "low", "high").toDF("theirs", "low_", "high_")
    gaps = F.zip_with(F.zip_with("low_", "high", lambda a, b: a - b), F.zip_with("low", "high_", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0)))
    apart = F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x * x))
    # Written so that what can't be compared meets, and with room for rounding.
    meet = stored(mine.crossJoin(theirs).filter(~F.coalesce(apart * (1 - 1e-9) > F.col("reach"), F.lit(False))).select("mine", "theirs"))
    # Of equal vectors those with the lowest ids come first for every row, so no more than k and the row itself are met.
    first = F.row_number().over(W.partitionBy("v").orderBy("id"))
    met = rows.select("id", "v", "cell").distinct().withColumn("first", first).filter(F.col("first") <= k + 1)
    left = rows.join(meet, F.col("cell") == F.col("mine")).select("mine", "theirs", "id", "v", "reach").toDF("mine", "theirs", "id", "v", "reach")
    right = met.join(meet, F.col("cell") == F.col("theirs")).select("mine", "theirs", "id", "v").toDF("of", "cell", "id", "v")

    def closest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        made = []
        if len(a) and len(b):
            x, y = np.stack(a["v"].to_numpy()), np.stack(b["v"].to_numpy())
            made = list(within_reach(a["id"].to_numpy(), x, a["reach"].to_numpy(), b["id"].to_numpy(), y, k))
        columns = [np.concatenate(c) for c in zip(*made)] or [np.zeros(0)] * 3
        return pd.DataFrame(dict(zip(("id", "neighbour", "distance"), columns)))

    return left.groupBy("mine", "theirs").cogroup(right.groupBy("of", "cell")).applyInPandas(closest, "id long, neighbour long, distance double")


def _in_cells(rows: DataFrame, cell_rows: int) -> DataFrame:
    """Adds ``cell``: rows near each other, of about ``cell_rows`` at most. Larger ones are cut by a hash."""
    total = rows.count()
    # Enough cells that their pairs keep all cores busy, unless they would be smaller than a block.
    cell_rows = min(cell_rows, max(2048, total / (2 * rows.sparkSession.sparkContext.defaultParallelism ** 0.5)))
    share = hash_uniform("cells", F.col("id"))
    some = rows.filter(share < CUT_ROWS / max(total, 1)).select("v").limit(2 * CUT_ROWS).toPandas()["v"]
    cuts = _cuts(np.stack(some.to_numpy()), int(np.ceil(np.log2(max(total / cell_rows, 1))))) if len(some) else []

    def deal(batches):
        for batch in batches:
            if len(batch):
                data, at = np.stack(batch["v"].to_numpy()), np.zeros(len(batch), np.int64)
                for level in cuts:
                    column, border = np.array([c for c, _ in level]), np.array([b for _, b in level])
                    at = 2 * at + (data[np.arange(len(at)), column[at]] > border[at])
                yield batch.assign(cell=at)

    dealt = stored(rows.mapInPandas(deal, "id long, v array<double>, reach double, cell long"))
    parts = dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(1.5 * cell_rows)).alias("parts"))
    part = F.floor(hash_uniform("part", F.col("id")) * F.col("parts"))
    return dealt.join(parts, "cell").withColumn("cell", F.concat_ws("-", F.col("cell"), part))


def _cuts(data: np.ndarray, levels: int) -> list[list[tuple[int, float]]]:
    """Column and border of each group of rows on each level: groups are halved at the median of their widest column."""
    groups, cuts = [data], []
    for _ in range(levels):
        level, halves = [], []
        for rows in groups:
            column = int(np.argmax(np.nan_to_num(rows.std(0)))) if len(rows) else 0
            border = float(np.median(rows[:, column])) if len(rows) else 0.0
            level.append((column, border))
            high = rows[:, column] > border
            halves += [rows[~high], rows[high]]
        groups = halves
        cuts.append(level)
    return cuts


def _parts(data: np.ndarray, size: int) -> list[np.ndarray]:
    """The places of the rows in groups of neighbouring rows of ``size`` at most."""
    done, open_ = [], [np.arange(len(data))]
    while open_:
        at = open_.pop()
        if len(at) <= size:
            done.append(at)
            continue
        column, half = int(np.argmax(np.nan_to_num(np.ptp(data[at], 0)))), len(at) // 2
        order = np.argpartition(data[at, column], half)
        open_ += [at[order[:half]], at[order[half:]]]
    return done


def within_reach(
    mine: np.ndarray, a: np.ndarray, reach: np.ndarray, ids: np.ndarray, b: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of rows ``a`` (named ``mine``) the ``k`` nearest of rows ``b`` (named ``ids``) that are no further away than ``reach``,
    and some that are next: names, names of neighbours and distances."""
    parts, repeated = _parts(b, PART_ROWS), len(np.unique(ids)) < len(ids)
    low, high = (np.stack([f(b[p], 0) for p in parts]) for f in (np.min, np.max))
    squares = (b * b).sum(1)
    for slice_ in _parts(a, TOGETHER):
        x, far = a[slice_], reach[slice_] * (1 + 1e-9)
        gap = np.maximum(np.maximum(low - x.max(0), x.min(0) - high), 0)
        near = [parts[p] for p in np.flatnonzero(~((gap * gap).sum(1) > far.max() ** 2))]
        own = (x * x).sum(1)
        # The products are rounded: what is close to the bound is taken in, and decided about by its exact distance.
        bound = far * far - own * (1 - 1e-9)
        for start in range(0, len(near), 16):
            at = np.concatenate(near[start : start + 16])
            square = (-2 * x) @ b[at].T
            square += squares[at] * (1 - 1e-9)
            rows, places = np.nonzero(~(square > bound[:, None]))
            other = mine[slice_[rows]] != ids[at[places]]
            rows, places = rows[other], at[places[other]]
            # Few rows at once when they have many others within reach.
            cuts = [0, len(rows)] if len(rows) <= 1 << 16 else np.searchsorted(rows, np.arange(0, len(x) + 8, 8))
            for first, last in zip(cuts[:-1], cuts[1:]):
                row, place = rows[first:last], places[first:last]
                distance = np.sqrt(((x[row] - b[place]) ** 2).sum(1))
                order = np.lexsort((ids[place], distance, row))
                order = order[distance[order] <= far[row[order]]]
                row, place, distance = row[order], place[order], distance[order]
                if repeated:
                    once = ~pd.DataFrame({"row": row, "id": ids[place]}).duplicated().to_numpy()
                    row, place, distance = row[once], place[once], distance[once]
                few = np.arange(len(row)) - np.searchsorted(row, row) < k
                if few.any():
                    yield mine[slice_[row[few]]], ids[place[few]], distance[few]


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """id, rank, neighbour, distance: the ``k`` nearest of each row."""
    order = W.partitionBy("id").orderBy("distance", "neighbour")
    once = pairs.groupBy("id", "neighbour").agg(F.min("distance").alias("distance"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("id", "rank", "neighbour", "distance")


def _projected(vectors: DataFrame, lines: int, seed: int) -> DataFrame:
    """id, v, line, x: each row's place on each line."""

    def project(batches):
        for batch in batches:
            if len(batch):
                data = np.stack(batch["v"].to_numpy())
                directions = np.random.default_rng(seed).standard_normal((data.shape[1], lines))
                yield batch.assign(x=list(data @ directions))

    return stored(vectors.mapInPandas(project, "id long, v array<double>, x array<double>")).select("id", "v", F.posexplode("x").alias("line", "x"))


def _along_lines(placed: DataFrame, lines: int, block_rows: int, k: int) -> DataFrame:
    """id, neighbour, distance: the ``k`` nearest of the rows that each row meets on each line."""
    cuts = 2 * int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / cuts for i in range(1, cuts)] or [0.5]
    borders = placed.groupBy("line").agg(F.percentile_approx("x", steps, 4 * cuts).alias("cuts")).collect()  # one row per line
    listed = {r["line"]: r["cuts"] for r in borders}
    known = F.array(*[F.array(*[F.lit(float(c)) for c in listed.get(i, [0.0])]) for i in range(lines)])
    cut = F.size(F.filter(F.get(known, F.col("line")), lambda c: c <= F.col("x")))
    placed = placed.withColumn("cut", cut)
    before = W.partitionBy("line").orderBy("cut").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("line", "cut").agg(F.count(F.lit(1)).alias("n")).select("line", "cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("line", "cut").orderBy("x", "id")) - 1
    ranked = placed.withColumn("place", inside).join(offsets, ["line", "cut"]).withColumn("place", F.col("place") + F.col("before"))
    block, at, half = F.floor(F.col("place") / block_rows), F.col("place") % block_rows, block_rows // 2
    ways = F.array_compact(
        F.array(
            F.struct(block.alias("block"), F.lit(True).alias("own")),
            F.when(at < half, F.struct((block - 1).alias("block"), F.lit(False).alias("own"))),
            F.when(at >= block_rows - half, F.struct((block + 1).alias("block"), F.lit(False).alias("own"))),
        )
    )
    sent = ranked.select("line", "id", "v", F.explode(ways).alias("to")).select("line", "to.block", "to.own", "id", "v")

    def match(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        ids, own, b = rows["id"].to_numpy(), rows["own"].to_numpy(), np.stack(rows["v"].to_numpy())
        mine, a = ids[own], b[own]
        if not len(mine):
            return pd.DataFrame({"id": [], "neighbour": [], "distance": []})
        found = [nearest(mine[low : low + TOGETHER], a[low : low + TOGETHER], ids, b, (b * b).sum(1), k) for low in range(0, len(mine), TOGETHER)]
        return pd.concat(found, ignore_index=True)

    return sent.groupBy("line", "block").applyInPandas(match, "id long, neighbour long, distance double")


def nearest(mine: np.ndarray, a: np.ndarray, ids: np.ndarray, b: np.ndarray, squares: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` nearest of rows ``b`` (named ``ids``, with their sums of squares) for each of rows ``a`` (named ``mine``)."""
    # The product gives the nearest up to rounding, their distances are then taken exactly.
    near = (-2 * a) @ b.T
    near += squares
    order = np.argsort(ids, kind="stable")
    own = order[np.searchsorted(ids, mine, sorter=order).clip(max=len(ids) - 1)]
    met = np.flatnonzero(ids[own] == mine)
    near[met, own[met]] = np.inf
    best = np.sort(smallest(near, min(k + 8, len(ids))), 1)
    square = ((b[best] - a[:, None, :]) ** 2).sum(2)
    square[ids[best] == mine[:, None]] = np.inf
    order = np.argsort(square, 1, kind="stable")[:, :k]
    neighbour, square = ids[np.take_along_axis(best, order, 1)], np.take_along_axis(square, order, 1)
    out = pd.DataFrame({"id": np.repeat(mine, order.shape[1]), "neighbour": neighbour.ravel(), "distance": np.sqrt(square.ravel())})
    return out[np.isfinite(out["distance"])]


def smallest(values: np.ndarray, few: int, width: int = 64) -> np.ndarray:
    """The places of the ``few`` smallest values of each row, in any order. Each is at most the ``few``-th smallest of the
    minima of ``size // width`` pieces, so only the values up to that bound are put in order."""
    n, size = values.shape
    if size < 4 * few * width:
        return np.argpartition(values, few - 1, axis=1)[:, :few]
    pieces = np.fmin.reduce(values[:, : size - size % width].reshape(n, width, -1), axis=1)
    bound = np.partition(pieces, few - 1, axis=1)[:, few - 1]
    if np.isnan(bound).any():
        return np.argpartition(values, few - 1, axis=1)[:, :few]
    row, place = np.nonzero(values <= bound[:, None])
    order = np.lexsort((values[row, place], row))
    first = np.searchsorted(row, np.arange(n))
    return place[order[first[:, None] + np.arange(few)]]


def smote(
    df: DataFrame,
    k: int = 5,
    key: str = "TransactionID",
    values: str = "values",
    label: str = "isFraud",
    seed: str = "42",
    block_rows: int = 2048,
) -> DataFrame:
    """The synthetic rows that bring the minority (label 1) to the size of the majority.

    Every minority row is the base of equally many synthetic rows, give or take one. Neighbour and
    position on the segment come from a hash, so the result does not depend on partitioning.
    """
    minority = df.filter(F.col(label) == 1).select(key, values)
    few, many = df.agg(F.count(F.when(F.col(label) == 1, 1)), F.count(F.when(F.col(label) == 0, 1))).first()
    missing = max(0, many - few)
    # Stored: it is the expensive part and is read more than once.
    near = stored(nearest_neighbours(minority, k, key, values, block_rows))
    size = near.groupBy(key).agg(F.count(F.lit(1)).alias("n_near"))
    copies = F.lit(missing // max(few, 1)) + (F.col("hash_rank") < missing % max(few, 1)).cast("int")
    based = hash_rank(minority, seed, key).withColumn("copies", copies.cast("int")).filter(F.col("copies") > 0)
    plans = based.join(size, key).select(
        key, values, "n_near", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    )
    name = F.concat_ws("-", F.col(key), F.col("copy"))
    plans = plans.withColumns(
        {
            "rank": (F.floor(hash_uniform(f"{seed}n", name) * F.col("n_near")) + 1).cast("int"),
            "part": hash_uniform(f"{seed}g", name),
        }
    )
    chosen = plans.join(near.select(key, "rank", "neighbour"), [key, "rank"])
    ends = minority.select(F.col(key).alias("neighbour"), F.col(values).alias("_end"))
    mixed = F.zip_with(values, "_end", lambda a, b: a + F.col("part") * (b - a))
    return chosen.join(ends, "neighbour").select(
        key, "copy", "neighbour", "part", mixed.alias(values), F.lit(1).alias(label)
    )
