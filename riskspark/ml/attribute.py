"""Exact path-dependent tree contributions (Lundberg et al. 2018) for a boosted-tree model.

Spark partitions and scans the rows; inside a task one Arrow batch is scored against the node table,
whose size is fixed by the number and depth of the trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    """One leaf: its value and, per distinct feature on the way, the interval (low, high] that leads
    to it and the share of training rows that take that way."""

    value: float
    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    share: tuple[float, ...]


def read_leaves(spark: SparkSession, model_path: str, weights: Sequence[float]) -> list[Leaf]:
    """Leaves of a saved model. At most 2**(depth+1) nodes per tree reach the driver."""
    nodes = spark.read.parquet(f"{model_path}/data").select("treeID", "nodeData.*")
    rows = nodes.select(
        "treeID",
        "id",
        "prediction",
        F.get("impurityStats", F.lit(0)).alias("cover"),
        "leftChild",
        "rightChild",
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).collect()
    trees: dict[int, dict] = {}
    for r in rows:
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    leaves: list[Leaf] = []
    for tree_id, tree in sorted(trees.items()):
        _walk(tree, tree[0], weights[tree_id], {}, leaves)
    return leaves


def _walk(tree: dict, node, weight: float, path: dict, leaves: list[Leaf]) -> None:
    if node["leftChild"] < 0:
        names = tuple(path)
        low, high, share = (tuple(path[f][i] for f in names) for i in range(3))
        leaves.append(Leaf(node["prediction"] * weight, names, low, high, share))
        return
    for side, child_id in (("left", node["leftChild"]), ("right", node["rightChild"])):
        child = tree[child_id]
        low, high, share = path.get(node["feature"], (-math.inf, math.inf, 1.0))
        if side == "left":
            high = min(high, node["threshold"])
        else:
            low = max(low, node["threshold"])
        part = child["cover"] / node["cover"] if node["cover"] else 0.0
        _walk(tree, child, weight, path | {node["feature"]: (low, high, share * part)}, leaves)


def expected_margin(leaves: Sequence[Leaf]) -> float:
    return float(sum(leaf.value * math.prod(leaf.share) for leaf in leaves))


def _shares(share: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Shapley values of reaching leaves: leaves by rows by features, from leaves by features ``share``
    and rows by features ``follows``."""
    (leaves, m), rows = share.shape, len(follows)
    order = np.array([math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)])
    out = np.empty((leaves, rows, m))
    for i in range(m):
        # Coefficient s sums, over subsets of s other features, the weight of reaching the leaf.
        poly = np.zeros((leaves, rows, m))
        poly[..., 0] = 1.0
        for j in range(m):
            if j != i:
                grown = poly * share[:, j, None, None]
                grown[..., 1:] += poly[..., :-1] * follows[:, j, None]
                poly = grown
        out[..., i] = (poly @ order) * (follows[:, i] - share[:, i, None])
    return out


def pattern_tables(leaves: Sequence[Leaf]) -> list[np.ndarray]:
    """Per leaf the contribution of each of its m features for each of the 2**m patterns of conditions that
    hold, features by patterns. A row's contributions depend on nothing else. For 500 trees of depth 6 the
    tables take about 100 MB in a task."""
    tables: list[np.ndarray] = [np.zeros((0, 1))] * len(leaves)
    by_size: dict[int, list[int]] = {}
    for at, leaf in enumerate(leaves):
        by_size.setdefault(len(leaf.features), []).append(at)
    for m, places in by_size.items():
        patterns = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1
        step = max(1, (1 << 16) // max(1, m << m))
        for low in range(0, len(places) if m else 0, step):
            part = places[low : low + step]
            found = _shares(np.array([leaves[k].share for k in part]), patterns.astype(float))
            for k, values in zip(part, found):
                tables[k] = np.ascontiguousarray(values.T) * leaves[k].value
    return tables


#: Conditions of a group of leaves at most: a table has two to that power columns.
GROUP_BITS = 8


@dataclass(frozen=True)
class Group:
    """Neighbouring leaves of a tree that share conditions: the places of these among a model's thresholds, the features
    on the way to any of the leaves, and what the leaves together add to each feature (rows) for every pattern of conditions."""

    bits: tuple[int, ...]
    features: tuple[int, ...]
    table: np.ndarray


def grouped(leaves: Sequence[Leaf], tables: Sequence[np.ndarray] | None = None) -> tuple[list[tuple[int, float]], list[Group]]:
    """The distinct thresholds of a model, (feature, value up to which a condition holds), and its leaves in groups.

    Leaves come in the order of the walk, so neighbours have all but their last splits in common, and a group's table stands
    for several leaves at one look-up."""
    tables = pattern_tables(leaves) if tables is None else tables
    places: dict[tuple[int, float], int] = {}
    groups: list[Group] = []

    def close(members: list[int], bits: dict[tuple[int, float], int]) -> None:
        features = sorted({f for k in members for f in leaves[k].features})
        table = np.zeros((len(features), 1 << len(bits)))
        patterns = np.arange(1 << len(bits))
        for k in members:
            leaf, own = leaves[k], np.zeros(len(patterns), np.intp)
            for i, (f, low, high) in enumerate(zip(leaf.features, leaf.low, leaf.high)):
                holds = np.ones(len(patterns), np.intp)
                if high < math.inf:
                    holds &= patterns >> bits[f, high]
                if low > -math.inf:
                    holds &= ~(patterns >> bits[f, low])
                own |= (holds & 1) << i
            table[[features.index(f) for f in leaf.features]] += tables[k][:, own]
        groups.append(Group(tuple(places.setdefault(c, len(places)) for c in bits), tuple(features), table))

    members: list[int] = []
    bits: dict[tuple[int, float], int] = {}
    for k, leaf in enumerate(leaves):
        mine = [(f, t) for f, low, high in zip(leaf.features, leaf.low, leaf.high) for t in (low, high) if math.isfinite(t)]
        if not mine:
            continue
        if members and len(bits.keys() | set(mine)) > GROUP_BITS:
            close(members, bits)
            members, bits = [], {}
        members.append(k)
        for c in mine:
            bits.setdefault(c, len(bits))
    if members:
        close(members, bits)
    return list(places), groups


def batch_contributions(
    x: np.ndarray, leaves: Sequence[Leaf], known: tuple[list[tuple[int, float]], list[Group]] | None = None, rows: int = 4096
) -> np.ndarray:
    """Shapley values of the margin for a batch: rows by features. Rows are taken in blocks that fit a cache; in a block
    each threshold is compared once, however many leaves of however many trees have it. A missing value takes the right
    branch, as in the model."""
    thresholds, groups = grouped(leaves) if known is None else known
    out = np.zeros(x.shape)
    for start in range(0, len(x), rows):
        columns = np.ascontiguousarray(x[start : start + rows].T)
        phi = np.zeros(columns.shape)
        below = np.empty((len(thresholds), columns.shape[1]), np.uint8)
        for row, (f, t) in zip(below, thresholds):
            np.less_equal(columns[f], t, out=row.view(bool))
        pattern, bits, bit, part = (np.empty(columns.shape[1], t) for t in (np.intp, np.uint8, np.uint8, np.float64))
        for group in groups:
            # Bits are put together in bytes, eight conditions at a time; a leaf with more than that is a group of its own.
            for low in range(0, len(group.bits), 8):
                bits[:] = below[group.bits[low]]
                for i, place in enumerate(group.bits[low + 1 : low + 8], 1):
                    np.left_shift(below[place], i, out=bit)
                    bits |= bit
                if low:
                    pattern |= bits.astype(np.intp) << low
                else:
                    pattern[:] = bits
            for f, values in zip(group.features, group.table):
                values.take(pattern, mode="clip", out=part)
                phi[f] += part
        out[start : start + rows] = phi.T
    return out


def tree_contributions(
    df: DataFrame, model: GBTClassificationModel, model_path: str, columns: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """``keep`` columns, one contribution column ``phi_<feature>`` per feature, ``expected_value`` and
    ``sum_shap``. They add up to the model margin; the probability is 1 / (1 + exp(-2 * margin))."""
    leaves = read_leaves(df.sparkSession, model_path, list(model.treeWeights))
    shared = df.sparkSession.sparkContext.broadcast(leaves)
    base = expected_margin(leaves)
    names = [f"phi_{c}" for c in columns]
    kept = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns if c not in keep])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = grouped(shared.value)
        for batch in batches:
            phi = batch_contributions(batch[list(columns)].to_numpy(dtype=float), shared.value, known)
            part = pd.DataFrame(phi, columns=names, index=batch.index)
            part["sum_shap"] = phi.sum(axis=1)
            part["expected_value"] = base
            yield pd.concat([batch[list(keep)], part], axis=1)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name in keep]
    fields += [f"`{n}` double" for n in [*names, "sum_shap", "expected_value"]]
    return kept.mapInPandas(run, ", ".join(fields))
