"""Embedding whitening: leading components by spectrum slicing.

Spark sums: vectors become integers, their sums per dimension are exact, and centred products are added up to the
covariance. What reaches the driver is one matrix of the width of a vector, whatever the number of rows.

The matrix is then sliced. The number of negative pivots of an LDL' factorisation of V - s I is the number of
eigenvalues below s, so counts at bisected shifts isolate each leading eigenvalue in an interval of its own. Rayleigh
quotient iteration started there converges cubically; an iterate that leaves its interval is sent back and the interval
halved. At last counts on both sides of each value found certify its number. Eigenvalues that are equal within rounding can't be separated: their interval holds
several, and an orthonormal basis of all its directions is found together.

Defined cases: vectors that are null or hold null or non-finite entries take no part; shorter vectors are filled up with
zeros; entries whose integer would not fit a long are taken as plus or minus 2**61. Rows without a vec_id, and rows that repeat
one, count like any others. A deviation beyond a long is null. Components without variance above rounding have a null ``whitened`` and don't
count in ``identity_error``. Vectors narrower than the number of components have as many components as entries. An empty
table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import table

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
LARGEST = 1 << 61
#: Widest vectors whose covariance is gathered: 2048 * 2048 doubles are 32 MB.
MOST_DIMENSIONS = 2048
ROWS_AT_ONCE = 4096
EPS = np.finfo(float).eps
LOW = 31


def sound(vector: Column) -> Column:
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * c) + SHIFT of every entry, a row for each vector."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    full = np.zeros((len(lengths), width))
    full[np.arange(width)[None, :] < lengths[:, None]] = flat
    return np.clip(np.floor(SCALE * full), -float(LARGEST), float(LARGEST)).astype(np.int64) + SHIFT


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            yield part, part.column(column)


def exact_sums(rows: DataFrame, width: int) -> list[int]:
    """The sum of each dimension. Integers are added as a high and a low part, neither of which can overflow."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for _, vectors in slices(batches, 0):
            x = integers(vectors, width)
            high += (x >> LOW).sum(0)
            low += (x & ((1 << LOW) - 1)).sum(0)
            high += low >> LOW
            low &= (1 << LOW) - 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(high), pa.array(low)], ["dimension", "high", "low"])

    parts = rows.select("vector").mapInArrow(add, "dimension long, high long, low long")
    total = parts.groupBy("dimension").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low"))).collect()
    sums = [0] * width
    for row in total:
        sums[row["dimension"]] = (int(row["high"]) << LOW) + int(row["low"])
    return sums


def gram(rows: DataFrame, width: int, size: int, centred: callable) -> np.ndarray:
    """The sum of y y' over all rows, y = centred(integers of a row), ``size`` long."""
    upper = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for _, vectors in slices(batches, 0):
            y = centred(integers(vectors, width))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], ["cell", "value"])

    cells = rows.select("vector").mapInArrow(add, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros((size, size))
    out[upper[0][cells["cell"]], upper[1][cells["cell"]]] = cells["value"]
    return out + np.triu(out, 1).T


def negative_pivots(a: np.ndarray, shift: float) -> int:
    """The number of eigenvalues of ``a`` below ``shift``: negative pivots of P(a - shift I)P' = LDL', D with blocks of one
    and two rows, the larger of diagonal and off-diagonal entries first (Bunch and Parlett)."""
    m = a - shift * np.eye(len(a))
    tiny = EPS * EPS * max(1e-300, float(np.abs(a).max(initial=0)))
    count = 0
    while len(m):
        diagonal = np.abs(m.diagonal())
        p = int(diagonal.argmax())
        off = np.abs(m - np.diag(m.diagonal()))
        r, s = divmod(int(off.argmax()), len(m))
        if diagonal[p] >= 0.64 * off[r, s]:
            d = m[p, p]
            if abs(d) <= tiny:
                return count
            count += d < 0
            rest = np.delete(np.arange(len(m)), p)
            column = m[rest, p]
            m = m[np.ix_(rest, rest)] - np.outer(column, column / d)
        else:
            # A block whose off-diagonal entry is the larger one has one eigenvalue of either sign.
            count += 1
            rest = np.delete(np.arange(len(m)), [r, s])
            columns = m[np.ix_(rest, [r, s])]
            m = m[np.ix_(rest, rest)] - columns @ np.linalg.solve(m[np.ix_([r, s], [r, s])], columns.T)
    return count


@dataclass
class Interval:
    """(low, high) holds the eigenvalues numbered first to last, counted from 0 from the largest."""

    low: float
    high: float
    first: int
    last: int


def isolated(a: np.ndarray, wanted: int) -> list[Interval]:
    """Intervals with one eigenvalue each, or several that are equal within rounding, down to number ``wanted``."""
    d = len(a)
    reach = float(np.abs(a).sum(1).max())
    narrow = 8 * d * EPS * max(reach, 1e-300)
    above = lambda s: d - negative_pivots(a, s)
    low, high = float((a.diagonal() * 2 - np.abs(a).sum(1)).min()) - narrow, reach + narrow
    todo, done = [Interval(low, high, 0, d - 1)], []
    while todo:
        x = todo.pop()
        if x.first >= wanted:
            continue
        if x.first == x.last or x.high - x.low <= narrow:
            done.append(x)
            continue
        middle = (x.low + x.high) / 2
        n = min(max(above(middle), x.first), x.last + 1)
        if n > x.first:
            todo.append(Interval(middle, x.high, x.first, n - 1))
        if n <= x.last:
            todo.append(Interval(x.low, middle, n, x.last))
    return sorted(done, key=lambda x: x.first)


def rayleigh(a: np.ndarray, x: Interval, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors of an interval, by Rayleigh quotient iteration kept inside it and orthogonal to
    what is ``found``."""
    d, m = len(a), x.last - x.first + 1
    rng = np.random.default_rng(7 + x.first)
    scale = max(float(np.abs(a).sum(1).max()), 1e-300)
    low, high, rounding = x.low, x.high, 64 * d * EPS * scale
    shift, basis = (low + high) / 2, rng.standard_normal((d, m))
    for _ in range(100):
        basis -= found @ (found.T @ basis)
        basis = np.linalg.qr(basis)[0]
        small = basis.T @ a @ basis
        residual = np.abs(a @ basis - basis @ small).max()
        value = float(small.trace()) / m
        if x.low - rounding <= value <= x.high + rounding and residual <= 4 * EPS * scale * np.sqrt(d):
            break
        if low <= value <= high and residual <= (high - low):
            shift = value
        elif m == 1:
            middle = (low + high) / 2
            if d - negative_pivots(a, middle) > x.first:
                low = middle
            else:
                high = middle
            shift = (low + high) / 2
        basis = solved(a, shift, basis, scale)
    basis = np.linalg.qr(basis - found @ (found.T @ basis))[0]
    return np.diag(basis.T @ a @ basis).copy(), basis


def solved(a: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    """(a - shift I)^-1 right. A shift that is an eigenvalue is moved by a rounding."""
    for moved in (0.0, EPS * scale, 4 * EPS * scale, 64 * EPS * scale):
        try:
            out = np.linalg.solve(a - (shift + moved) * np.eye(len(a)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(out).all() and np.abs(out).max() > 0:
            return out / np.abs(out).max(0)
    return right


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    d = len(a)
    values, vectors = np.zeros(0), np.zeros((d, 0))
    intervals = isolated(a, k)
    for x in intervals:
        some, basis = rayleigh(a, x, vectors)
        values, vectors = np.concatenate((values, some)), np.concatenate((vectors, basis), 1)
    certify(a, values, intervals)
    order = np.argsort(-values, kind="stable")[:k]
    vectors = vectors[:, order]
    strongest = np.abs(vectors).argmax(0)
    return values[order], vectors * np.where(vectors[strongest, np.arange(vectors.shape[1])] < 0, -1, 1)


def certify(a: np.ndarray, values: np.ndarray, intervals: list[Interval]) -> None:
    """Counts on both sides of every interval's values show that they have the numbers that they were given."""
    margin = 64 * len(a) * EPS * max(float(np.abs(a).sum(1).max(initial=0)), 1e-300)
    for x in intervals:
        own = values[x.first : x.last + 1]
        above, below = (len(a) - negative_pivots(a, s) for s in (own.max() + margin, own.min() - margin))
        if above > x.first or below < x.last + 1:
            raise ArithmeticError(f"eigenvalues {x.first} to {x.last} are not where they were found")


@dataclass
class Whitening:
    """What a fit learns: counts and sums of the vectors, eigenvalues, unit eigenvectors, trace, and the check."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n. The whole part of the mean is taken off as an integer, so nothing cancels."""
        whole = [s // self.n for s in self.sums]
        part = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])
        return (x - np.array(whole, np.int64)).astype(np.float64) - part

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values, a column for each component; NaN where a component has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.alive, self.centred(x) @ self.vectors / np.sqrt(self.values), np.nan)

    @property
    def alive(self) -> np.ndarray:
        return self.values > 64 * EPS * len(self.sums) * max(float(self.values.max(initial=0)), 0)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n * x - sums) ** 2 of each row, exact; None where it is beyond a long."""
        whole = [s // self.n for s in self.sums]
        most = float(np.abs((x - np.array(whole, np.int64)).astype(np.float64)).max(initial=0)) + 1
        if self.n * self.n * most * most * max(1, x.shape[1]) < 2.0**62:
            rest = np.array([s - w * self.n for s, w in zip(self.sums, whole, strict=True)], np.int64)
            far = (x - np.array(whole, np.int64)) * self.n - rest
            return (far * far).sum(1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist())
        return [e if e < 1 << 63 else None for e in exact]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learned from all sound vectors of rows (vector); None if there are none."""
    n, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n or not width:
        return None
    if width > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {width} entries; a covariance is gathered up to {MOST_DIMENSIONS}")
    learned = Whitening(n, exact_sums(rows, width), np.zeros(0), np.zeros((width, 0)), 0.0)
    covariance = gram(rows, width, width, learned.centred) / n
    learned.trace = float(covariance.trace())
    learned.values, learned.vectors = leading(covariance, min(components, width))
    size = len(learned.values)
    # The last column is 1, so that the sums needed to centre the whitened values come with their products.
    with_one = lambda x: np.column_stack((np.nan_to_num(learned.project(x)), np.ones(len(x))))
    products = gram(rows, width, size + 1, with_one) / n
    mean = products[:size, size]
    off = products[:size, :size] - np.outer(mean, mean) - np.diag(learned.alive.astype(float))
    learned.identity_error = float(np.abs(off).max())
    return learned


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """OUT, a row for each sound row of vectors (vec_id, vector) and component."""
    rows = vectors.select(F.col("vec_id").cast("long"), "vector").where(sound(F.col("vector")))
    learned = fit(rows.select("vector"), components)
    if learned is None:
        return vectors.sparkSession.createDataFrame([], OUT)
    width, k = len(learned.sums), len(learned.values)
    explained = learned.values / learned.trace if learned.trace > 0 else np.zeros(k)
    names = [c.split()[0] for c in OUT.split(", ")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, column in slices(batches, 1):
            x, rows = integers(column, width), part.num_rows
            ids = part.column(0).take(pa.array(np.repeat(np.arange(rows), k)))
            deviation = pa.array(learned.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
            values = pa.array(learned.project(x).ravel(), pa.float64(), from_pandas=True)
            fixed = [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, learned.n))]
            last = [pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, learned.identity_error))]
            yield pa.RecordBatch.from_arrays([ids, *fixed, deviation, values, *last], names)

    return rows.mapInArrow(apply, OUT)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened leading components of all embeddings."""
    return whitened(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector")))
