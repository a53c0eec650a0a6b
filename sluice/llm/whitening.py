"""Embedding whitening by FEAST contour integration.

Vectors are put on an integer grid, so counts, sums and second moments are
exact whatever the order of tasks.  Each task centres its rows at the rounded
mean before it multiplies; what rounding leaves is corrected exactly from the
sums, which gives the covariance as if centred at the true mean.

The covariance matrix (dimensions squared, whatever the number of rows) is
brought to tridiagonal form, whose Sturm sequences tell how many eigenvalues
lie below a shift: Sylvester's inertia.  These counts cut the spectrum into
intervals of few eigenvalues, at places where none is near.  Each interval is
one Spark task: a circle is laid around it, and a Gauss-Legendre quadrature of
solves with the complex shifted covariance projects a random block onto the
eigenvectors inside; Rayleigh-Ritz extracts them, and the step is repeated until
residuals vanish.  An interval whose pairs don't number its inertia count is
solved again with a larger block, and fails rather than missing one.

Vectors that are null, empty, or hold null or non-finite entries, or entries of
2 ** 31 / 64 and more (no longer a grid of exact sums) are dropped, and so are
those whose length isn't the most frequent one (of two, the greater).
Components without variance can't be whitened and are left out.  Repeated rows
count as often as they come; an empty table, or one whose vectors are all
alike, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import ship, stored

#: Grid: x = floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Eigenvalues in an interval, at most, unless they lie too close to be told apart.
INTERVAL = 12
#: Nodes of the quadrature on the half circle.
NODES = 12
_EPS = float(np.finfo(float).eps)


@dataclass
class Fit:
    """Number of vectors, sums per dimension, covariance, and the components: eigenvalues falling, vectors in rows."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector can be fitted, with ``vector`` as an array of doubles."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda c: F.coalesce(F.abs(c) < (1 << 31) / SCALE, F.lit(False)))
    kept = rows.withColumn(vector, v).where(F.col(vector).isNotNull() & (F.size(vector) > 0) & fine)
    size = F.size(vector)
    longest = kept.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return kept.where(size == (longest["d"] if longest else 0))


def grid(batch: pa.RecordBatch, at: int) -> np.ndarray:
    """The x-vectors of a batch, one in each row."""
    lists = batch.column(at)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(len(lists), -1) + OFFSET if len(lists) else np.zeros((0, 0), np.int64)


def _products(y: np.ndarray) -> np.ndarray:
    """y.T @ y, exact: as floats while all sums stay whole numbers of a double, else with Python's integers."""
    if len(y) * int(np.abs(y).max(initial=0)) ** 2 < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = y.astype(object)
    return o.T @ o


def _summed(rows: DataFrame, vector: str, sums: Callable[[np.ndarray], dict[tuple[int, int], int]]) -> dict[tuple[int, int], int]:
    """Exact totals over all tasks of what ``sums`` finds in the x-vectors of a batch, by key (i, j)."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            if batch.num_rows:
                for key, value in sums(grid(batch, 0)).items():
                    total[key] = total.get(key, 0) + value
        if total:
            i, j = zip(*total, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in total.values()], pa.string())], names=["i", "j", "v"])

    parts = rows.select(vector).mapInArrow(run, "i int, j int, v string")
    whole = parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    return {(r["i"], r["j"]): int(r["v"]) for r in whole.collect()}


def moments(rows: DataFrame, vector: str = "embedding") -> tuple[int, list[int], np.ndarray]:
    """Number, sums per dimension and covariance (divisor n, correctly rounded) of the x-vectors of usable rows."""

    def totals(x: np.ndarray) -> dict[tuple[int, int], int]:
        return {(-1, -1): len(x)} | {(j, -1): int(v) for j, v in enumerate(x.sum(0))}

    first = _summed(rows, vector, totals)
    n = first.pop((-1, -1), 0)
    if not n:
        return 0, [], np.zeros((0, 0))
    sums = [first[j, -1] for j in range(len(first))]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums])  # the mean, rounded

    def products(x: np.ndarray) -> dict[tuple[int, int], int]:
        found = _products(x - centre)
        return {(i, j): int(found[i, j]) for i in range(len(found)) for j in range(i, len(found))}

    second = _summed(rows, vector, products)
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    covariance = np.zeros((len(sums), len(sums)))
    for (i, j), v in second.items():
        covariance[i, j] = covariance[j, i] = float(Fraction(n * v - rest[i] * rest[j], n * n))
    return n, sums, covariance


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to the symmetric ``a``, by Householder reflections."""
    a = a.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k]
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        v = x.copy()
        v[0] += norm if v[0] >= 0 else -norm
        v /= np.linalg.norm(v)
        below = a[k + 1 :, k + 1 :]
        p = below @ v
        w = p - (v @ p) * v
        below -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = -norm if x[0] >= 0 else norm
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia(form: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each shift: negative pivots of the shifted tridiagonal form."""
    diagonal, off = form
    tiny = _EPS * max(float(np.abs(diagonal).max(initial=0)), float(np.abs(off).max(initial=0)), 1e-300)
    pivot = np.ones_like(shifts)
    count = np.zeros(len(shifts), np.int64)
    for k, d in enumerate(diagonal):
        pivot = d - shifts - (off[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def intervals(form: tuple[np.ndarray, np.ndarray], low: float, high: float, most: int = INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, count) of intervals that together hold all eigenvalues between ``low`` and ``high``, from the highest down."""
    below_low, below_high = inertia(form, np.array([low, high]))
    open_, done = [(low, high, int(below_low), int(below_high))], []
    while open_:
        a, b, na, nb = open_.pop()
        if nb - na <= most or b - a <= 64 * _EPS * max(abs(high), abs(low)):
            if nb > na:
                done.append((a, b, nb - na))
            continue
        # cut in the widest stretch without eigenvalues that the probes show, rather than beside one
        probes = np.linspace(a, b, 34)[1:-1]
        counts = inertia(form, probes)
        runs = np.split(np.arange(len(probes)), np.flatnonzero(np.diff(counts)) + 1)
        splitting = [r for r in runs if na < counts[r[0]] < nb]
        if splitting:
            run = max(splitting, key=len)
            cut, at = float((probes[run[0]] + probes[run[-1]]) / 2), int(counts[run[0]])
            open_ += [(a, cut, na, at), (cut, b, at, nb)]
            continue
        # all lie between two probes
        k = int(np.searchsorted(counts, nb))
        points = np.concatenate([[a], probes, [b]])
        open_.append((float(points[k]), float(points[k + 1]), na, nb))
    return sorted(done, reverse=True)


def feast(matrix: np.ndarray, low: float, high: float, count: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs of the symmetric ``matrix`` between ``low`` and ``high``: values, and vectors in columns."""
    d, norm = len(matrix), float(np.abs(matrix).sum(1).max())
    points, weights = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(1j * np.pi / 2 * (1 - points))
    middle, radius = (low + high) / 2, max((high - low) / 2, 4 * _EPS * norm)
    shifted = [(w, radius * t, (middle + radius * t) * np.eye(d) - matrix) for w, t in zip(weights, turn, strict=True)]
    for attempt in range(4):
        width = min(d, (2 << attempt) * count + 8)
        basis = np.linalg.qr(np.random.default_rng(attempt).standard_normal((d, width)))[0]
        for _ in range(30):
            projected = sum(w / 2 * np.real(t * np.linalg.solve(a, basis.astype(complex))) for w, t, a in shifted)
            basis = np.linalg.qr(projected)[0]
            values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
            basis = basis @ turned
            chosen = (values >= low) & (values < high)
            residual = np.linalg.norm(matrix @ basis[:, chosen] - basis[:, chosen] * values[chosen], axis=0)
            if chosen.sum() == count and residual.max(initial=0) <= 8 * _EPS * norm * np.sqrt(d):
                return values[chosen], basis[:, chosen]
    raise ArithmeticError(f"{int(chosen.sum())} eigenpairs found between {low} and {high}, inertia says {count}")


def components(spark, covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` highest eigenvalues above rounding, falling, and their unit eigenvectors in rows; one Spark task an interval."""
    d = len(covariance)
    bound = float(np.abs(covariance).sum(1).max(initial=0))
    if not bound:
        return np.zeros(0), np.zeros((0, d))
    form = tridiagonal(covariance)
    found = intervals(form, 8 * d * _EPS * bound, bound * (1 + 1e-9))
    wanted, held = [], 0
    for interval in found:
        if held < most:
            wanted.append(interval)
            held += interval[2]
    if not wanted:
        return np.zeros(0), np.zeros((0, d))
    ship(spark)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                values, vectors = feast(covariance, r["low"], r["high"], r["count"])
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], names=["value", "vector"])

    tasks = spark.createDataFrame([(*w, i) for i, w in enumerate(wanted)], "low double, high double, count int, i int")
    pairs = tasks.repartition(len(wanted), "i").mapInArrow(solve, "value double, vector array<double>").collect()
    if len(pairs) != held:
        raise ArithmeticError(f"{len(pairs)} eigenpairs found, inertia says {held}")
    # intervals are solved apart: a last Rayleigh-Ritz makes neighbours orthogonal to full precision
    basis = np.linalg.qr(np.array([p["vector"] for p in pairs]).T)[0]
    values, turned = np.linalg.eigh(basis.T @ covariance @ basis)
    order = np.argsort(-values)[:most]
    vectors = (basis @ turned).T[order]
    signs = np.sign(vectors[np.arange(len(order)), np.abs(vectors).argmax(1)])
    return values[order], vectors * signs[:, None]


def fit(rows: DataFrame, vector: str = "embedding", most: int = 32) -> Fit:
    """Fit on all of ``rows``, which are usable ones; up to ``most`` components."""
    n, sums, covariance = moments(rows, vector)
    values, vectors = components(rows.sparkSession, covariance, most)
    return Fit(n, sums, covariance, values, vectors)


def _whitener(model: Fit) -> Callable[[np.ndarray], np.ndarray]:
    """x-vectors to whitened ones: the mean's whole part is taken off in integers, the rest in doubles."""
    whole = np.array([s // model.n for s in model.sums])
    rest = np.array([s % model.n / model.n for s in model.sums])
    turn = (model.vectors / np.sqrt(model.values)[:, None]).T
    return lambda x: ((x - whole) - rest) @ turn


def whitened(rows: DataFrame, key: str, model: Fit, vector: str = "embedding") -> DataFrame:
    """Per row: ``key``, whitened (array of one double a component), deviation (sum over dimensions of (n x - sum) squared; null beyond a long)."""
    ship(rows.sparkSession)
    whiten, sums, n = _whitener(model), np.array(model.sums, np.int64), model.n

    def deviations(x: np.ndarray) -> list[int | None]:
        z = x * n - sums
        if x.shape[1] * int(np.abs(z).max(initial=0)) ** 2 < 1 << 63:
            return (z * z).sum(1).tolist()
        exact = [sum(v * v for v in row) for row in (x.astype(object) * n - sums.astype(object)).tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = grid(batch, 1)
                made = whiten(x)
                offsets = pa.array(np.arange(len(made) + 1, dtype=np.int32) * made.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(made.ravel())), pa.array(deviations(x), pa.int64())], names=[key, "whitened", "deviation"])

    kind = dict(rows.dtypes)[key]
    return rows.select(key, vector).mapInArrow(run, f"`{key}` {kind}, whitened array<double>, deviation bigint")


def identity_error(made: DataFrame) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity, over all rows of ``made``."""
    ship(made.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                w = np.hstack([np.ones((len(w), 1)), w])
                total = w.T @ w if total is None else total + w.T @ w
        if total is not None:
            i, j = np.indices(total.shape, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    whole = made.select("whitened").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    size = max((r["i"] for r in whole), default=-1) + 1
    if size < 2:
        return 0.0
    m = np.zeros((size, size))
    for r in whole:
        m[r["i"], r["j"]] = r["v"]
    n, mean = m[0, 0], m[0, 1:] / m[0, 0]
    return float(np.abs(m[1:, 1:] / n - np.outer(mean, mean) - np.eye(size - 1)).max())


def whiten(rows: DataFrame, key: str, vector: str = "embedding", most: int = 32) -> DataFrame:
    """Per usable row and component: ``key``, component (from 1), n, deviation, whitened, explained, identity_error."""
    fitted = stored(usable(rows, vector).select(key, vector), "whitening")
    model = fit(fitted, vector, most)
    kind = dict(rows.dtypes)[key]
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    made = stored(whitened(fitted, key, model, vector), "whitened")
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.values))
    each: Column = F.posexplode("whitened").alias("place", "w")
    return made.select(key, "deviation", each).select(
        key, (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", F.col("w").alias("whitened"),
        F.get(explained, F.col("place")).alias("explained"), F.lit(identity_error(made)).alias("identity_error"))
