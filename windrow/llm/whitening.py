"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Vectors are taken as integers, ``x = floor(SCALE * c) + SHIFT``, so that count, sums and scatter
are exact whatever the order in which Spark adds them up: the same rows give the same fit on any
cluster. The scatter is of the vectors less the whole part of their mean; what is left of the mean,
below one, comes off exactly in integers as well. Its size depends on the length of the vectors
only, never on their number, and it alone goes to the driver.

There, a Cholesky factorisation with pivots finds the rank and a triangular factor of the
covariance. Jacobi rotations of pairs of the factor's columns make these orthogonal, without the
product being formed again: the squared norms of the columns are then the eigenvalues, and the
columns divided by their norms the components.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import finite_rows, map_arrow, sliced

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LARGEST = 2.0 ** 61          # entries whose integers are beyond it count as not finite
LIMB = 16                    # bits of the pieces in which large integers are multiplied
SWEEPS = 60


def _integers(values: np.ndarray) -> np.ndarray:
    return np.floor(values * SCALE).astype(np.int64) + SHIFT


def _vectors(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows to use, and their integers."""
    at, values = finite_rows(column, length, LARGEST / SCALE)
    return at, _integers(values)


def _task_totals(vectors: DataFrame, schema: str, add, result) -> DataFrame:
    """One record batch per task, made by ``result`` of what ``add`` has put into a dict."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in sliced(batches):
            add(held, batch.column(0))
        if held:
            yield result(held)
    return vectors.mapInArrow(run, schema)


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of usable vectors of the commonest length, and their exact sum in each dimension."""
    def add(held, column):
        for length in set(column.value_lengths().drop_null().to_pylist()) - {0}:
            at, x = _vectors(column, length)
            if len(at):
                n, high, low = held.get(length, (0, 0, 0))
                held[length] = (n + len(at), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0))

    def result(held):
        return pa.RecordBatch.from_pydict({
            "length": [d for d in held for _ in range(d)],
            "dim": [i for d in held for i in range(d)],
            "n": [n for d, (n, _, _) in held.items() for _ in range(d)],
            "high": np.concatenate([h for _, h, _ in held.values()]),
            "low": np.concatenate([low for _, _, low in held.values()])},
            pa.schema([("length", pa.int32()), ("dim", pa.int32()), ("n", pa.int64()),
                       ("high", pa.int64()), ("low", pa.int64())]))
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    totals = _task_totals(vectors, "length int, dim int, n bigint, high bigint, low bigint", add,
                          result).groupBy("length", "dim").agg(F.sum("n").alias("n"), *exact)
    length = totals.filter("dim = 0").orderBy(F.desc("n"), F.desc("length")).select("length").first()
    if length is None:
        return 0, []
    rows = totals.filter(F.col("length") == length[0]).orderBy("dim").collect()
    return rows[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _scatter(vectors: DataFrame, whole: np.ndarray) -> dict[tuple[int, int], int]:
    """Exact sums of products of the vectors less ``whole``, for each two dimensions."""
    d = len(whole)
    upper = np.triu_indices(d)

    def add(held, column):
        y = _vectors(column, d)[1] - whole
        if not len(y):
            return
        limbs, rest = [], y
        while np.abs(rest).max() >= 1 << LIMB:
            limbs.append(rest & ((1 << LIMB) - 1))
            rest = rest >> LIMB
        limbs = [limb.astype(np.float64) for limb in (*limbs, rest)]
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):   # products below 2**33, sums of a slice below 2**53
                part = (a.T @ b)[upper].astype(np.int64)
                held[LIMB * (i + j)] = held.get(LIMB * (i + j), 0) + part

    def result(held):
        n = len(upper[0])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.tile(upper[0], len(held)), pa.int32()),
             pa.array(np.tile(upper[1], len(held)), pa.int32()),
             pa.array(np.repeat(list(held), n), pa.int32()),
             pa.array(np.concatenate(list(held.values())), pa.int64())],
            ["i", "j", "shift", "total"])
    rows = _task_totals(vectors, "i int, j int, shift int, total bigint", add, result).groupBy(
        "i", "j", "shift").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found: dict[tuple[int, int], int] = {}
    for i, j, shift, total in rows.collect():
        found[i, j] = found.get((i, j), 0) + (int(total) << shift)
    return found


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower trapezoidal factor of as many columns as the rank, and the order of its rows.

    Every step takes the largest diagonal entry left; where that is no more than rounding, the
    rank is reached.
    """
    d = len(a)
    order, rest = np.arange(d), a.diagonal().copy()
    factor = np.zeros((d, d))
    least = d * np.finfo(float).eps * rest.max(initial=0.0)
    for k in range(d):
        top = k + int(rest[k:].argmax())
        if rest[top] <= least:
            return factor[:, :k], order
        for held in (order, rest, factor):
            held[[k, top]] = held[[top, k]]
        factor[k, k] = np.sqrt(rest[k])
        below = a[order[k + 1:], order[k]] - factor[k + 1:, :k] @ factor[k, :k]
        factor[k + 1:, k] = below / factor[k, k]
        rest[k + 1:] -= factor[k + 1:, k] ** 2
    return factor, order


def _meetings(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs in which each two of ``n`` meet once."""
    seats = list(range(n)) + [-1] * (n % 2)
    half = len(seats) // 2
    for _ in range(len(seats) - 1):
        pairs = [(p, q) for p, q in zip(seats[:half], seats[:half - 1:-1]) if min(p, q) >= 0]
        yield np.array([min(x) for x in pairs], int), np.array([max(x) for x in pairs], int)
        seats[1:] = [seats[-1], *seats[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``factor @ factor.T``, falling, and their unit eigenvectors as columns."""
    columns = factor.copy()
    enough = len(columns) * np.finfo(float).eps
    for _ in range(SWEEPS):
        widest = 0.0
        for p, q in _meetings(columns.shape[1]):
            x, y = columns[:, p], columns[:, q]
            a, b, c = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(c) / np.sqrt(a * b)
            widest = max(widest, off.max(initial=0.0))
            turn = np.flatnonzero(off > enough)
            if len(turn):
                slope = (b[turn] - a[turn]) / (2 * c[turn])
                tangent = np.where(slope < 0, -1.0, 1.0) / (np.abs(slope) + np.hypot(1, slope))
                cosine = 1 / np.hypot(1, tangent)
                sine = cosine * tangent
                x, y = x[:, turn], y[:, turn]
                columns[:, p[turn]] = cosine * x - sine * y
                columns[:, q[turn]] = sine * x + cosine * y
        if widest <= enough:
            break
    values = (columns * columns).sum(0)
    falling = np.argsort(-values, kind="stable")
    return values[falling], columns[:, falling] / np.sqrt(values[falling])


@dataclass(frozen=True)
class Whitening:
    """A fit: count, exact sums, eigenvalues of the covariance, components, and its trace."""
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the mean is above its whole part."""
        return [s % self.n for s in self.sums]

    def whitened(self, y: np.ndarray) -> np.ndarray:
        """Projections of vectors less the whole part of the mean, each over its deviation."""
        centred = y - np.array([r / self.n for r in self.rest])
        return centred @ self.components / np.sqrt(self.values)

    def deviation(self, y: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - sum) ** 2; null beyond 64 bits."""
        n, rest = self.n, self.rest
        if len(y) and int(np.abs(y).max()) ** 2 * y.shape[1] < 1 << 62 and (
                int(np.abs(y).max()) * n * y.shape[1] < 1 << 62):
            squares, cross = (y * y).sum(1).tolist(), (y @ np.array(rest, np.int64)).tolist()
        else:
            wide = y.astype(object)
            squares, cross = (wide * wide).sum(1).tolist(), (wide @ np.array(rest, object)).tolist()
        fixed = sum(r * r for r in rest)
        exact = [n * n * s - 2 * n * c + fixed for s, c in zip(squares, cross)]
        return [v if v < 1 << 63 else None for v in exact]


def fit(vectors: DataFrame, vector_col: str = "embedding", most: int = COMPONENTS
        ) -> Whitening | None:
    """Fit on all usable vectors of the commonest length; None where there is none.

    Null vectors, empty ones, and those with a null, non-finite or absurdly large entry (beyond
    ``LARGEST / SCALE``) are left out, and so are vectors of another length than the commonest (of
    equally common ones the longest). There are as many components as the rank allows, up to
    ``most``; none where all vectors are equal.
    """
    read = vectors.select(F.col(vector_col).cast("array<double>").alias("v"))
    n, sums = _sums(read)
    if not n:
        return None
    exact = _scatter(read, np.array([s // n for s in sums], np.int64))
    d, rest = len(sums), [s % n for s in sums]
    covariance = np.zeros((d, d))
    for (i, j), total in exact.items():
        covariance[i, j] = covariance[j, i] = (n * total - rest[i] * rest[j]) / (n * n)
    factor, order = pivoted_cholesky(covariance)
    values, turned = one_sided_jacobi(factor)
    components = np.zeros_like(turned)
    components[order] = turned
    components, values = components[:, :most], values[:most]
    largest = np.abs(components).argmax(0)
    components = components * np.sign(components[largest, np.arange(len(values))])
    return Whitening(n, sums, values, components, float(np.trace(covariance)))


def identity_error(vectors: DataFrame, made: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened vectors less the identity."""
    d, k, whole = len(made.sums), len(made.values), made.whole
    if not k:
        return 0.0

    def add(held, column):
        w = made.whitened(_vectors(column, d)[1] - whole)
        if len(w):
            held["sum"] = held.get("sum", 0) + w.sum(0)
            held["products"] = held.get("products", 0) + w.T @ w

    def result(held):
        rows = np.repeat(np.arange(k + 1), k)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), pa.array(np.tile(np.arange(k), k + 1), pa.int32()),
             pa.array(np.concatenate([held["products"].ravel(), held["sum"]]))], ["i", "j", "total"])
    read = vectors.select(F.col(vector_col).cast("array<double>").alias("v"))
    totals = np.zeros((k + 1, k))
    for i, j, total in _task_totals(read, "i int, j int, total double", add, result).groupBy(
            "i", "j").agg(F.sum("total")).collect():
        totals[i, j] = total / made.n
    covariance = totals[:k] - np.outer(totals[k], totals[k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           most: int = COMPONENTS) -> DataFrame:
    """Per used vector and component: id, component, n, deviation, whitened, explained, identity_error.

    What is used and how many components there are says :func:`fit`; other rows give nothing, and
    an empty table or one without any spread an empty one. Repeated rows and null ids are rows like
    any other. ``deviation`` is null where it does not fit 64 bits.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = (f"id {kind}, component int, n bigint, deviation bigint, whitened double, "
              "explained double, identity_error double")
    made = fit(vectors, vector_col, most)
    if made is None or not len(made.values):
        return vectors.sparkSession.createDataFrame([], schema)
    error, whole = identity_error(vectors, made, vector_col), made.whole
    d, k = len(made.sums), len(made.values)
    share = made.values / made.trace

    def rows(batch):
        at, x = _vectors(batch.column(1), d)
        y, n = x - whole, len(at) * k
        owner = pa.array(np.repeat(at, k))
        deviation = pa.array(made.deviation(y), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(owner), pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
             pa.array(np.full(n, made.n)), deviation.take(pa.array(np.repeat(np.arange(len(at)), k))),
             pa.array(made.whitened(y).ravel()), pa.array(np.tile(share, len(at))),
             pa.array(np.full(n, error))],
            ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return map_arrow(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(
        "array<double>").alias("v")), rows, schema)
