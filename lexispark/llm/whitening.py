"""Embedding whitening by FEAST contour integration (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .vectors import integer_vectors, slices

#: Integers of a component, x = floor(SCALE * c) + SHIFT, and the components that are returned.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Eigenvalues that one interval is meant to hold, and quadrature points on its half circle.
GROUP, NODES = 8, 16
#: floor(SCALE * c) stays below this; n times a component of x then fits 64 bits for up to 2^41 rows.
_LARGEST = 1 << 20
_TURNS, _EPS = 40, np.finfo(np.float64).eps


# ---- exact moments ----------------------------------------------------------------------

def _products(centre: np.ndarray, largest: int):
    """Per task the sums of products of centred integers, (i, j, total) for i <= j.

    Double products of integers are exact as long as their sums stay below 2^53; slices keep to that.
    """
    width = len(centre)
    exact = max(1, (1 << 53) // max(largest * largest, 1))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), np.int64)
        for _, x in slices(batches, width):
            for first in range(0, len(x), exact):
                z = (x[first:first + exact] - centre).astype(np.float64)
                total += (z.T @ z).astype(np.int64)
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         names=["i", "j", "total"])
    return multiply


@dataclass
class Moments:
    """Number of vectors, sum of each dimension, and covariance with divisor n."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray


def moments(rows: DataFrame, width: int) -> Moments:
    """Exact integer sums over ``rows(x)``; centred before they are multiplied, and divided once at the end."""
    n = rows.count()
    parts = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum("v").alias("total"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    sums, lo, hi = (np.zeros(width, np.int64) for _ in range(3))
    for r in parts:
        sums[r["i"]], lo[r["i"]], hi[r["i"]] = r["total"], r["lo"], r["hi"]
    if not n or not width:
        return Moments(n, sums, np.zeros((width, width)))
    centre = (2 * sums + n) // (2 * n)
    largest = int(max((hi - centre).max(), (centre - lo).max()))
    if largest * largest * n >= 1 << 63:
        raise ValueError(f"sums of {n} products of integers up to {largest} do not fit 64 bits")
    products = rows.select("x").mapInArrow(_products(centre, largest), "i int, j int, total bigint").groupBy("i", "j").agg(
        F.sum("total").alias("total")).collect()
    rest = [int(s) - n * int(c) for s, c in zip(sums, centre)]
    covariance = np.zeros((width, width))
    for r in products:
        covariance[r["i"], r["j"]] = covariance[r["j"], r["i"]] = (
            (n * r["total"] - rest[r["i"]] * rest[r["j"]]) / (n * n))
    return Moments(n, sums, covariance)


# ---- inertia ----------------------------------------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of a tridiagonal matrix with the eigenvalues of ``matrix`` (Householder)."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        v = a[k + 1:, k].copy()
        length = np.linalg.norm(v)
        if length == 0:
            continue
        v[0] += length if v[0] >= 0 else -length
        v /= np.linalg.norm(v)
        p = a[k + 1:, k + 1:] @ v
        w = p - (v @ p) * v
        a[k + 1:, k + 1:] -= 2 * (np.outer(v, w) + np.outer(w, v))
        left = a[k + 1:, k] - 2 * v * (v @ a[k + 1:, k])
        a[k + 1:, k] = a[k, k + 1:] = left
    return np.diag(a).copy(), np.diag(a, 1) ** 2


class Inertia:
    """How many eigenvalues of a symmetric matrix lie above a shift: the signs of the pivots of the shifted matrix."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, self.squares = tridiagonal(matrix)
        self.scale = float(np.abs(matrix).sum(1).max()) if len(matrix) else 0.0
        self.least = max(self.scale, 1e-300) * _EPS * _EPS

    def above(self, shifts: np.ndarray) -> np.ndarray:
        """Number of eigenvalues above each shift (Sylvester's law)."""
        shifts = np.asarray(shifts, np.float64)
        pivot = np.ones(shifts.shape)
        count = np.zeros(shifts.shape, np.int64)
        for k, d in enumerate(self.diagonal.tolist()):
            pivot = d - shifts - (self.squares[k - 1] / pivot if k else 0.0)
            pivot = np.where(np.abs(pivot) < self.least, -self.least, pivot)
            count += pivot > 0
        return count

    def values(self, wanted: int) -> np.ndarray:
        """The ``wanted`` largest eigenvalues to about 1e-13 of the scale, by bisection on the counts."""
        rank = np.arange(1, wanted + 1)
        low, high = np.full(wanted, -self.scale), np.full(wanted, self.scale)
        for _ in range(48):
            middle = (low + high) / 2
            more = self.above(middle) >= rank
            low, high = np.where(more, middle, low), np.where(more, high, middle)
        return (low + high) / 2


def intervals(inertia: Inertia, wanted: int) -> list[tuple[float, float, int]]:
    """(lo, hi, count): intervals that hold the ``wanted`` largest eigenvalues, each between two gaps.

    About GROUP values each; a cluster that no gap divides stays in one interval, so the last may hold more
    values than are asked for.
    """
    size = len(inertia.diagonal)
    values = inertia.values(size)
    gap = values[:-1] - values[1:]
    clear = gap > 1e-9 * inertia.scale
    found, start = [], 0
    while start < wanted:
        stop = min(start + GROUP, size)
        if stop < size:
            lower = max(start + 1, stop - GROUP // 2)
            choices = np.arange(lower, min(stop + GROUP // 2, size - 1) + 1)
            stop = int(choices[np.argmax(gap[choices - 1])])  # the widest gap near the wanted size
            while stop < size and not clear[stop - 1]:
                stop += 1
        top = values[0] + 0.1 * max(values[0] - values[-1], inertia.scale * 1e-6) if start == 0 else (
            values[start - 1] + values[start]) / 2
        bottom = (values[stop - 1] + values[stop]) / 2 if stop < size else (
            values[-1] - 0.1 * max(values[0] - values[-1], inertia.scale * 1e-6))
        above = inertia.above(np.array([bottom, top]))
        found.append((float(bottom), float(top), int(above[0] - above[1])))
        start = stop
    return found


# ---- contour integration ----------------------------------------------------------------

def feast(matrix: np.ndarray, low: float, high: float, count: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """All ``count`` eigenvalues in (low, high), falling, and their vectors as columns.

    Quadrature on the circle over the interval sums solves with the complex shifted matrix: this
    filters a block of random columns to the wanted eigenspace. Rayleigh-Ritz on the filtered block gives
    values and vectors, which are filtered again until their residuals are down to rounding.
    The number of values inside has to be that of the inertia counts, else the block is widened.
    """
    size = len(matrix)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angle = -np.pi / 2 * (nodes - 1)
    centre, radius = (low + high) / 2, (high - low) / 2
    columns = min(size, count + max(count, 4))
    while True:
        block = np.random.default_rng(13).normal(size=(size, columns))
        before = np.inf
        for _ in range(_TURNS):
            filtered = np.zeros_like(block)
            for a, weight in zip(angle, weights):
                turn = radius * np.exp(1j * a)
                solved = np.linalg.solve((centre + turn) * np.eye(size) - matrix, block.astype(np.complex128))
                filtered += weight / 2 * (turn * solved).real
            basis, strength, _ = np.linalg.svd(filtered, full_matrices=False)
            basis = basis[:, strength > strength[0] * 1e-14]
            ritz, turned = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ turned
            inside = np.flatnonzero((ritz > low) & (ritz < high))
            residual = np.abs(matrix @ block[:, inside] - block[:, inside] * ritz[inside]).max() if len(inside) else np.inf
            if len(inside) == count and (residual <= 8 * _EPS * scale or residual >= before / 2 and residual <= 1e-12 * scale):
                order = inside[::-1]
                return ritz[order], block[:, order]
            before = residual
        if columns == size:
            raise ArithmeticError(f"{len(inside)} eigenvalues found in ({low}, {high}), {count} counted")
        columns = min(size, 2 * columns)


@dataclass
class Components:
    """Largest eigenvalues of a covariance, falling, with unit eigenvectors as columns."""

    values: np.ndarray
    vectors: np.ndarray


def components(spark: SparkSession, covariance: np.ndarray, wanted: int = COMPONENTS) -> Components:
    """Up to ``wanted`` components with eigenvalues above rounding; every interval is a task of its own.

    The covariance goes to each task: its size is the square of the dimension, whatever the number of rows.
    A last Rayleigh-Ritz step over all found vectors makes those of different intervals orthogonal.
    """
    inertia = Inertia(covariance)
    floor = len(covariance) * _EPS * inertia.scale * 16
    wanted = min(wanted, int(inertia.above(np.array([floor]))[0])) if inertia.scale else 0
    if not wanted:
        return Components(np.empty(0), np.empty((len(covariance), 0)))
    tasks = intervals(inertia, wanted)
    scale = inertia.scale

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low, high, count in zip(batch["low"], batch["high"], batch["count"]):
                values, vectors = feast(covariance, low, high, count, scale)
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    found = spark.createDataFrame(tasks, "low double, high double, count int").repartition(len(tasks)).mapInPandas(
        solve, "value double, vector array<double>").orderBy(F.desc("value")).collect()
    if len(found) != sum(count for *_, count in tasks):
        raise ArithmeticError(f"{len(found)} eigenvalues found, {sum(count for *_, count in tasks)} counted")
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in found]).T)
    ritz, turned = np.linalg.eigh(basis.T @ covariance @ basis)
    return Components(ritz[::-1][:wanted].copy(), (basis @ turned)[:, ::-1][:, :wanted].copy())


# ---- whitening --------------------------------------------------------------------------

def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact."""
    return x * np.int64(n) - sums


def _whitened_sums(made: Moments, maps: np.ndarray):
    """Per task the sums and products of the whitened vectors; row 0 of a product is with the constant 1."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((maps.shape[1] + 1,) * 2)
        for _, x in slices(batches, len(made.sums)):
            w = np.hstack([np.ones((len(x), 1)), _centred(x, made.n, made.sums) / made.n @ maps])
            total += w.T @ w
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         names=["i", "j", "total"])
    return add


def identity_error(rows: DataFrame, made: Moments, maps: np.ndarray) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    size = maps.shape[1] + 1
    total = np.zeros((size, size))
    for r in rows.select("x").mapInArrow(_whitened_sums(made, maps), "i int, j int, total double").groupBy("i", "j").agg(
            F.sum("total").alias("total")).collect():
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = r["total"]
    mean = total[0, 1:] / made.n
    return float(np.abs(total[1:, 1:] / made.n - np.outer(mean, mean) - np.eye(size - 1)).max())


def deviations(gap: np.ndarray) -> list[int | None]:
    """Exact sums of squares of integer rows; None where one does not fit a long."""
    if not gap.size:
        return [0] * len(gap)
    if int(np.abs(gap).max()) ** 2 * gap.shape[1] < 1 << 63:
        return (gap * gap).sum(1).tolist()
    sums = (sum(v * v for v in row) for row in gap.tolist())
    return [s if s < 1 << 63 else None for s in sums]


def _projected(made: Moments, maps: np.ndarray):
    """One row per vector and component."""
    names = ["vec_id", "component", "deviation", "whitened"]
    n_components = maps.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, x in slices(batches, len(made.sums)):
            gap = _centred(x, made.n, made.sums)
            whitened = gap / made.n @ maps
            row = pa.array(np.repeat(np.arange(len(x)), n_components))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(row), pa.array(np.tile(np.arange(1, n_components + 1, dtype=np.int32), len(x))),
                 pa.array(deviations(gap), pa.int64()).take(row), pa.array(whitened.reshape(-1))], names=names)
    return project


def whitened(embeddings: DataFrame, vector: str = "embedding", wanted: int = COMPONENTS, scale: int = SCALE,
             shift: int = SHIFT) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every finite vector and component.

    Sums and covariance of the integer vectors x are exact: integers are centred at the rounded mean,
    multiplied and summed on the cluster, and one row per pair of dimensions reaches the driver. Components
    come from ``components``; the covariance of the whitened vectors is measured in a pass of its own.

    Defined cases: vectors that are null or hold null or non-finite entries are dropped; shorter vectors count
    as filled up with zeros; repeated rows each count; null ids are kept; components whose eigenvalue is zero
    up to rounding are not returned (constant dimensions, fewer vectors than dimensions, equal
    vectors alone); of equal eigenvalues the order is open; an empty table has no result; ``deviation``
    is null where it exceeds a long; other columns are ignored; entries of 2^20 / scale and more raise
    ValueError.
    """
    rows, width = integer_vectors(embeddings, vector, scale, shift, 1, _LARGEST, vec_id=F.col("vec_id").cast("bigint"))
    made = moments(rows, width)
    found = components(embeddings.sparkSession, made.covariance, wanted)
    maps = found.vectors / np.sqrt(found.values)
    schema = "vec_id bigint, component int, deviation bigint, whitened double"
    off, trace = (identity_error(rows, made, maps), np.trace(made.covariance)) if len(found.values) else (0.0, 1.0)
    shares = F.array(*[F.lit(float(v / trace)) for v in found.values]).cast("array<double>")
    return rows.select("vec_id", "x").mapInArrow(_projected(made, maps), schema).select(
        "vec_id", "component", F.lit(made.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"), F.lit(off).alias("identity_error"))
