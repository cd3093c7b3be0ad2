"""Whitening of embeddings: eigenpairs of their covariance by contour integration.

Spark counts the distinct vectors and sums their centred products; what the driver gets are matrices of the vectors' dimension. There the
largest eigenvalues are enclosed in an interval by inertia counts. Quadrature over a circle through the interval's ends, with a complex
shifted solve at each node, projects a block of vectors onto the interval's eigenvectors; Rayleigh-Ritz extracts the pairs, and the block is
projected again until it no longer changes. The inertia counts say how many pairs the interval holds, so none is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage

#: Steps of a vector's entries per unit, components, nodes of the half circle, and groups that partial sums are added in first.
SCALE, COMPONENTS, NODES, MERGES = 256, 4, 8, 64


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix brought to tridiagonal form by reflections."""
    a = a.copy()
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        if not (length := np.linalg.norm(v)):
            continue
        v /= length
        inner = a[k + 1 :, k + 1 :]
        p = inner @ v
        q = 2 * (p - (v @ p) * v)
        inner -= np.outer(v, q) + np.outer(q, v)
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def above(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues exceed ``shift``: the positive pivots of the shifted matrix, by the law of inertia."""
    diagonal, off = form
    n, pivot = 0, 1.0
    for i, d in enumerate(diagonal.tolist()):
        pivot = d - shift - (off[i - 1] ** 2 / pivot if i else 0.0)
        if pivot == 0.0:
            pivot = -np.finfo(float).tiny**0.5
        n += pivot > 0
    return n


def project(a: np.ndarray, low: float, high: float, block: np.ndarray, nodes: int = NODES) -> np.ndarray:
    """The block's part in the eigenvectors of eigenvalues from ``low`` to ``high``, nearly."""
    places, weights = np.polynomial.legendre.leggauss(nodes)
    radius, unit = (high - low) / 2, np.eye(len(a))
    out = np.zeros_like(block)
    for place, w in zip(places, weights):
        turn = radius * np.exp(0.5j * np.pi * (place + 1))
        out += 0.5 * w * (turn * np.linalg.solve(((high + low) / 2 + turn) * unit - a, block.astype(complex))).real
    return out


def interval_pairs(a: np.ndarray, low: float, high: float, count: int, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues from ``low`` to ``high``, falling, and their vectors as columns; the matrix's norm is about 1.

    A block that does not give them all, as the inertia counts have them, is made twice as wide, up to the whole space.
    """
    exact = len(a) * np.finfo(float).eps
    width = min(len(a), count + max(4, count // 2))
    while True:
        block = np.random.default_rng(width).standard_normal((len(a), width))
        best = np.inf
        for _ in range(rounds):
            basis, _ = np.linalg.qr(project(a, low, high, block))
            small = basis.T @ a @ basis
            values, turns = np.linalg.eigh((small + small.T) / 2)
            block = basis @ turns
            inside = np.flatnonzero((values >= low) & (values <= high))[::-1]
            found, vectors = values[inside], block[:, inside]
            rest = np.abs(a @ vectors - vectors * found).max(initial=0.0)
            if len(found) == count and (rest <= exact or (rest <= 100 * exact and rest >= best)):
                return found, vectors
            best = min(best, rest) if len(found) == count else best
        if width == len(a):
            raise RuntimeError(f"found {len(found)} of {count} eigenvalues from {low} to {high}, with a rest of {rest}")
        width = min(len(a), 2 * width)


def largest_pairs(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their vectors as columns; fewer where the rest are zero but for rounding.

    Each vector's entry of greatest size is positive.
    """
    d = len(covariance)
    trace = float(np.trace(covariance))
    if not d or not trace > 0:
        return np.zeros(0), np.zeros((d, 0))
    a = covariance / trace
    form = tridiagonal(a)
    zero = 4 * d * np.finfo(float).eps
    count = min(count, above(form, zero))
    low, high = zero, float(np.abs(a).sum(axis=1).max()) * (1 + 1e-9) + zero
    top = high
    while (inside := above(form, low)) > count + 4 and top - low > zero:
        middle = (low + top) / 2
        # An edge on an eigenvalue would leave it to rounding on which side that is.
        n = above(form, middle)
        if n >= count and n == above(form, middle - zero) == above(form, middle + zero):
            low = middle
        else:
            top = middle
    values, vectors = interval_pairs(a, low, high, inside)
    values, vectors = values[:count], vectors[:, :count]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(count)])
    return values * trace, vectors * signs


def steps(vector: Column, scale: int = SCALE) -> Column:
    """The entries as whole steps; a NULL vector, entries that are NULL or not finite, give NULL."""
    plain = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    whole = F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return F.when(F.forall(vector, plain), whole)


def _matrix(batch: pa.RecordBatch, column: str, d: int) -> np.ndarray:
    return pc.list_flatten(batch.column(column)).to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(parts: DataFrame, dtype: str) -> list[np.ndarray]:
    """The sums of the partial rows (i, n, data) by i, as [n, *data], added up in two steps."""

    def add(table: pa.Table) -> tuple[int, bytes]:
        n = sum(table["n"].to_pylist())
        return n, np.sum([np.frombuffer(x, dtype) for x in table["data"].to_pylist()], axis=0, dtype=dtype).tobytes()

    def within(key, table):
        n, data = add(table)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "n": [n], "data": pa.array([data], pa.binary())})

    first = parts.withColumn("part", F.spark_partition_id() % MERGES).groupBy("i", "part").applyInArrow(within, "i int, n long, data binary")
    rows = first.groupBy("i").applyInArrow(within, "i int, n long, data binary").collect()
    return [(r.n, np.frombuffer(r.data, dtype)) for r in sorted(rows, key=lambda r: r.i)]


Made = Callable[[np.ndarray], np.ndarray]


def _totals(vectors: DataFrame, d: int, dtype: str, made: Made) -> tuple[int, np.ndarray]:
    """How many vectors there are, and the sums of what is made of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = made(_matrix(batch, "x", d))
            n, total = n + len(x), x.sum(axis=0, dtype=dtype) + (0 if total is None else total)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([n]), pa.array([total.tobytes()], pa.binary())], names=["i", "n", "data"])

    found = _summed(vectors.select("x").mapInArrow(run, "i int, n long, data binary"), dtype)
    return found[0] if found else (0, np.zeros(d, dtype))


def _covariance(vectors: DataFrame, d: int, n: int, made: Made) -> np.ndarray:
    """Of what is made of the vectors, which ``made`` has centred; a row of the matrix per partial row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = made(_matrix(batch, "x", d))
            total = x.T @ x + (0 if total is None else total)
        if total is not None:
            rows = pa.array([r.tobytes() for r in total], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([1] * len(total)), rows], names=["i", "n", "data"])

    found = _summed(vectors.select("x").mapInArrow(run, "i int, n long, data binary"), "f8")
    total = np.stack([row for _, row in found])
    return (total + total.T) / (2 * n)


@dataclass(frozen=True)
class Whitening:
    """The fit list's size and sums per dimension, its components as columns, what they explain, and how far the result is from white."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - self.sums / self.n

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of squares of n * x - S, exact; None where 64 bits don't hold it."""
        rough = ((self.n * x.astype(float) - self.sums) ** 2).sum(axis=1)
        if rough.max(initial=0.0) < 2.0**61 and (np.abs(x).max(initial=0).astype(float) * self.n + np.abs(self.sums).max(initial=0)) < 2.0**61:
            return ((self.n * x - self.sums) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums.tolist())) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def fit(vectors: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Of distinct vectors ``x`` of ``d`` whole numbers, stored."""
    n, sums = _totals(vectors, d, "i8", lambda x: x) if d else (vectors.count(), np.zeros(0, np.int64))
    if not n or not d:
        return Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), np.zeros(0), 0.0)
    covariance = _covariance(vectors, d, n, lambda x: x - sums / n)
    values, axes = largest_pairs(covariance, components)
    white = Whitening(n, sums, values, axes, values / max(np.trace(covariance), np.finfo(float).tiny), 0.0)
    if not len(values):
        return white
    _, total = _totals(vectors, d, "f8", white.apply)
    made = _covariance(vectors, d, n, lambda x: white.apply(x) - total / n)
    return Whitening(n, sums, values, axes, white.explained, float(np.abs(made - np.eye(len(values))).max()))


def whitened(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> tuple[DataFrame, Whitening]:
    """(row, deviation, whitened) for the rows of ``df`` that have a proper vector, and the whitening that was applied.

    Vectors become whole steps of 1 / ``scale``; covariances are over each distinct one once. NULL vectors, and such with entries that are
    NULL or not finite, are dropped; of vectors of different lengths those of the commonest length stay, of equally common lengths the
    longest. Repeated rows stay and count once in the fit. ``whitened`` has a value per component, ``components`` at most: directions
    without variance are no components, so equal vectors alone, or no vectors, give empty arrays. ``deviation`` is NULL where its exact
    value has more than 64 bits; steps beyond 64 bits are the largest ones.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    rows = stage(df.select(row, steps(F.col(f"`{vector}`"), scale).alias("x")).where("x IS NOT NULL"), "whole-vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths.d if lengths else 0
    rows = rows.where(F.size("x") == d)
    white = fit(stage(rows.select("x").distinct(), "distinct-vectors"), d, components)
    sent = df.sparkSession.sparkContext.broadcast(white)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "x", d) if d else np.zeros((batch.num_rows, 0), np.int64)
            made = sent.value.apply(x) if len(sent.value.values) else np.zeros((len(x), 0))
            arrays = [pa.array(sent.value.deviations(x), pa.int64()), pa.array(made.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], names=["row", "deviation", "whitened"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, deviation long, whitened array<double>"), white
