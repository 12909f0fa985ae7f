"""Whitening of vectors by the leading eigenvectors of their covariance, found by a Jacobi-Davidson iteration that never forms a matrix.

A component c of a vector becomes the whole number floor(256 * c), c as double. The covariance is that of the distinct
vectors. It is only ever applied to a few directions at a time: each product is a job in which tasks centre their vectors, multiply, and return
a matrix of (dimension x directions) sums with their rounding errors. The driver holds the search space, of at most dimension x SPACE numbers.

A round takes the Ritz pairs of the search space, locks the leading ones whose residual has reached double precision, and extends
the space by corrections for the others. A correction solves the equation projected beyond the locked and the current vectors with a few
steps of MINRES; the steps for all vectors go on together, so that they share one job.

Vectors that are null or hold null or non-finite components take no part. Where dimensions differ, those of the most frequent dimension (of equally
frequent ones the largest) take part and the rest are left out. Rows that repeat a vector or a vec_id each get their results; null vec_ids do, too.
Directions without variance cannot be whitened: their components are left out, all of them if all vectors are equal. Vectors without
components, and empty tables, give no rows. A deviation that does not fit a long, and a finite component of 2^62 / 256 or more, fail.
Components of equal eigenvalues are any orthonormal basis of their space. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stored

SCALE = 256
COMPONENTS = 4
# Directions of the search space before it is cut back to KEPT Ritz vectors.
SPACE, KEPT = 48, 16
INNER, ROUNDS = 4, 500
FAR = 0.01
# Rounding can keep residuals above PRECISION, but not above this.
ROUNDED = 1e-12
# A residual of so many units of rounding of the largest eigenvalue is double precision.
PRECISION = 32
BLOCK = 4096
EPS = float(np.finfo(np.float64).eps)
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


class Fit(NamedTuple):
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    identity_error: float
    products: int


def _whole(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, x): usable vectors as little-endian longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1)
            offsets = values.offsets.to_numpy().astype(np.int64)
            given = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(SCALE * given)
            bad, large = (np.concatenate([[0], np.cumsum(which)]) for which in (~np.isfinite(given), ~(np.abs(flat) < 2.0**62)))
            usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & values.is_valid().to_numpy(zero_copy_only=False)
            if (usable & (large[offsets[1:]] != large[offsets[:-1]])).any():
                raise OverflowError("a finite component of a vector is too large for a whole number of 62 bits")
            whole = np.where(np.isfinite(flat), flat, 0).astype("<i8")
            rows = np.nonzero(usable)[0]
            raw = [whole[offsets[r] : offsets[r + 1]].tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(raw, pa.binary())], ["vec_id", "x"])

    chosen = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    return chosen.mapInArrow(run, "vec_id long, x binary")


def _matrices(batches: Iterator[pa.RecordBatch], column: int, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            some = batch.slice(at, BLOCK)
            yield some, np.frombuffer(b"".join(some.column(column).to_pylist()), "<i8").reshape(-1, width)


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: longs where they fit, else Python's whole numbers."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0) < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _deviations(scaled: np.ndarray) -> np.ndarray:
    """Sums of squares, exact."""
    if scaled.dtype != object and int(np.abs(scaled).max(initial=0)) ** 2 * scaled.shape[1] < 2**63:
        return (scaled * scaled).sum(axis=1)
    exact = [int(v) for v in (scaled.astype(object) ** 2).sum(axis=1)]
    if max(exact, default=0) >= 2**63:
        raise OverflowError("a deviation does not fit a long")
    return np.array(exact, np.int64)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _scaled(x, n, sums).astype(np.float64) / n


def _add(total: np.ndarray, lost: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """total + more, and what rounding has lost so far."""
    new = total + more
    virtual = new - total
    return new, lost + ((total - (new - virtual)) + (more - virtual))


def _summed(frame: DataFrame, tasks: int, of: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum of `of` over all rows: the tasks sum their own blocks, then, of many tasks, some sum the tasks' sums, then the driver those."""

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from out(of(x) for _, x in _matrices(batches, 0, width))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from out(part for batch in batches for pair in zip(*(batch.column(i).to_pylist() for i in (0, 1))) for part in map(_unpacked, pair))

    def out(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = lost = None
        for part in parts:
            total, lost = (part, np.zeros_like(part)) if total is None else _add(total, lost, part)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([a.astype("<f8").tobytes()], pa.binary()) for a in (total, lost)], ["total", "lost"])

    sums = frame.select("x").mapInArrow(begin, "total binary, lost binary")
    if tasks > 256:
        sums = sums.repartition(int(tasks**0.5)).mapInArrow(again, "total binary, lost binary")
    total = lost = None
    for row in sums.collect():
        for part in (_unpacked(row.total), _unpacked(row.lost)):
            total, lost = (part, np.zeros_like(part)) if total is None else _add(total, lost, part)
    return total + lost


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(bytes(raw), "<f8")


def _orthonormal(new: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Columns that extend the orthonormal columns of space; those that add nothing are left out."""
    found = space
    for column in new.T:
        size = np.linalg.norm(column)
        for _ in range(3):
            column = column - found @ (found.T @ column)
        left = np.linalg.norm(column)
        if size > 0 and left > 1e-8 * size:
            column = column / left
            column = column - found @ (found.T @ column)
            found = np.column_stack([found, column / np.linalg.norm(column)])
    return found[:, space.shape[1] :]


def _corrections(product: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, beyond: np.ndarray, residuals: np.ndarray, inner: int) -> np.ndarray:
    """MINRES for (V - shift) t = -residual, projected beyond the given orthonormal vectors; one column for each shift."""

    def projected(z: np.ndarray) -> np.ndarray:
        return z - beyond @ (beyond.T @ z)

    right = projected(-residuals)
    beta = np.linalg.norm(right, axis=0)
    live = beta > 0
    scale = lambda v, by: v / np.where(by > 0, by, 1)
    v_old, v = np.zeros_like(right), scale(right, beta)
    w_old, w, t = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    cosine, sine, cosine_old, sine_old = np.ones_like(beta), np.zeros_like(beta), np.ones_like(beta), np.zeros_like(beta)
    rest, last = beta.copy(), np.zeros_like(beta)
    for _ in range(inner):
        if not live.any():
            break
        p = projected(product(projected(v)) - v * shifts) - v_old * last
        alpha = (v * p).sum(axis=0)
        p = p - v * alpha
        following = np.linalg.norm(p, axis=0)
        # Two earlier rotations act on the new column of the tridiagonal matrix, a new one ends it.
        upper = sine_old * last
        middle = cosine * cosine_old * last + sine * alpha
        lower = cosine * alpha - sine * cosine_old * last
        length = np.hypot(lower, following)
        live &= length > EPS * np.abs(shifts).max(initial=1)
        new_cosine, new_sine = scale(lower, length), scale(following, length)
        direction = scale(v - w_old * upper - w * middle, length)
        t = np.where(live, t + direction * (new_cosine * rest), t)
        rest = -new_sine * rest
        w_old, w, v_old, v = w, direction, v, scale(p, following)
        cosine_old, sine_old, cosine, sine, last = cosine, sine, new_cosine, new_sine, following
        live &= following > EPS * np.abs(shifts).max(initial=1)
    return projected(t)


def leading_eigenpairs(product: Callable[[np.ndarray], np.ndarray], width: int, wanted: int = COMPONENTS, inner: int = INNER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric positive operator, their unit vectors in columns, and the residuals' lengths."""
    wanted = min(wanted, width)
    space = _orthonormal(np.random.default_rng(11).standard_normal((width, min(2 * wanted, width))), np.zeros((width, 0)))
    image = product(space)
    locked, best, waited = 0, np.inf, 0
    for _ in range(ROUNDS):
        small = space.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors, images = space @ turn, image @ turn
        residuals = images[:, :wanted] - vectors[:, :wanted] * values[:wanted]
        lengths = np.linalg.norm(residuals, axis=0)
        good = lengths <= PRECISION * EPS * max(values[0], 0)
        locked = wanted if good.all() else int(np.argmin(good))
        left = lengths[locked:].max(initial=0)
        waited = waited + 1 if left > best / 2 and left <= ROUNDED * values[0] else 0
        best = min(best, left)
        if locked == wanted or space.shape[1] == width or waited > 8:
            break
        if space.shape[1] + wanted - locked > min(SPACE, width):
            keep = min(KEPT, width)
            space, image = vectors[:, :keep], images[:, :keep]
        current = slice(locked, wanted)
        # A pair that is still far off is shifted beyond what its eigenvalue can be.
        far = lengths[current] > FAR * values[0]
        more = _corrections(product, values[current] + np.where(far, lengths[current], 0), vectors[:, :wanted], residuals[:, current], inner)
        more = _orthonormal(more, space)
        if not more.shape[1]:
            more = _orthonormal(np.random.default_rng(space.shape[1]).standard_normal((width, 1)), space)
        space, image = np.column_stack([space, more]), np.column_stack([image, product(more)])
    else:
        raise ArithmeticError(f"residuals of {lengths} after {ROUNDS} rounds, largest eigenvalue {values[0]}")
    # Once more from the vectors themselves, without what earlier products have gathered of rounding.
    vectors = _orthonormal(vectors[:, :wanted], np.zeros((width, 0)))
    image = product(vectors)
    small = vectors.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors, images = vectors @ turn, image @ turn
    return values, vectors, np.linalg.norm(images - vectors * values, axis=0)


def fit(known: DataFrame, width: int, wanted: int = COMPONENTS) -> Fit | None:
    """The components of the distinct vectors x of a stored table."""
    distinct = stored(known.select("x").distinct(), "whitening-distinct")
    n = distinct.count()
    if not n or not width:
        return None
    tasks = distinct.rdd.getNumPartitions()
    # Whole numbers below 2^62 in three parts of 21 bits, so that sums over up to 2^32 rows are exact in doubles.
    mask = (1 << 21) - 1
    thirds = _summed(distinct, tasks, lambda x: np.concatenate([part.sum(axis=0).astype(np.float64) for part in (x & mask, x >> 21 & mask, x >> 42)]), width)
    low, middle, high = (list(map(int, part)) for part in thirds.reshape(3, width))
    sums = [a + (b << 21) + (c << 42) for a, b, c in zip(low, middle, high)]
    products = 0

    def product(directions: np.ndarray) -> np.ndarray:
        nonlocal products
        products += 1

        def of(x: np.ndarray) -> np.ndarray:
            centred = _centred(x, n, sums)
            return (centred.T @ (centred @ directions)).ravel()

        return _summed(distinct, tasks, of, width).reshape(directions.shape) / n

    trace = float(_summed(distinct, tasks, lambda x: np.array([(_centred(x, n, sums) ** 2).sum()]), width)[0] / n)
    if trace == 0:
        return None
    values, vectors, residuals = leading_eigenpairs(product, width, wanted)
    use = values > PRECISION * EPS * values[0] * width
    values, vectors = values[use], vectors[:, use]
    weights = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        white = _centred(x, n, sums) @ weights
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    found = _summed(distinct, tasks, moments, width) / n
    mean, second = found[: len(values)], found[len(values) :].reshape(len(values), len(values))
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(values))).max())
    return Fit(n, sums, trace, values, vectors, residuals[use], error, products)


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """WHITENED of every usable vector: a row for each component, numbered from 1 by falling eigenvalue."""
    spark = vectors.sparkSession
    known = stored(_whole(vectors, id_column, vector_column), "whitening-vectors")
    size = (F.length("x") / 8).cast("int").alias("width")
    most = known.groupBy(size).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = most.width if most else 0
    known = known.where(F.length("x") == 8 * width)
    found = fit(known, width, wanted)
    if found is None:
        return spark.createDataFrame([], WHITENED)
    weights = found.vectors / np.sqrt(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = weights.shape[1]
        for batch, x in _matrices(batches, 1, width):
            scaled = _scaled(x, found.n, found.sums)
            white = (scaled.astype(np.float64) / found.n) @ weights
            rows = len(x)
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, found.n)), pa.array(np.repeat(_deviations(scaled), k)), pa.array(white.ravel()),
                pa.array(np.tile(found.values / found.trace, rows)), pa.array(np.full(rows * k, found.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [field.split()[0] for field in WHITENED.split(", ")])

    return known.mapInArrow(run, WHITENED)
