"""Whitening of vectors by principal components, to double precision.

Vectors become whole numbers of 256ths. The fit list is each distinct vector once, so copies in any
number count once. Tasks add up sums, then products of entries less the whole number nearest to
the mean; all these sums are exact, and the small rest of the mean is taken off exactly, so the
covariance is that of centred entries without any rounding.

Eigenvectors are computed in float32 and corrected by Ogita-Aishima iterations: matrix products in
higher precision show how far the vectors are from orthonormal (``R = I - X'X``) and the matrix from
diagonal (``S = X'AX``), and ``X + XE`` has about twice as many right digits. Where eigenvalues are closer
than the present error can tell apart, ``E`` only restores orthogonality, and the vectors of such a
cluster are turned by a sub-solve of the cluster's own small matrix, shifted to its middle. Only
matrices of ``dims`` by ``dims`` numbers reach the driver.

Cases: vectors that are null or empty or hold null or non-finite entries are left out, as are those with
an entry of 2**22 or more and those of another length than most (the longer of equally frequent
ones): they have no place in the covariance. Components whose eigenvalue is below 10**-12 of the
trace do not exist: fewer distinct vectors than components give fewer, one distinct vector gives no
row. A ``deviation`` beyond a long is null. Rows that repeat get equal results; an empty
table gives an empty result; other columns play no part.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.integer_vectors import SCALE, as_matrix, exact_products, integer_rows
from shelfwise.session import materialize

KIND = "<i4"
LIMIT = SCALE << 22  # of a whole-number entry
HIGH = np.longdouble
ROUNDS = 12
RANK = 1e-12
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double,"
          " identity_error double")


def eigenvectors(matrix: np.ndarray, rounds: int = ROUNDS):
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    matrix = matrix.astype(HIGH)
    scale = np.abs(matrix).max()
    if not scale:
        return np.zeros(len(matrix), HIGH), np.eye(len(matrix), dtype=HIGH)
    a = matrix / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)
    norm = np.linalg.norm(a.astype(float), 2)
    for _ in range(rounds):
        x, values, error, close = refined(a, x, norm)
        for cluster in clusters_of(values, close):
            x[:, cluster] = sub_solved(a, x[:, cluster], values[cluster].mean())
        if error < 8 * np.finfo(HIGH).eps:
            break
    x = x + x @ ((np.eye(len(a), dtype=HIGH) - x.T @ x) / 2)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(0))
    x *= np.where(x[np.abs(x).argmax(0), np.arange(len(a))] < 0, -1, 1)
    return values[order] * scale, x


def refined(a, x, norm):
    """One iteration, with vectors in the order of falling eigenvalues; the size of the
    correction, and the distance at which eigenvalues count as close."""
    rest = np.eye(len(a), dtype=HIGH) - x.T @ x
    turned = x.T @ (a @ x)
    turned = (turned + turned.T) / 2  # so that rounding between close values only rotates
    values = np.diag(turned) / (1 - np.diag(rest))
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    rest, turned = rest[np.ix_(order, order)], turned[np.ix_(order, order)]
    aside = (turned - np.diag(values)).astype(float)
    close = 2 * (np.linalg.norm(aside, 2) + norm * np.linalg.norm(rest.astype(float), 2))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > close
    step = np.where(apart, (turned + values * rest) / np.where(apart, gap, 1), rest / 2)
    return x + x @ step, values, np.abs(step).max(), close


def clusters_of(values, close):
    """Runs of two or more falling values, each ``close`` to the next."""
    ends = np.flatnonzero(values[:-1] - values[1:] > close) + 1
    return [run for run in np.split(np.arange(len(values)), ends) if len(run) > 1]


def sub_solved(a, x, middle):
    """The vectors of one cluster, turned within the space they span."""
    for _ in range(2):  # orthonormal again, to high precision
        x = x + x @ ((np.eye(x.shape[1], dtype=HIGH) - x.T @ x) / 2)
    own = x.T @ (a @ x - middle * x)
    size = np.abs(own).max()
    if not size:
        return x
    turn = np.linalg.eigh(((own + own.T) / (2 * size)).astype(float))[1]
    return x @ turn[:, ::-1].astype(HIGH)


def high(number: Fraction) -> HIGH:
    first = float(number)
    return HIGH(first) + HIGH(float(number - Fraction(first)))


@dataclass
class Fit:
    """What whitening needs: the distinct vectors' number and sums, a whole number near the mean
    of each entry and the rest of it, and the projection, scaled."""

    n: int
    sums: list[int]
    middle: np.ndarray
    rest: np.ndarray
    project: np.ndarray
    explained: list[float]

    def whitened(self, rows):
        return ((rows - self.middle).astype(float) - self.rest) @ self.project


def counted(batches, dims: int) -> Iterator[pa.RecordBatch]:
    n, sums = 0, np.zeros(dims, object)
    for batch in batches:
        n += batch.num_rows
        sums = sums + as_matrix(batch.column("x"), dims, KIND).sum(0).astype(object)
    yield pa.RecordBatch.from_arrays(
        [pa.array([n]), whole_numbers([sums])], names=["n", "row"])


def whole_numbers(rows) -> pa.Array:
    return pa.array([[Decimal(int(x)) for x in row] for row in rows],
                    pa.list_(pa.decimal128(38, 0)))


def products(batches, dims: int, middle) -> Iterator[pa.RecordBatch]:
    total = np.zeros((dims, dims), object)
    for batch in batches:
        rows = as_matrix(batch.column("x"), dims, KIND) - middle
        total = total + exact_products(rows, rows).astype(object)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(dims), pa.int64()), whole_numbers(total)], names=["n", "row"])


def spread(batches, dims: int, fit: Fit) -> Iterator[pa.RecordBatch]:
    """Sums and products of whitened vectors, as a row of numbers a task."""
    k = fit.project.shape[1]
    total = np.zeros((k + 1, k))
    for batch in batches:
        rows = fit.whitened(as_matrix(batch.column("x"), dims, KIND))
        total[:k] += rows.T @ rows
        total[k] += rows.sum(0)
    yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], names=["row"])


def deviations(rows: np.ndarray, fit: Fit):
    """The exact sum of ``(n * x - S) ** 2`` of each row, None beyond a long."""
    around = float(fit.n) * ((rows - fit.middle).astype(float) - fit.rest)
    size = (around ** 2).sum(1)
    wrapped = np.array([(s + 2 ** 63) % 2 ** 64 - 2 ** 63 for s in fit.sums], np.int64)
    with np.errstate(over="ignore"):  # differences are right whatever the products wrap to
        near = ((rows * np.int64(fit.n) - wrapped) ** 2).sum(1)
    out = np.where(size < 2.0 ** 62, near, 0).astype(object)
    out[size >= 2.0 ** 62] = None
    for i in np.flatnonzero((size >= 2.0 ** 62) & (size < 1.001 * 2.0 ** 63)):
        exact = sum((fit.n * x - s) ** 2 for x, s in zip(rows[i].tolist(), fit.sums))
        out[i] = exact if exact < 2 ** 63 else None
    return pa.array(out.tolist(), pa.int64())


def projected(batches, dims: int, fit: Fit, error: float) -> Iterator[pa.RecordBatch]:
    k = fit.project.shape[1]
    for batch in batches:
        rows = as_matrix(batch.column("x"), dims, KIND)
        each = pa.array(np.repeat(np.arange(len(rows)), k))
        total = len(rows) * k
        yield pa.RecordBatch.from_arrays([
            batch.column("vec_id").take(each),
            pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
            pa.array(np.full(total, fit.n, np.int64)),
            deviations(rows, fit).take(each),
            pa.array(fit.whitened(rows).ravel()),
            pa.array(np.tile(np.array(fit.explained, float), len(rows))),
            pa.array(np.full(total, error)),
        ], names=[part.split()[0] for part in RESULT.split(", ")])


def added(parts: DataFrame, dims: int, *by: str) -> list:
    """The sums of tasks together, one row for each value of ``by``."""
    columns = [F.sum(F.col("row")[i]).alias(f"r{i}") for i in range(dims)]
    first = [F.sum("n").alias("total")] if "n" in parts.columns and not by else []
    return parts.groupBy(*by).agg(*first, *columns).collect()


def covariance(vectors: DataFrame, dims: int):
    """Number, sums, whole middles and the covariance (divisor n, exact fractions) of distinct
    whole-number vectors."""
    kind = "n long, row array<decimal(38,0)>"
    row = added(vectors.mapInArrow(partial(counted, dims=dims), kind), dims)[0]
    n, sums = row.total or 0, [int(row[f"r{i}"] or 0) for i in range(dims)]
    if not n:
        return 0, sums, None, None
    middle = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]  # sums of entries less their middle
    parts = vectors.mapInArrow(
        partial(products, dims=dims, middle=np.array(middle, np.int64)), kind)
    total = {row.n: [int(row[f"r{j}"]) for j in range(dims)] for row in added(parts, dims, "n")}
    matrix = [[Fraction(n * total[i][j] - rest[i] * rest[j], n * n) for j in range(dims)]
              for i in range(dims)]
    return n, sums, middle, matrix


def fitted(vectors: DataFrame, dims: int, components: int) -> Fit | None:
    n, sums, middle, matrix = covariance(vectors, dims)
    if not n:
        return None
    values, x = eigenvectors(np.array([[high(v) for v in row] for row in matrix], HIGH))
    trace = high(sum(matrix[i][i] for i in range(dims)))
    k = min(components, int((values > RANK * trace).sum()))
    rest = np.array([float(Fraction(s, n) - m) for s, m in zip(sums, middle)])
    return Fit(n, sums, np.array(middle, np.int64), rest,
               (x[:, :k] / np.sqrt(values[:k])).astype(float),
               [float(v / trace) for v in values[:k]])


def identity_error(vectors: DataFrame, dims: int, fit: Fit) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = fit.project.shape[1]
    row = added(vectors.mapInArrow(partial(spread, dims=dims, fit=fit), "row array<double>"),
                k * (k + 1))[0]
    total = np.array(row, float).reshape(k + 1, k) / fit.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = 4) -> DataFrame:
    """A row for each vector that takes part and each of the first ``components``."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    whole = "embedding IS NOT NULL AND NOT exists(embedding, c -> c IS NULL OR NOT abs(c) < {})"
    lengths = rows.where(whole.format(LIMIT // SCALE)).groupBy(F.size("embedding").alias("dims"))
    most = lengths.count().where("dims > 0").orderBy(F.desc("count"), F.desc("dims")).first()
    if most is None:
        return spark.createDataFrame([], RESULT)
    dims = most.dims
    valid = materialize(rows.mapInArrow(
        partial(integer_rows, dims=dims, limit=LIMIT, kind=KIND), "vec_id long, x binary"),
        "whole-vectors")
    distinct = materialize(valid.select("x").distinct(), "fit-list")
    fit = fitted(distinct, dims, components)
    if not fit.explained:
        return spark.createDataFrame([], RESULT)
    error = identity_error(distinct, dims, fit)
    return valid.mapInArrow(partial(projected, dims=dims, fit=fit, error=error), RESULT)
