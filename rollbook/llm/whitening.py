"""Whitening of embeddings, with principal components by spectral divide and conquer.

The covariance of the distinct vectors is split by polar decompositions: the polar factor
``U`` of ``A - shift`` has the eigenvalues 1 and -1, so ``(U + I) / 2`` projects on the
eigenvectors above the shift. An orthonormal basis of its range and one of the rest
turn ``A`` into two smaller blocks, each split again, down to single components. The
polar factor comes from QDWH iterations, dynamically weighted Halley steps by a QR
factorisation of a stacked matrix, about six rounds for double precision.

Entries are scaled to whole numbers, ``floor(SCALE * c)``, so sums are exact. Sums, the
covariance (centred before it is multiplied) and the covariance of the whitened vectors
are reduced within tasks to numbers by dimension before they are shuffled. The driver
holds matrices of the dimension only, and broadcasts the mean and the components kept.

Defined cases: vectors that are null or hold null or non-finite entries take no part, nor
do empty ones, nor those of another length than the most frequent one (the larger, if two are
as frequent), as no covariance joins different lengths; entries beyond the range of whole
numbers are an error; equal vectors count once in the fit and are all whitened; a
component without variance is left out, as it cannot be scaled to one; a deviation beyond
the range of a long is null; a null id is kept as a value; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import write_scratch

SCALE = 256
COMPONENTS = 4
EPS = np.finfo(np.float64).eps
TINY = np.finfo(np.float64).tiny
MOST_ROUNDS = 30
#: A component with at most this share of the variance has none but rounding.
NO_VARIANCE = 1e-13
#: Vectors that a task turns into doubles at once.
ROWS_AT_ONCE = 4_096


# --- spectral divide and conquer, on matrices of the dimension ---------------


def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH; an eigenvalue of 0 gives one of about 0."""
    size = len(matrix)
    x = matrix / max(np.linalg.norm(matrix), TINY)
    # A lower bound of the least singular value; one that is too small only costs rounds.
    triangle = np.linalg.qr(x, mode="r")
    low = EPS
    if np.abs(np.diag(triangle)).min() > EPS:
        low = max(1 / (np.linalg.norm(np.linalg.solve(triangle, np.eye(size)), 1) * np.sqrt(size)), EPS)
    for _ in range(MOST_ROUNDS):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        a = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(size)]))
        after = (b / c) * x + (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        after = (after + after.T) / 2
        low = min(low * (a + b * square) / (1 + c * square), 1.0)
        change = np.linalg.norm(after - x)
        x = after
        if change < np.cbrt(EPS) and 1 - low < 10 * EPS:
            break
    return x


def _subspaces(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector and of the rest, from its ``rank`` most independent columns."""
    left, chosen = projector.copy(), []
    for _ in range(rank):
        lengths = np.einsum("ij,ij->j", left, left)
        column = int(np.argmax(lengths))
        chosen.append(column)
        unit = left[:, column] / np.sqrt(lengths[column])
        left -= np.outer(unit, unit @ left)
    basis, _ = np.linalg.qr(projector[:, chosen])
    basis, _ = np.linalg.qr(projector @ basis, mode="complete")
    return basis[:, :rank], basis[:, rank:]


def _halves(matrix: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two invariant subspaces; None if all eigenvalues are one, to rounding.

    The mean of the eigenvalues always lies among them. Where it falls on one, a shift
    elsewhere in their range does better; the best of those tried is taken.
    """
    size, diagonal = len(matrix), np.diag(matrix)
    reach = np.linalg.norm(matrix - np.diag(diagonal))
    low, high = diagonal.min() - reach, diagonal.max() + reach
    best, least = None, np.inf
    for shift in (diagonal.mean(), np.median(diagonal), *np.linspace(low, high, 4 * size + 3)[1:-1]):
        projector = (polar_factor(matrix - shift * np.eye(size)) + np.eye(size)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < size:
            continue
        above, below = _subspaces(projector, rank)
        error = np.linalg.norm(below.T @ matrix @ above)
        if error < least:
            best, least = (above, below), error
        if error <= tolerance:
            break
    return best


def _split(matrix: np.ndarray, tolerance: float) -> list[tuple[float, np.ndarray]]:
    """Eigenvalues and eigenvectors of a symmetric matrix, by halves."""
    diagonal = np.diag(matrix)
    plain = [(float(value), unit) for value, unit in zip(diagonal, np.eye(len(matrix)), strict=True)]
    if np.linalg.norm(matrix - np.diag(diagonal)) <= tolerance / 4:
        return plain
    halves = _halves(matrix, tolerance)
    if halves is None:
        return plain
    found = []
    for basis in halves:
        part = basis.T @ matrix @ basis
        found += [(value, basis @ vector) for value, vector in _split((part + part.T) / 2, tolerance)]
    return found


def spectrum(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and its unit eigenvectors as columns, largest entry positive."""
    tolerance = 8 * EPS * len(matrix) * max(np.linalg.norm(matrix), TINY)
    vectors = np.column_stack([vector for _, vector in sorted(_split(matrix, tolerance), key=lambda pair: -pair[0])])
    vectors, _ = np.linalg.qr(vectors)
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    return values[order], vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])


# --- on Spark ----------------------------------------------------------------


@dataclass
class Whitening:
    """What the fit found: a few numbers for each dimension, whatever the table."""

    count: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([total / self.count for total in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)


def whole_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, x): the rows that take part, with their entries as whole numbers."""
    rows = table.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("entries"))
    finite = F.forall("entries", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(finite & (F.size("entries") > 0))
    lengths = rows.groupBy(F.size("entries").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    rows = rows.where(F.size("entries") == (lengths.length if lengths else 0))
    return rows.select("key", F.transform("entries", _whole).alias("x"))


def _whole(c: Column) -> Column:
    scaled = F.floor(c * SCALE)
    return F.when(F.abs(c) < 2.0**63 / SCALE, scaled).otherwise(F.raise_error(F.lit("an entry is beyond the range of whole numbers")).cast("long"))


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _batches(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in rows:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            yield part, _matrix(part.column("x"))


def _exact_sums(x: np.ndarray) -> list[int]:
    """Column sums as Python numbers; halves of 32 bits cannot overflow within a batch."""
    low = (x & 0xFFFFFFFF).sum(axis=0)
    high = (x >> 32).sum(axis=0)
    return [(int(h) << 32) + int(l) for h, l in zip(high, low, strict=True)]


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""

    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, totals = 0, None
        for _, x in _batches(rows):
            sums = _exact_sums(x)
            totals = sums if totals is None else [a + b for a, b in zip(totals, sums, strict=True)]
            count += len(x)
        if totals is not None:
            values = pa.array([Decimal(v) for v in (count, *totals)], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(totals)), pa.int32()), values], ["at", "value"])

    parts = fit.mapInArrow(task, "at int, value decimal(38,0)")
    found = {row.at: int(row.value) for row in parts.groupBy("at").agg(F.sum("value").alias("value")).collect()}
    return found.get(-1, 0), [found[at] for at in range(len(found) - 1)]


def _products(fit: DataFrame, centred: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``y.T @ y`` over all vectors, y being what ``centred`` makes of them, with a column of ones added."""

    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for _, x in _batches(rows):
            y = np.column_stack([centred(x), np.ones(len(x))])
            total += y.T @ y
        if total[-1, -1]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "value"])

    parts = fit.mapInArrow(task, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    cells = parts.toArrow()
    out = np.zeros((size + 1) ** 2)
    out[cells.column("cell").to_numpy()] = cells.column("value").to_numpy()
    return out.reshape(size + 1, size + 1)


def _covariance(products: np.ndarray) -> np.ndarray:
    """Covariance from the sums of products; the ones hold the mean that centring left."""
    count, left = products[-1, -1], products[:-1, -1] / products[-1, -1]
    return products[:-1, :-1] / count - np.outer(left, left)


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct vector once, as a written table."""
    return write_scratch(rows.select("x").distinct(), "distinct_vectors")


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of distinct ``x``; None if it has no rows."""
    count, sums = _sums(vectors)
    if not count:
        return None
    model = Whitening(count, sums, 0.0, np.zeros(0), np.zeros((len(sums), 0)))
    mean = model.mean
    covariance = _covariance(_products(vectors, lambda x: x - mean, len(sums)))
    model.trace = float(np.trace(covariance))
    values, basis = spectrum(covariance)
    some = int((values[:components] > NO_VARIANCE * model.trace).sum())
    model.values, model.vectors = values[:some], basis[:, :some]
    return model


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """How far the covariance of the whitened vectors is from the identity, at most."""
    size = len(model.values)
    return float(np.abs(_covariance(_products(vectors, model.project, size)) - np.eye(size)).max()) if size else 0.0


def _deviations(x: np.ndarray, count: int, sums: list[int]) -> list[int | None]:
    """Sum of (count * x - sums) ** 2 for each row, exactly; None beyond the range of a long."""
    reach = count * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    exact = np.int64 if reach < 2**62 and len(sums) * reach * reach < 2**63 else object
    off = x.astype(exact) * count - np.array(sums, exact)
    return [int(total) if total < 2**63 else None for total in (off * off).sum(axis=1)]


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """(key, component, deviation, whitened, explained): a row for each row of (key, x) and each component, from 1."""
    kind = "key long, component int, deviation long, whitened double, explained double"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = model.values / model.trace if model else np.zeros(0)
        for part, x in _batches(batches):
            if not len(share):
                continue
            each = np.repeat(np.arange(len(x)), len(share))
            deviations = pa.array(_deviations(x, model.count, model.sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key").take(pa.array(each)), pa.array(np.tile(np.arange(1, len(share) + 1, dtype=np.int32), len(x))),
                    deviations.take(pa.array(each)), pa.array(model.project(x).ravel()), pa.array(np.tile(share, len(x))),
                ],
                ["key", "component", "deviation", "whitened", "explained"],
            )

    return rows.mapInArrow(task, kind)
