"""Embedding whitening by shifted CholeskyQR.

Vectors become integers, x = floor(256 * c). The fit list holds every distinct x once: equal vectors
meet by their packed bytes, combined on the map side, so a vector that fills a third of the table costs
one row a task. Counts and per-dimension sums are integers and exact.

Let A be the centred fit list, x - S / n. Each pass streams its rows through the triangular solves
against all factors found so far, Q = A R1^-1 R2^-1 ..., and adds up Q'Q: one matrix a task, summed in
two levels. The driver, which sees d x d numbers only, takes its Cholesky factor. The first Gram matrix
is shifted by a multiple of its norm so that the factor exists whatever the condition of A is; two more
passes make Q orthonormal to double precision (later ones are shifted only where dimensions depend on
each other and the factor would not exist). A = Q R with R = R3 R2 R1, so the singular values and right
vectors of R are those of A: eigenvalue e = s^2 / n, component = right vector. No covariance of squared
condition is ever decomposed, and Q is never stored.

The sign of a component makes its entry of largest magnitude positive (the first of equal ones).

Defined cases: rows whose vector is null, empty, holds a null or a non-finite entry or one with
256 * |c| >= 2^62 go. Vectors of several lengths: the commonest length stays (the longer one of equal
counts), the other rows go. Repeated rows all come out, null ids too. Components of an eigenvalue of at
most 1e-12 of the largest one have no whitening and no rows: a table of one distinct vector gives no
rows, an empty one neither. A deviation beyond 64 bits is null. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.storage import settle

SCALE = 256
COMPONENTS = 4
#: Gram passes: a shifted one and two to orthogonalise.
PASSES = 3
#: Eigenvalues of at most this share of the largest count as none.
RANK_SHARE = 1e-12
LARGEST = float(1 << 62)
#: Rows that a pass holds as doubles at once.
ROWS = 8192
UNIT = np.finfo(np.float64).eps / 2


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest integers that hold it, after a byte that tells their width."""
    low, high = x.min(axis=1), x.max(axis=1)
    out: list[bytes] = [b""] * len(x)
    left = np.ones(len(x), bool)
    for kind in ("<i2", "<i4", "<i8"):
        info = np.iinfo(kind)
        fits = np.flatnonzero(left & (low >= info.min) & (high <= info.max))
        left[fits] = False
        mark = bytes([info.bits // 8])
        for i, row in zip(fits.tolist(), x[fits].astype(kind)):
            out[i] = mark + row.tobytes()
    return out


def unpacked(column: pa.Array, dim: int) -> np.ndarray:
    """Packed vectors of one length as a matrix of 64-bit integers."""
    out = np.empty((len(column), dim), np.int64)
    cells = column.to_pylist()
    widths = np.fromiter((c[0] for c in cells), np.int64, len(cells))
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        joined = b"".join(cells[i][1:] for i in rows.tolist())
        out[rows] = np.frombuffer(joined, f"<i{width}").reshape(-1, dim)
    return out


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["vec_id", "dim", "x"]
    for batch in batches:
        lists = batch.column(1)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
        flat = lists.flatten()
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.zeros(0)
        with np.errstate(over="ignore", invalid="ignore"):
            scaled = np.floor(values * SCALE)
            good = np.abs(scaled) < LARGEST
        if flat.null_count:
            good &= flat.is_valid().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        passed = np.concatenate([[0], np.cumsum(good)])
        whole = (sizes > 0) & (passed[ends] - passed[ends - sizes] == sizes)
        for dim in np.unique(sizes[whole]).tolist():
            rows = np.flatnonzero(whole & (sizes == dim))
            x = scaled[(ends - sizes)[rows][:, None] + np.arange(dim)].astype(np.int64)
            cells = [batch.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), dim, np.int32)), pa.array(_packed(x), pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, names=names)


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, dim, x (packed) of the usable rows, written; all of one length."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    found = settle(rows.mapInArrow(_integers, "vec_id long, dim int, x binary"))
    main = found.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    return found.filter(F.col("dim") == (main[0].dim if main else 0))


def _chunks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield unpacked(batch.column(0).slice(at, ROWS), dim)


def _sums(dim: int):
    """Per task: rows, and each dimension's sum as two parts of 32 bits that cannot overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for x in _chunks(batches, dim):
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            columns = {"place": np.arange(dim, dtype=np.int32), "n": np.full(dim, n, np.int64), "high": high, "low": low}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    return run


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """rows R1^-1 R2^-1 ... by substitution against each upper triangle."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(r.shape[0]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _added(shape: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for cell in batch.column(0).to_pylist():
                part = np.frombuffer(cell).reshape(shape)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    return run


def _gram(fit: DataFrame, dim: int, width: int, turned: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of M'M over the fit list, M = turned(x) of `width` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for x in _chunks(batches, dim):
            m = turned(x)
            total += m.T @ m
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    parts = settle(fit.mapInArrow(run, "sums binary"))
    added = _added((width, width))
    level = parts.repartition(math.isqrt(parts.count()) + 1).mapInArrow(added, "sums binary")
    # the square root of the tasks meets in one task, and one matrix reaches the driver, in one job
    top = level.repartition(1).mapInArrow(added, "sums binary").collect()
    return np.frombuffer(bytes(top[0].sums)).reshape(width, width).copy()


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of the Gram matrix, shifted as little as its rank asks for."""
    size = float(np.trace(gram))
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, len(gram) * UNIT * size)


@dataclass
class Whitening:
    """What a fit knows: the exact count and sums, R with A = Q R, components by falling eigenvalue."""

    dim: int
    n: int
    sums: list[int]
    mean: np.ndarray
    r: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components.T / np.sqrt(self.eigenvalues)


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of an integer_vectors() table; None without rows."""
    first = vectors.select("dim").limit(1).collect()
    if not first:
        return None
    dim = first[0].dim
    fit = settle(vectors.select("x").distinct())
    told = fit.mapInArrow(_sums(dim), "place int, n long, high long, low long").groupBy("place")
    told = told.agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    totals = told.orderBy("place").collect()
    n = totals[0].n
    sums = [int(t.high) * (1 << 32) + int(t.low) for t in totals]
    mean = np.array([s / n for s in sums])

    factors: list[np.ndarray] = []
    r = np.eye(dim)
    for step in range(PASSES):
        solved = list(factors)
        gram = _gram(fit, dim, dim, lambda x: _solved(x - mean, solved))
        if not gram.any():
            break
        shift = 11 * (n * dim + dim * (dim + 1)) * UNIT * float(np.linalg.norm(gram, 2)) if step == 0 else 0.0
        factors.append(_factor(gram, shift))
        r = factors[-1] @ r
    if not factors:
        r = np.zeros((dim, dim))
    _, singular, right = np.linalg.svd(r)
    e = singular**2 / n
    k = min(components, int((e > RANK_SHARE * e[0]).sum()))
    right = right[:k]
    right *= np.where(right[np.arange(k), np.abs(right).argmax(axis=1)] < 0, -1.0, 1.0)[:, None] if k else 1.0
    found = Whitening(dim, n, sums, mean, r, right, e[:k], e[:k] / e.sum() if k else e[:0], 0.0)
    if k:
        found.identity_error = float(np.abs(_gram(fit, dim, k, found.whiten) / n - np.eye(k)).max())
    return found


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2; null beyond 64 bits."""
    most = max(abs(int(x.min())), abs(int(x.max()))) * n + max(map(abs, sums))
    if most * most * x.shape[1] < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _shown(fitted: Whitening):
    k = len(fitted.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = unpacked(part.column(1), fitted.dim)
                rows = pa.array(np.repeat(np.arange(len(x)), k))
                columns = {
                    "vec_id": part.column(0).take(rows),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    "n": pa.array(np.full(len(x) * k, fitted.n, np.int64)),
                    "deviation": pa.array(_deviations(x, fitted.n, fitted.sums), pa.int64()).take(rows),
                    "whitened": pa.array(fitted.whiten(x).ravel()),
                    "explained": pa.array(np.tile(fitted.explained, len(x))),
                    "identity_error": pa.array(np.full(len(x) * k, fitted.identity_error)),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row a usable vector and component: its place on the whitened axis, and what the fit says."""
    rows = integer_vectors(vectors, id_column, column)
    fitted = fit_whitening(rows, components)
    if fitted is None or not len(fitted.eigenvalues):
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    return rows.select("vec_id", "x").mapInArrow(_shown(fitted), SCHEMA)
