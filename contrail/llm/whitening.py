"""Operator 11, whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers x, so counts and sums are exact.  The centred rows
Y = x - S/n are never stored: a pass over the table gives the Gram matrix of
Y taken through the triangular factors found so far (each task adds up its own,
tasks are added up in two steps, one d x d matrix reaches the driver), whose Cholesky
factor R makes the rows of the next pass closer to orthogonal.  The first Gram
matrix is shifted, so that its factor exists however badly conditioned the
rows are.  Passes end when the rows are orthonormal to rounding (or, where the
covariance is singular, when their Gram matrix is a projector).  The composed R
has the singular values and right vectors of Y: R = U D W', the components are
the columns of W and the eigenvalues D^2 / n.

Memory of a task: one batch of rows and a few d x d matrices; nothing else grows
with the table.  The driver holds one d x d matrix per pass.

Defined cases: rows whose vector is null, or holds a null, an entry that is not
finite or one of 2**52 or more (no whole number of 64 bits), are dropped; a
vector shorter than the longest counts as ending in zeros; rows are used as
often as they occur; a null id stays null; components without variance have
whitened null, explained 0 and no part in ``identity_error`` (null if no component
has variance); an empty table gives no rows; other columns are ignored.
``deviation`` is a decimal(38, 0), exact, null beyond 38 digits.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entry c becomes floor(SCALE * c) + OFFSET (fixed values of the contract).
SCALE, OFFSET = 1024, 100_000
#: More partial sums than this are added up in two steps.
FAN_IN = 32
#: A pass over n rows errs like one over this many: sums are blocked by batch and task.
BLOCK_ROWS = 1 << 16
MOST_PASSES = 12
_LOW = np.int64((1 << 31) - 1)


def vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that remain, and their entries as whole numbers (one array per row
    length: rows of the same length stand together in ``at``)."""
    column = batch.column("embedding")
    lengths = np.diff(np.asarray(column.offsets, np.int64))
    offsets = np.asarray(column.offsets, np.int64)
    values = column.values.cast(pa.float64())
    holes = np.asarray(values.is_null(), bool) if values.null_count else np.zeros(len(values), bool)
    flat = np.asarray(values.fill_null(0.0)) if values.null_count else np.asarray(values)
    with np.errstate(invalid="ignore"):
        bad = holes | ~(np.abs(flat) < 2.0 ** 52)
    before = np.concatenate([[0], np.cumsum(bad)])
    good = (before[offsets[1:]] == before[offsets[:-1]]) & np.asarray(column.is_valid(), bool)
    at, out = [], []
    for size in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == size))
        x = flat[offsets[rows][:, None] + np.arange(size)]
        at.append(rows)
        out.append(np.floor(x * SCALE).astype(np.int64) + OFFSET)
    return (np.concatenate(at) if at else np.zeros(0, np.int64)), out


def _padded(x: np.ndarray, width: int) -> np.ndarray:
    if x.shape[1] == width:
        return x
    return np.pad(x, ((0, 0), (0, width - x.shape[1])), constant_values=OFFSET)


@dataclass(frozen=True)
class Sums:
    """Count, exact per-dimension sums and the largest entry of the fit list."""
    n: int
    sums: tuple[int, ...]
    largest: int

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def small(self) -> bool:
        """Whether n * x - S and the sum of its squares fit 64 bits."""
        top = 2 * self.n * self.largest
        return top * top * max(1, self.width) < 1 << 62

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact (64-bit numbers, or Python's beyond them)."""
        if self.small:
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        if self.small:
            return self.scaled(x) / float(self.n)
        if self.n * self.largest < 1 << 62:
            return (x * np.int64(self.n) - np.array(self.sums, np.int64)) / float(self.n)
        return (self.scaled(x) / self.n).astype(np.float64)


def _whole_sums(x: np.ndarray) -> list[int]:
    high, low = (x >> 31).sum(axis=0), (x & _LOW).sum(axis=0)
    return [int(h) * (1 << 31) + int(v) for h, v in zip(high, low)]


def fit_sums(rows: DataFrame) -> Sums:
    """n, S and the largest |x| over all remaining rows."""
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, counts, largest = 0, [], [], 0
        for b in it:
            for x in vectors(b)[1]:
                n += len(x)
                if x.shape[1] > len(sums):
                    sums += [0] * (x.shape[1] - len(sums))
                    counts += [0] * (x.shape[1] - len(counts))
                for j, s in enumerate(_whole_sums(x)):
                    sums[j] += s
                    counts[j] += len(x)
                largest = max(largest, int(np.abs(x).max(initial=0)))
        yield _one_row(n, json.dumps([largest, sums, counts]).encode())

    def add(a: bytes, b: bytes) -> bytes:
        (la, sa, ca), (lb, sb, cb) = json.loads(a), json.loads(b)
        width = max(len(sa), len(sb))
        plus = lambda p, q: [(p[j] if j < len(p) else 0) + (q[j] if j < len(q) else 0) for j in range(width)]
        return json.dumps([max(la, lb), plus(sa, sb), plus(ca, cb)]).encode()

    n, data = _added(rows.mapInArrow(task, _PARTIAL), add)
    largest, sums, counts = json.loads(data) if data else (0, [], [])
    return Sums(n, tuple(s + (n - c) * OFFSET for s, c in zip(sums, counts)), max(largest, OFFSET))


_PARTIAL = "part int, n long, data binary"


def _one_row(n: int, data: bytes) -> pa.RecordBatch:
    part = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([data], pa.binary())], ["part", "n", "data"])


def _added(partials: DataFrame, add: Callable[[bytes, bytes], bytes]) -> tuple[int, bytes]:
    """The sum of the partial rows: a task holds one row and its running sum."""
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, b""
        for b in it:
            for k, data in zip(b.column("n").to_pylist(), b.column("data")):
                if k:
                    n, total = n + k, add(total, data.as_py()) if total else data.as_py()
        yield _one_row(n, total)

    tasks = partials.rdd.getNumPartitions()
    if tasks > FAN_IN:
        partials = partials.repartition(math.isqrt(tasks), "part").mapInArrow(task, _PARTIAL)
    row = partials.repartition(1).mapInArrow(task, _PARTIAL).first()
    return (row["n"], bytes(row["data"])) if row else (0, b"")


def solved(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """y inv(R) for an upper triangular R, column after column."""
    q = np.array(y, np.float64, order="F")
    for j in range(r.shape[0]):
        if j:
            q[:, j] -= q[:, :j] @ r[:j, j]
        q[:, j] /= r[j, j]
    return q


def gram(rows: DataFrame, fitted: Sums, factors: list[np.ndarray], weights: np.ndarray | None = None) -> np.ndarray:
    """Q'Q of the centred rows taken through ``factors`` (or times ``weights``)."""
    size = fitted.width if weights is None else weights.shape[1]

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, g = 0, np.zeros((size, size))
        for b in it:
            for x in vectors(b)[1]:
                y = fitted.centred(_padded(x, fitted.width))
                for r in factors:
                    y = solved(y, r)
                y = y if weights is None else y @ weights
                n += len(y)
                g += y.T @ y
        yield _one_row(n, g.tobytes())

    _, data = _added(rows.mapInArrow(task, _PARTIAL), lambda a, b: (np.frombuffer(a) + np.frombuffer(b)).tobytes())
    return np.frombuffer(data).reshape(size, size) if data else np.zeros((size, size))


def _factor(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of g + shift I; the shift grows where it does not
    suffice."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, np.finfo(float).eps * max(1.0, float(np.trace(g))))


@dataclass(frozen=True)
class Whitening:
    sums: Sums
    components: np.ndarray  # d x k unit columns
    eigenvalues: np.ndarray  # of the k components, falling
    trace: float
    passes: int

    @property
    def alive(self) -> np.ndarray:
        """Components with variance."""
        top = self.eigenvalues[0] if len(self.eigenvalues) else 0.0
        return self.eigenvalues > max(top, 0.0) * 1e-20 * max(1, self.sums.width)

    @property
    def weights(self) -> np.ndarray:
        scale = np.where(self.alive, np.sqrt(np.where(self.alive, self.eigenvalues, 1.0)), np.inf)
        return self.components / scale


def fit(rows: DataFrame, most: int = 8) -> Whitening:
    """Components of the covariance of all rows, by shifted CholeskyQR."""
    fitted = fit_sums(rows)
    d, n = fitted.width, fitted.n
    if not n or not d:
        return Whitening(fitted, np.zeros((d, 0)), np.zeros(0), 0.0, 0)
    eps = np.finfo(float).eps
    factors: list[np.ndarray] = []
    composed = np.eye(d)
    for _ in range(MOST_PASSES):
        g = gram(rows, fitted, factors)
        if not factors:
            trace = float(np.trace(g)) / n
        if not g.any():  # all rows equal
            break
        done = np.abs(g - np.eye(d)).max() < 64 * d * eps
        singular = factors and not done and np.abs(g @ g - g).max() < 64 * d * eps
        if done or singular:
            break
        size = float(np.linalg.norm(g, 2))
        first = 11 * (min(n, BLOCK_ROWS) * d + d * (d + 1)) * eps / 2 * size
        r = _factor(g, first if not factors or np.linalg.eigvalsh(g)[0] < 1e-8 * size else 0.0)
        factors.append(r)
        composed = r @ composed
    _, values, right = np.linalg.svd(g @ composed if factors else g)
    k = min(most, d)
    return Whitening(fitted, right[:k].T.copy(), (values[:k] ** 2) / n, trace, len(factors) + 1)


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    alive = np.flatnonzero(model.alive)
    if not len(alive):
        return None
    cov = gram(rows, model.sums, [], model.weights[:, alive]) / model.sums.n
    return float(np.abs(cov - np.eye(len(alive))).max())


def whiten(vecs: DataFrame, most: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each remaining vector and component: vec_id, component, n,
    deviation, whitened, explained, identity_error."""
    rows = vecs.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    model = fit(rows, most)
    error = identity_error(rows, model)
    fitted, k = model.sums, len(model.eigenvalues)
    alive, weights = model.alive, model.weights
    explained = [float(e / model.trace) if a else 0.0 for e, a in zip(model.eigenvalues, alive)]
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            at, groups = vectors(b)
            if not len(at) or not k:
                continue
            far, white = [], []
            for x in groups:
                x = _padded(x, fitted.width)
                far.append((fitted.scaled(x) ** 2).sum(axis=1))
                white.append(fitted.centred(x) @ weights)
            m = len(at)
            if fitted.small:
                deviation = pa.array(np.concatenate(far)).cast(pa.decimal128(38, 0))
            else:
                deviation = pa.array([_decimal(int(v)) for part in far for v in part], pa.decimal128(38, 0))
            z = np.concatenate(white)
            again = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(pa.array(at[again])),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, fitted.n, np.int64)),
                deviation.take(pa.array(again)),
                pa.array(z.ravel(), mask=np.tile(~alive, m)),
                pa.array(np.tile(np.array(explained), m)),
                pa.array([error] * (m * k), pa.float64()),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(task, schema)


def _decimal(v: int):
    from decimal import Decimal

    return Decimal(v) if v < 10 ** 38 else None

