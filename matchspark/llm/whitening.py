"""Embedding whitening by contour integration (operator 13).

Entries become whole numbers ``floor(256 * c)``; rows that are null, or hold null or
non-finite entries, are dropped.  The fit list is every distinct vector once.

1. The fit list is a distinct over whole vectors (combined before the shuffle, so a
   vector that a third of all rows holds is one row per task).
2. Exact sums, then the covariance of the centred vectors: every task adds up one
   d x d matrix, whose rows are added on executors.  Only d sums and d x d numbers
   reach the driver, whatever the number of rows.
3. FEAST on that matrix.  Inertia counts (signs of the pivots of an LDL'
   factorisation of ``V - shift``) place an interval around the wanted eigenvalues
   with its lower end inside a gap.  A quadrature over a circle around it, one
   complex shifted solve for each node, projects a block of vectors onto the interval's
   eigenspace; Rayleigh-Ritz takes the components; both repeat until the
   residuals are at rounding level.  Inertia counts below and above every
   eigenvalue then prove that none is missed.
4. Rows are centred, projected and scaled where they are read.

Defined results: vectors of another length than the most frequent one (of equally
frequent ones the longest) are dropped, and so are empty vectors; numbers beyond a
``long`` become its nearest value; a ``deviation`` beyond a ``long`` is null; components
whose eigenvalue is rounding noise (at most ``d * 2^-52`` of the largest) are not
given, so equal rows alone, one row or an empty table give an empty result; a null or
repeated ``vec_id`` is kept as it is; other columns are not read.  Equal
eigenvalues leave the directions inside their space open, as in any solver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchspark.llm.common import written

COMPONENTS = 4
SCALE = 256
#: Quadrature nodes on the upper half circle, rounds of one try, tries with larger blocks.
NODES, ROUNDS, TRIES = 8, 30, 6
EPS = float(np.finfo(float).eps)


# --- the eigenvalue solver (one d x d matrix) ------------------------------------

def inertia(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: positive pivots of the LDL' factorisation of
    ``matrix - shift`` (Sylvester), with 1 x 1 and 2 x 2 pivots as Bunch and Kaufman choose them."""
    a = matrix - shift * np.eye(len(matrix))
    bound, above, k, n = (1 + 17 ** 0.5) / 8, 0, 0, len(matrix)
    while k < n:
        column = np.abs(a[k + 1:, k])
        big = float(column.max()) if len(column) else 0.0
        width = 1
        if big > 0 and abs(a[k, k]) < bound * big:
            r = k + 1 + int(column.argmax())
            others = np.abs(a[k:, r])
            others[r - k] = 0
            most = float(others.max())
            if abs(a[k, k]) * most >= bound * big * big:
                pass
            elif abs(a[r, r]) >= bound * most:
                a[[k, r]] = a[[r, k]]
                a[:, [k, r]] = a[:, [r, k]]
            else:
                width = 2
                a[[k + 1, r]] = a[[r, k + 1]]
                a[:, [k + 1, r]] = a[:, [r, k + 1]]
        pivot, rest = a[k:k + width, k:k + width], a[k + width:, k:k + width]
        if width == 2:
            above += 1  # such a pivot has one eigenvalue of each sign
            a[k + 2:, k + 2:] -= rest @ np.linalg.solve(pivot, rest.T)
        else:
            above += bool(pivot[0, 0] > 0)
            if pivot[0, 0] != 0:
                a[k + 1:, k + 1:] -= np.outer(rest[:, 0], rest[:, 0]) / pivot[0, 0]
        k += width
    return above


def _place(matrix: np.ndarray, j: int, low: float, high: float) -> float:
    """The j-th largest eigenvalue to about 7 digits, by bisection on inertia counts."""
    while high > low * (1 + 1e-7):
        middle = (low * high) ** 0.5
        if inertia(matrix, middle) >= j:
            low = middle
        else:
            high = middle
    return (low * high) ** 0.5


def project(matrix: np.ndarray, block: np.ndarray, low: float, high: float, nodes: int) -> np.ndarray:
    """Quadrature of the resolvent along the circle over [low, high], applied to a block: all but
    the directions of eigenvalues inside are damped.  The lower half circle is the conjugate of the upper."""
    centre, radius, eye = (low + high) / 2, (high - low) / 2, np.eye(len(matrix))
    out = np.zeros_like(block)
    for x, weight in zip(*np.polynomial.legendre.leggauss(nodes)):
        turn = np.exp(1j * np.pi * (x + 1) / 2)
        out += (weight / 2 * radius * turn * np.linalg.solve((centre + radius * turn) * eye - matrix, block)).real
    return out


def feast(matrix: np.ndarray, low: float, high: float, count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in (low, high), falling, and their unit vectors."""
    d, scale = len(matrix), float(np.abs(matrix).sum(axis=1).max())
    for attempt in range(TRIES):
        size, nodes = min(d, (count + 4) * 2 ** attempt), NODES + 4 * attempt
        block = np.random.default_rng(seed + attempt).standard_normal((d, size))
        best, kept, idle = np.inf, None, 0
        for _ in range(ROUNDS):
            basis, _ = np.linalg.qr(project(matrix, block, low, high, nodes))
            values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
            block = basis @ turn
            inside = np.flatnonzero((values > low) & (values < high))[::-1]
            if len(inside) != count:
                continue
            values, vectors = values[inside], block[:, inside]
            residual = float(np.abs(matrix @ vectors - vectors * values).max()) / scale
            idle = 0 if residual < best / 2 else idle + 1
            if residual < best:
                best, kept = residual, (values, vectors / np.linalg.norm(vectors, axis=0))
            if best <= 64 * EPS and idle >= 2:
                break
        if kept is not None and best <= 1e3 * EPS and _complete(matrix, kept[0], scale):
            return kept
    raise ArithmeticError(f"FEAST found no complete set of {count} components in ({low}, {high})")


def _complete(matrix: np.ndarray, values: np.ndarray, scale: float) -> bool:
    """Whether inertia counts agree with every value: j or more above its lower side, fewer above its upper."""
    margin = 1e4 * EPS * scale
    return all(inertia(matrix, v - margin) >= j > inertia(matrix, v + margin) - np.count_nonzero(np.abs(values - v) <= 2 * margin)
               for j, v in enumerate(values, 1))


def top_components(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above rounding noise (at most ``wanted``), falling, and their unit
    vectors as columns, each with its largest entry positive."""
    d = len(matrix)
    high = float(np.abs(matrix).sum(axis=1).max()) if d else 0.0
    none = np.empty(0), np.empty((d, 0))
    if high == 0:
        return none
    high *= 1 + 1e-6
    noise = d * EPS * high
    usable = inertia(matrix, noise)
    wanted = min(wanted, usable)
    if not wanted:
        return none
    first = _place(matrix, 1, noise, high)
    # the lower end lies in the first gap below the last wanted eigenvalue
    count, here = wanted, _place(matrix, wanted, noise, high)
    while count < usable and here - (below := _place(matrix, count + 1, noise, high)) <= 1e-4 * here:
        count, here = count + 1, below
    low = (here + below) / 2 if count < usable else (here + noise) / 2
    values, vectors = feast(matrix, low, first * (1 + 1e-3) + (first - low) * 1e-2, count)
    values, vectors = values[:wanted], vectors[:, :wanted]
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])


# --- the job ---------------------------------------------------------------------

def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x`` (array of long) of the rows without null or non-finite entries, all of one length."""
    raw = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("c"))
    finite = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    valid = raw.filter(F.col("c").isNotNull() & (F.size("c") > 0) & finite)
    common = valid.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    top = float(1 << 63)
    scaled = lambda c: F.when(c * SCALE >= top, F.lit((1 << 63) - 1)).when(
        c * SCALE <= -top, F.lit(-(1 << 63))).otherwise(F.floor(c * SCALE).cast("long"))
    return (valid.filter(F.size("c") == F.lit(common.d if common else 0))
            .select("vec_id", F.transform("c", scaled).alias("x")))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), d)


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and the sum of every dimension, exact: low and high halves are added apart."""
    def run(batches):
        n, low, high = 0, [0] * d, [0] * d
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            low = [a + int(b) for a, b in zip(low, (x & 0xFFFFFFFF).sum(axis=0))]
            high = [a + int(b) for a, b in zip(high, (x >> 32).sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                              pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["j", "n", "low", "high"])
    whole = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    rows = (fit.select("x").mapInArrow(run, "j int, n long, low long, high long")
            .groupBy("j").agg(F.sum("n").alias("n"), whole("low"), whole("high")).collect())
    sums = [0] * d
    for r in rows:
        sums[r.j] = int(r.low) + (int(r.high) << 32)
    return (rows[0].n if rows else 0), sums


def products(fit: DataFrame, d: int, size: int, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of the outer products of ``make(x)`` (``size`` numbers for each row): one matrix per task, added by rows."""
    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            part = make(_matrix(batch.column(0), d))
            total += part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
                                         names=["i", "part"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in batch.column("part").to_pylist():
                total += np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()])], names=["i", "part"])
    out = np.zeros((size, size))
    for r in fit.select("x").mapInArrow(run, "i int, part binary").groupBy("i").applyInArrow(add, "i int, part binary").collect():
        out[r.i] = np.frombuffer(r.part)
    return out


class Whitening:
    """What the driver keeps of the fit list: n, sums, eigenvalues, vectors and the trace."""

    def __init__(self, fit: DataFrame, d: int, wanted: int = COMPONENTS):
        self.d, (self.n, self.sums) = d, exact_sums(fit, d)
        self.mean = np.array([s / max(1, self.n) for s in self.sums])
        covariance = products(fit, d, d, lambda x, m=self.mean: x - m) / max(1, self.n)
        covariance = (covariance + covariance.T) / 2
        self.trace = float(np.trace(covariance))
        self.values, self.vectors = top_components(covariance, wanted)
        self.turn = self.vectors / np.sqrt(self.values)
        made = products(fit, d, len(self.values), self.whiten) / max(1, self.n)
        self.identity_error = float(np.abs(made - np.eye(len(made))).max()) if len(made) else 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.turn

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of (n x - S)^2; Python integers where 64 bits might not hold it."""
        widest = self.n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, self.sums)) if len(x) else 0
        wide = widest * widest * self.d >= 1 << 63
        gap = x.astype(object) * self.n - np.array(self.sums, object) if wide else x * self.n - np.array(self.sums, np.int64)
        return [int(v) if v < 1 << 63 else None for v in (gap * gap).sum(axis=1)]


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every remaining row."""
    vectors = integer_vectors(rows, id_col, vector_col)
    fit = written(vectors.select("x").distinct())
    one = fit.select(F.size("x").alias("d")).first()
    model = Whitening(fit, one.d, components) if one else None
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            k = len(model.values)
            if not k or not batch.num_rows:
                continue
            x = _matrix(batch.column(1), model.d)
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(each), model.n)), pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                 pa.array(model.whiten(x).ravel()), pa.array(np.tile(model.values / model.trace, len(x))),
                 pa.array(np.full(len(each), model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    schema = f"vec_id {id_type}, {OUT}"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    return vectors.mapInArrow(run, schema)
