"""Embedding whitening by Chebyshev-filtered subspace iteration over distributed passes.

The covariance is never formed. A pass sends a small block of columns Q to all tasks, each multiplies
its own centred rows, X'(XQ), and the products are summed by dimension, in the tasks first. Between
passes the driver holds only blocks of ``dimensions x (components + GUARD)`` numbers. A polynomial of
the covariance, built by the Chebyshev recurrence from one pass a degree, damps the spectrum below
the block; QR and Rayleigh-Ritz follow, until the residuals certify the wanted pairs and a Lanczos
probe of what is left finds nothing larger.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import prepare_workers

COMPONENTS = 32
#: Columns iterated along beside the wanted ones; the gap behind them sets the speed.
GUARD = 24
#: Fixed values of the contract: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries are held within this, so that sums stay whole numbers.
LARGEST = 1 << 62
LANCZOS_STEPS = 10
MAX_DEGREE = 12
#: Residuals, against the largest eigenvalue: aimed at, and the most that is let pass.
AIM, CERTIFIED = 2e-14, 1e-10
#: Eigenvalues below this share of the largest count as zero and give no component.
RANK = 1e-10
MAX_CYCLES = 200
SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, "
          "explained double, identity_error double")


def lattice(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``valid`` rows (no null, all finite), and the whole numbers of those, flat, with their lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    valid = column.is_valid().to_numpy(zero_copy_only=False) & (
        broken[offsets[1:]] == broken[offsets[:-1]])
    lengths = np.diff(offsets)
    kept = values[offsets[0]:offsets[-1]][np.repeat(valid, lengths)]
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(SCALE * kept), -LARGEST, LARGEST)
    return valid, scaled.astype(np.int64) + SHIFT, lengths[valid].astype(np.int64)


def whole_rows(flat: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` whole numbers; entries a shorter vector lacks count as c = 0."""
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    rows = np.full((len(lengths), width), SHIFT, np.int64)
    rows[np.arange(width) < lengths[:, None]] = flat
    return rows


def _by_dimension(batches_to_rows, rows: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """Rows ``(i, columns...)`` of the tasks, summed by ``i``: every task sends a row a dimension."""
    schema = "i int, " + ", ".join(f"{c} {kind}" for c in columns)
    return rows.mapInArrow(batches_to_rows, schema).groupBy("i").agg(
        *[F.sum(c).alias(c) for c in columns])


@dataclass(frozen=True)
class Lattice:
    """Rows, dimensions and exact sums: S[i] = n * floor[i] + rest[i]."""

    n: int
    sums: tuple[int, ...]

    @property
    def floor(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part is taken off in whole numbers, so nothing cancels."""
        return (rows - self.floor).astype(np.float64) - self.rest / self.n

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sum of (n*x - S)^2, exact; None where that is no 64-bit number."""
        apart = rows - self.floor
        reach = (float(np.abs(apart).max(initial=0)) + 1) * self.n
        if reach * reach * max(len(self.sums), 1) < 2.0 ** 62:
            return np.square(self.n * apart - self.rest).sum(axis=1).tolist()
        exact = [sum((self.n * int(x) - int(r)) ** 2 for x, r in zip(row, self.rest))
                 for row in apart]
        return [e if e < 1 << 63 else None for e in exact]


def measure(vectors: DataFrame) -> Lattice:
    """Count and per-dimension sums of the whole numbers, exact."""
    def sums(batches):
        high, low, there, n = (np.zeros(0, np.int64) for _ in range(4))
        n = 0
        for batch in batches:
            _, flat, lengths = lattice(batch.column(0))
            n += len(lengths)
            width = int(lengths.max(initial=0))
            if width > len(high):
                high, low, there = (np.pad(a, (0, width - len(a))) for a in (high, low, there))
            at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            np.add.at(high, at, flat >> 32)
            np.add.at(low, at, flat & 0xFFFFFFFF)
            there += np.bincount(at, minlength=len(there)).astype(np.int64)
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(-1, len(high)), pa.int32()), pa.array([0, *high], pa.int64()),
                pa.array([0, *low], pa.int64()), pa.array([n, *there], pa.int64())],
                names=["i", "high", "low", "there"])

    found = {row.i: row for row in _by_dimension(
        sums, vectors, ["high", "low", "there"], "long").collect()}
    if not found:
        return Lattice(0, ())
    n = found[-1].there
    return Lattice(n, tuple(
        (found[i].high << 32) + found[i].low + SHIFT * (n - found[i].there)
        for i in range(len(found) - 1)))


class Covariance:
    """V = X'X / n of centred rows, known by its products with blocks of columns."""

    def __init__(self, vectors: DataFrame, base: Lattice):
        self.vectors, self.base, self.passes = vectors, base, 0

    def __matmul__(self, block: np.ndarray) -> np.ndarray:
        return self.summed(lambda c, q: c.T @ (c @ q), block, block.shape[1]) / self.base.n

    def summed(self, product, block: np.ndarray, width: int) -> np.ndarray:
        """Sum over all rows of ``product(centred rows, block)``, an array of ``width`` columns."""
        base, sent = self.base, self.vectors.sparkSession.sparkContext.broadcast(block)
        names = [f"q{j}" for j in range(width)]

        def multiply(batches):
            total = None
            for batch in batches:
                _, flat, lengths = lattice(batch.column(0))
                if len(lengths):
                    part = product(base.centred(whole_rows(flat, lengths, len(base.sums))),
                                   sent.value)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(total)), pa.int32()),
                     *[pa.array(total[:, j]) for j in range(width)]], names=["i", *names])

        rows = sorted(_by_dimension(multiply, self.vectors, names, "double").collect())
        self.passes += 1
        sent.destroy()
        return np.array([row[1:] for row in rows], np.float64).reshape(len(rows), width)

    def trace(self) -> float:
        squares = self.summed(lambda c, _: np.square(c).sum(axis=0)[:, None], np.zeros(0), 1)
        return float(squares.sum()) / self.base.n


def lanczos(v: Covariance, start: np.ndarray, apart_from: np.ndarray,
            steps: int = LANCZOS_STEPS) -> tuple[np.ndarray, float, np.ndarray]:
    """Ritz values and vectors of V without the columns ``apart_from``, and the last residual."""
    def project(x):
        for _ in range(2):
            x = x - apart_from @ (apart_from.T @ x)
        return x

    basis, alphas, betas = [], [], []
    x = project(start)
    for _ in range(min(steps, len(start) - apart_from.shape[1])):
        norm = np.linalg.norm(x)
        if basis:
            betas.append(norm)
        if norm <= 1e-13 * (max(map(abs, alphas)) if alphas else 1e-280):
            break
        basis.append(x / norm)
        x = project((v @ basis[-1][:, None])[:, 0])
        alphas.append(float(basis[-1] @ x))
        done = np.array(basis).T
        for _ in range(2):
            x = x - done @ (done.T @ x)
    k = len(basis)
    small = np.diag(alphas) + np.diag(betas[:k - 1], 1) + np.diag(betas[:k - 1], -1)
    values, turns = np.linalg.eigh(small)
    return values, float(np.linalg.norm(x)), np.array(basis).T @ turns


def chebyshev(v: Covariance, block: np.ndarray, product: np.ndarray, degree: int, low: float,
              high: float, top: float) -> np.ndarray:
    """The block under the Chebyshev polynomial that is small on [low, high] and 1 at ``top``.

    ``product`` is V @ block, known from the Rayleigh-Ritz step before.
    """
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    before, now = block, (product - middle * block) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, ((v @ now) - middle * now) * (2 * following / half) - (
            sigma * following * before)
        sigma = following
    return now


def _degree(low: float, high: float, top: float) -> int:
    """The largest degree that keeps the block's columns apart from its leading one."""
    half, middle = (high - low) / 2, (high + low) / 2
    return int(np.clip(17 / np.arccosh(max((top - middle) / half, 1 + 1e-9)), 1, MAX_DEGREE))


def eigenpairs(v: Covariance, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` eigenvalues of V, falling, and their unit vectors as columns."""
    d = len(v.base.sums)
    random = np.random.default_rng(seed)
    block = np.linalg.qr(random.standard_normal((d, min(d, wanted + GUARD))))[0]
    nothing = np.zeros((d, 0))
    low, best, stale = None, np.inf, 0
    for _ in range(MAX_CYCLES):
        product = v @ block
        values, turns = np.linalg.eigh((block.T @ product + product.T @ block) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        block, product = block @ turns, product @ turns
        top, complete = max(values[0], 0.0), block.shape[1] == d
        residuals = np.linalg.norm(product - block * values, axis=0)[:wanted]
        worst = float(residuals.max(initial=0.0))
        best, stale = (worst, 0) if worst < 0.5 * best else (best, stale + 1)
        if complete or worst <= AIM * top or (worst <= CERTIFIED * top and stale >= 3):
            held = block[:, :wanted]
            if complete or top == 0:
                return values[:wanted], held
            # Is there a larger value outside? Then it joins the block, and on we go.
            found, _, vectors = lanczos(v, random.standard_normal(d), held)
            if not len(found) or found[-1] <= values[wanted - 1] + 1e-9 * top:
                return values[:wanted], held
            block = np.linalg.qr(np.column_stack([block[:, :-1], vectors[:, -1]]))[0]
            best, stale = np.inf, 0
            continue
        if low is None:
            smallest, rest, _ = lanczos(v, random.standard_normal(d), nothing)
            low = max(0.0, float(smallest[0]) - rest)
        high = float(values[-1])
        if high - low <= 1e-9 * top:  # nothing to damp: one plain step
            block = np.linalg.qr(product)[0]
        else:
            filtered = chebyshev(v, block, product, _degree(low, high, top), low, high, top)
            block = np.linalg.qr(filtered)[0]
    raise ArithmeticError(f"residual {best} of the eigenvectors is not certified")


def whiten(embeddings: DataFrame, vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: ``vec_id, component, n, deviation, whitened,
    explained, identity_error``.

    Rows whose vector is null or holds null or non-finite entries are dropped; repeated rows and
    null ids count each. Entries become x = floor(64 * c) + 1000000, held within 2^62. A vector
    shorter than the longest counts as filled up with c = 0, an empty one too. There are as many
    components as asked for, but no more than dimensions, and none whose variance is below 1e-10 of the
    largest: one row, or rows all alike, have none and give no rows, as does an empty table.
    ``deviation`` is null where it is no 64-bit number. Other columns are not read.
    """
    prepare_workers(embeddings.sparkSession)
    rows = embeddings.select(F.col(vector).cast("array<double>").alias("v"),
                             F.col("vec_id").cast("long").alias("id"))
    vectors = rows.select("v")
    base = measure(vectors)
    none = embeddings.sparkSession.createDataFrame([], SCHEMA)
    if not base.sums:
        return none
    v = Covariance(vectors, base)
    trace = v.trace()
    if trace == 0:
        return none
    values, directions = eigenpairs(v, min(components, len(base.sums)))
    real = int((values > RANK * values[0]).sum())
    values, scaled = values[:real], directions[:, :real] / np.sqrt(values[:real])

    def moments(c, q):
        w = c @ q
        return np.column_stack([w.T @ w, w.sum(axis=0)])

    sums = v.summed(moments, scaled, real + 1) / base.n
    covariance = sums[:, :real] - np.outer(sums[:, real], sums[:, real])
    error = float(np.abs(covariance - np.eye(real)).max())
    explained = values / trace
    sent = embeddings.sparkSession.sparkContext.broadcast(scaled)

    def project(batches):
        for batch in batches:
            valid, flat, lengths = lattice(batch.column(0))
            m = len(lengths)
            if not m:
                continue
            whole = whole_rows(flat, lengths, len(base.sums))
            ids = batch.column(1).filter(pa.array(valid)).take(
                pa.array(np.repeat(np.arange(m), real)))
            deviation = pa.array(base.deviations(whole), pa.int64())
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, real + 1), m), pa.int32()),
                pa.array(np.full(m * real, base.n), pa.int64()),
                deviation.take(pa.array(np.repeat(np.arange(m), real))),
                pa.array((base.centred(whole) @ sent.value).ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * real, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                       "identity_error"])

    return rows.mapInArrow(project, SCHEMA)
