"""Operator 11: embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become integers x = floor(64 * c) + ``SHIFT``.  The leading eigenvectors of their covariance are found without
ever forming it: a pass multiplies a block Q of ``WANTED`` + ``GUARD`` columns by the centred XᵀX, each task over its
blocks of rows.  A polynomial recurrence of up to ``DEGREE`` passes damps the unwanted part of the spectrum, between a lower
bound (a few Lanczos passes) and the block's smallest Ritz value; then QR and a Rayleigh-Ritz step turn the block to
its best eigenvectors.  This repeats until the wanted pairs are certified: every residual |VQ - Qe| is at most
``CERTIFIED`` of the largest eigenvalue and no longer falls, and a fresh random block outside the found space, filtered
in the same way, holds no larger eigenvalue than the wanted ones.  Without a certificate after ``MOST`` rounds the
operator raises an error instead of returning rows.  Where one direction dominates, rounds are shorter (``SPREAD``).

Rows are read as long blocks of integers from the shared checkpoint folder; what a pass gathers is one matrix (dimensions x columns) per task, added up by tasks
until at most ``FAN_IN`` are left for the driver, whatever the number of rows.  Sums of x are exact integers, so means
and deviations are too; subtracting the mean comes before any product.

Dropped rows: null vectors and those with null, NaN or infinite entries; empty vectors; and vectors of another length
than the commonest (of equally common lengths the greatest).  x beyond 2^48 either way is set to that bound.  Repeated rows and null
ids count and are returned each for itself.  A component needs a variance over ``RANK`` of the largest: n equal
vectors have none and give no rows, as an empty table does.  A deviation beyond 64 bits is null.  Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relearn.llm.common import cut

SCALE, SHIFT, BOUND = 64.0, 1_000_000, 1 << 48
WANTED, GUARD = 32, 16
DEGREE, LANCZOS, MOST = 12, 10, 60
#: Most that the filter may raise the largest eigenvalue over the last wanted one; beyond it QR would lose the latter.
SPREAD = 1e18
CERTIFIED, RANK = 1e-12, 1e-11
FAN_IN = 16
#: Bytes of x in a block, and of blocks in a partition, about.
BLOCK, PART = 4 << 20, 64 << 20


@dataclass
class Spectrum:
    """Leading eigenpairs of the covariance: values (falling) and vectors (columns), with what certified them."""
    values: np.ndarray
    vectors: np.ndarray
    residual: float       # largest |Vq - eq| over the largest eigenvalue
    outside: float        # largest Ritz value found outside the space
    passes: int


def _finite(vector: Column) -> Column:
    return F.size(vector).__gt__(0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def _blocks(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``(ids, x)``: the usable vectors as matrices of int64 in rows, and their length (0: no vectors)."""
    vector = F.col("embedding").cast("array<double>")
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("v")).where(F.col("v").isNotNull() & _finite(F.col("v")))
    common = usable.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return usable, 0
    dim = common["size"]
    rows = max(1, BLOCK // (8 * dim))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            c = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            x = np.clip(np.floor(SCALE * c) + SHIFT, -BOUND, BOUND).astype(np.int64)
            for a in range(0, len(x), rows):
                part = x[a:a + rows]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("vec_id").slice(a, len(part)).to_pylist()], pa.list_(pa.int64())),
                                                  pa.array([part.tobytes()], pa.binary())], names=["ids", "x"])
    blocks = cut(usable.where(F.size("v") == dim).mapInArrow(run, "ids array<long>, x binary"))
    size = blocks.agg(F.sum(F.octet_length("x"))).first()[0]
    parts = max(blocks.sparkSession.sparkContext.defaultParallelism, -(-size // PART))
    return cut(blocks.repartition(parts)), dim


def _total(blocks: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``of(x)``: by tasks, then by fewer tasks, then on the driver."""
    schema = "at int, shape array<int>, kind string, data binary"

    def rows(at: int, total: np.ndarray | None):
        if total is not None:
            yield pa.RecordBatch.from_pylist([{"at": at, "shape": list(total.shape), "kind": total.dtype.str, "data": total.tobytes()}],
                                             pa.schema([("at", pa.int32()), ("shape", pa.list_(pa.int32())), ("kind", pa.string()), ("data", pa.binary())]))

    def first(batches: Iterator[pa.RecordBatch]):
        total = None
        for batch in batches:
            for raw in batch.column("x"):
                part = of(np.frombuffer(raw.as_buffer(), np.int64))
                total = part if total is None else total + part
        yield from rows(TaskContext.get().partitionId(), total)

    def read(r: dict) -> np.ndarray:
        return np.frombuffer(r["data"], r["kind"]).reshape(r["shape"])

    def merge(batches: Iterator[pa.RecordBatch]):
        parts = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: r["at"])
        yield from rows(TaskContext.get().partitionId(), sum(map(read, parts)) if parts else None)

    parts, sums = blocks.rdd.getNumPartitions(), blocks.select("x").mapInArrow(first, schema)
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        sums = sums.repartition(parts).mapInArrow(merge, schema)
    return sum(read(r) for r in sorted(sums.toArrow().to_pylist(), key=lambda r: r["at"]))


class Moments:
    """Exact count and sums of the blocks, and products with their centred covariance."""

    def __init__(self, blocks: DataFrame, dim: int):
        self.blocks, self.dim, self.passes = blocks, dim, 0

        def sums(x: np.ndarray) -> np.ndarray:
            x = x.reshape(-1, dim)       # in two halves, so that no sum overflows
            return np.vstack([(x >> 24).sum(0), (x & 0xFFFFFF).sum(0), np.full(dim, len(x)), np.abs(x - SHIFT).max(0)])
        high, low, count, _ = _total(blocks, sums)
        self.n = int(count[0])
        self.sums = [int(h) * (1 << 24) + int(lo) for h, lo in zip(high, low)]
        rest = [s - self.n * SHIFT for s in self.sums]
        # S / n - SHIFT, as a whole part and the rest: subtracted one after the other without loss
        self.whole = np.array([r // self.n for r in rest], np.int64)
        self.part = np.array([(r % self.n) / self.n for r in rest])
        self.trace = float(self.total(lambda y: (y * y).sum(0)).sum()) / self.n

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        dim, whole, part = self.dim, self.whole, self.part
        return lambda x: (x.reshape(-1, dim) - SHIFT - whole).astype(np.float64) - part

    def total(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``of(y)`` over the blocks' centred matrices y: one pass."""
        centred, self.passes = self.centred(), self.passes + 1
        return _total(self.blocks, lambda x: of(centred(x)))

    def product(self, q: np.ndarray) -> np.ndarray:
        """The covariance times ``q``; ``q`` goes out by a broadcast that lasts for this pass."""
        sent = self.blocks.sparkSession.sparkContext.broadcast(np.ascontiguousarray(q))
        try:
            return self.total(lambda y: y.T @ (y @ sent.value)) / self.n
        finally:
            sent.destroy()


def _lower_bound(m: Moments, rng: np.random.Generator) -> float:
    """A bound below the spectrum: the smallest Ritz value of a few Lanczos steps less the last remainder's norm."""
    v, before, diagonal, beside, norm = rng.standard_normal(m.dim), 0.0, [], [], 0.0
    v = v / np.linalg.norm(v)
    basis = [v]
    for _ in range(min(LANCZOS, m.dim)):
        w = m.product(basis[-1][:, None])[:, 0]
        diagonal.append(float(w @ basis[-1]))
        for b in basis:
            w = w - (w @ b) * b
        norm = float(np.linalg.norm(w))
        if norm <= 1e-10 * max(abs(d) for d in diagonal):
            break
        beside.append(norm)
        basis.append(w / norm)
    k = len(diagonal)
    t = np.diag(diagonal) + np.diag(beside[:k - 1], 1) + np.diag(beside[:k - 1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - norm)


def _filtered(m: Moments, q: np.ndarray, low: float, high: float, top: float, last: float) -> np.ndarray:
    """The Chebyshev polynomial that is small on [low, high] and 1 at ``top``, of the covariance, times ``q``.

    ``last`` is the smallest value wanted: it and ``top`` bound the degree."""
    half, mid = (high - low) / 2, (high + low) / 2
    gain = np.arccosh((top - mid) / half) - np.arccosh(max((last - mid) / half, 1.0))
    degree = int(np.clip(np.log(SPREAD) / max(gain, 1e-9), 2, DEGREE))
    first = sigma = half / (top - mid)
    old, new = q, (m.product(q) - mid * q) * (sigma / half)
    for _ in range(degree - 1):
        step = 1 / (2 / first - sigma)
        old, new, sigma = new, (m.product(new) - mid * new) * (2 * step / half) - (sigma * step) * old, step
    return new


def _ritz(m: Moments, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors and residual norms of the space of ``q``'s columns."""
    q, _ = np.linalg.qr(q)
    product = m.product(q)
    t = q.T @ product
    values, turn = np.linalg.eigh((t + t.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q = q @ turn
    return values, q, np.linalg.norm(product @ turn - q * values, axis=0)


def eigenpairs(m: Moments, wanted: int = WANTED, guard: int = GUARD, seed: int = 0) -> Spectrum:
    """The ``wanted`` leading eigenpairs, certified."""
    rng = np.random.default_rng(seed)
    wanted, width = min(wanted, m.dim), min(wanted + guard, m.dim)
    low = _lower_bound(m, rng) if width < m.dim else 0.0
    values, q, residuals = _ritz(m, rng.standard_normal((m.dim, width)))
    best = np.inf
    for _ in range(MOST):
        top = max(float(values[0]), np.finfo(float).tiny)
        residual = float(residuals[:wanted].max()) / top
        high = float(values[-1])
        # nothing is left to damp: the block is the whole space, or holds all of the covariance's range
        whole = width == m.dim or high <= RANK * top
        if residual <= CERTIFIED and (whole or residual > best / 2 or residual < 1e-15):
            if width == m.dim:
                return Spectrum(values[:wanted], q[:, :wanted], residual, 0.0, m.passes)
            fresh = rng.standard_normal((m.dim, min(8, m.dim - width)))
            fresh = fresh - q @ (q.T @ fresh)
            if not whole:
                fresh = _filtered(m, fresh, low, high, top, values[wanted - 1])
                fresh = fresh - q @ (q.T @ fresh)
            outside, found, _ = _ritz(m, fresh - q @ (q.T @ fresh))
            if outside[0] <= max(values[wanted - 1], RANK * top) * (1 + 1e-9):
                return Spectrum(values[:wanted], q[:, :wanted], residual, float(outside[0]), m.passes)
            q, best = np.hstack([q[:, :width - found.shape[1]], found]), np.inf
            values, q, residuals = _ritz(m, q)
            continue
        best = min(best, residual)
        low = min(low, high / 2)
        values, q, residuals = _ritz(m, q if whole else _filtered(m, q, low, high, top, values[wanted - 1]))
    raise RuntimeError(f"eigenpairs not certified after {m.passes} passes: residual {residual:.3g}")


def whiten(vectors: DataFrame, wanted: int = WANTED) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per usable row of ``vectors``
    (vec_id, embedding) and component, numbered from 1 by falling variance; signs make each component's largest entry positive."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    blocks, dim = _blocks(vectors)
    if not dim:
        return vectors.sparkSession.createDataFrame([], schema)
    m = Moments(blocks, dim)
    s = eigenpairs(m, wanted)
    kept = s.values > RANK * max(s.values[0], 0.0)
    if not kept.any():
        return vectors.sparkSession.createDataFrame([], schema)
    values, q = s.values[kept], s.vectors[:, kept]
    q = q * np.sign(q[np.abs(q).argmax(0), np.arange(q.shape[1])])
    to = q / np.sqrt(values)
    mean = m.total(lambda y: (y @ to).sum(0)) / m.n

    def spread(y: np.ndarray) -> np.ndarray:
        w = y @ to - mean
        return w.T @ w
    error = float(np.abs(m.total(spread) / m.n - np.eye(len(values))).max())
    n, k, centred, explained = m.n, len(values), m.centred(), values / m.trace
    rest = [t - n * SHIFT for t in m.sums]

    def deviations(x: np.ndarray) -> pa.Array:
        x = x - SHIFT
        most = max(n * int(np.abs(x).max()) + max(map(abs, rest)), 1)
        if most * most * dim < 1 << 62:
            d = n * x - np.array(rest, np.int64)
            return pa.array((d * d).sum(1))
        d = n * x.astype(object) - np.array(rest, object)
        return pa.array([v if v < 1 << 63 else None for v in (d * d).sum(1)], pa.int64())

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for ids, raw in zip(batch.column("ids"), batch.column("x")):
                x = np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dim)
                every = np.repeat(np.arange(len(x)), k)
                size = len(every)
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(size, n)),
                     deviations(x).take(pa.array(every)), pa.array((centred(x) @ to).ravel()), pa.array(np.tile(explained, len(x))),
                     pa.array(np.full(size, error))], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return blocks.mapInArrow(run, schema)
