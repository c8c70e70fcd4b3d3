"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers x = floor(64 c) + 1000000 and are written in blocks;
n, the sums S and every row's deviation are exact. The covariance matrix is never
formed: a pass reads the blocks once and returns X^T(X Q) / n of the centred rows
for a block Q of a few columns more than wanted, a d x b sum for each task, added
up in two steps where there are many tasks. A cycle sends Q through the Chebyshev
polynomial that damps the spectrum from its lower end (from a short Lanczos run)
up to the smallest Ritz value of the block, a pass for each degree, then does QR and
Rayleigh-Ritz. Components are certified when every wanted residual is at rounding
level and a cycle with a fresh random column in the block has changed none of the
wanted values.

Rows whose vector is null or holds a null or non-finite entry are dropped, and so
are those with an entry beyond 2**40, whose x leaves the range of exact sums.
Repeated rows and null vec_ids are rows like others. Vectors of another length are
fitted among themselves; empty ones have no component. Components whose eigenvalue
is below 1e-12 of the largest (rank lost, one row, equal rows) have no scale and are
left out. deviation is null where it leaves the range of a long. An empty table
gives no row. Columns besides vec_id and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm.common import cut, table

SCALE, SHIFT, WIDEST = 64, 1_000_000, 2.0 ** 40
COMPONENTS, GUARD, DEGREE, CYCLES = 32, 8, 8, 60
BLOCK, FAN, SEED = 1 << 20, 64, 7
#: Residuals, of the largest eigenvalue: what double precision reaches, and what is still accepted where it stalls.
TOLERANCE, STALLED = 2e-14, 1e-12
RANK = 1e-12


def blocks(vectors: DataFrame) -> DataFrame:
    """(dim, ids, x): written blocks of at most BLOCK entries, x as little-endian longs."""
    e = F.col("embedding").cast("array<double>")
    usable = e.isNotNull() & F.forall(e, lambda c: F.coalesce(F.abs(c) < WIDEST / SCALE, F.lit(False)))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e")).where(usable & (F.size("e") > 0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, e = b.column(0), b.column(1)
            dims = np.diff(e.offsets.to_numpy())
            for d in np.unique(dims):
                at, step = np.flatnonzero(dims == d), max(1, BLOCK // int(d))
                for s in range(0, len(at), step):
                    part = pa.array(at[s:s + step])
                    c = e.take(part).flatten().to_numpy()
                    x = np.floor(SCALE * c).astype("<i8") + SHIFT
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(d)], pa.int32()), pa.array([ids.take(part).to_pylist()], pa.list_(pa.int64())),
                         pa.array([x.tobytes()], pa.binary())], ["dim", "ids", "x"])

    return cut(rows.mapInArrow(pack, "dim int, ids array<long>, x binary"), "vectors")


@dataclass
class Sums:
    """n, the sums S by dimension (exact), and the largest |x - floor(S/n)|."""
    n: int
    total: list[int]
    reach: int = 0

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.total], np.int64)
        self.rest = np.array([s % self.n for s in self.total], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part is taken off before anything is rounded."""
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Of each row the exact sum over dimensions of (n x - S)**2."""
        n, y = self.n, x - self.whole
        most = n * (int(np.abs(y).max(initial=0)) + 1)
        if most < 1 << 31 and most * most * y.shape[1] < 1 << 63:
            return ((n * y - self.rest) ** 2).sum(1).tolist()
        y = n * y.astype(object) - self.rest.astype(object)
        return [s if s < 1 << 63 else None for s in (y * y).sum(1)]


def matrix(x: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(x, "<i8").reshape(-1, dim)


def sums(data: DataFrame) -> dict[int, Sums]:
    """Exact n and sums of every vector length; one row per dimension reaches the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = matrix(x, d)
                yield pa.RecordBatch.from_arrays([
                    pa.array([d], pa.int32()), pa.array([len(x)], pa.int64()), pa.array([x.sum(0).tolist()], pa.list_(pa.int64()))],
                    ["dim", "n", "s"])

    rows = data.select("dim", "x").mapInArrow(add, "dim int, n long, s array<long>")
    found = rows.select("dim", "n", F.posexplode("s").alias("at", "s")).groupBy("dim", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    out: dict[int, Sums] = {}
    for d in sorted({r.dim for r in found}):
        own = sorted((r for r in found if r.dim == d), key=lambda r: r.at)
        out[d] = Sums(own[0].n, [int(r.s) for r in own])
    return out


def gathered(data: DataFrame, shape: tuple[int, int], term) -> np.ndarray:
    """The sum over all blocks of term(x): one partial sum a task, FAN of them at most to the driver."""
    rows, cols = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(shape)
        for b in batches:
            for x in b.column(0).to_pylist():
                acc += term(matrix(x, rows))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([acc.tobytes()], pa.binary())],
                                         ["task", "part"])

    def merge(t: pa.Table) -> pa.Table:
        t = t.sort_by("task")
        acc = sum((np.frombuffer(p) for p in t.column("part").to_pylist()), np.zeros(rows * cols))
        return pa.table({"task": pa.array([t.column("task")[0].as_py()], pa.int32()), "part": pa.array([acc.tobytes()], pa.binary())})

    parts = data.select("x").mapInArrow(run, "task int, part binary")
    if parts.rdd.getNumPartitions() > FAN:
        parts = parts.groupBy(F.pmod("task", F.lit(FAN))).applyInArrow(merge, "task int, part binary")
    return sum((np.frombuffer(r.part) for r in sorted(parts.collect(), key=lambda r: r.task)), np.zeros(rows * cols)).reshape(shape)


@dataclass
class Fit:
    """Eigenpairs (falling), the trace of V, and how the iteration ended."""
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int
    residual: float


def lower_end(apply, dim: int, steps: int = 10) -> float:
    """A lower bound, about, of the spectrum: the least Ritz value of a Lanczos run less its residual."""
    rng = np.random.default_rng(SEED)
    q = [rng.standard_normal(dim)]
    q[0] /= np.linalg.norm(q[0])
    alpha, beta = [], []
    for _ in range(min(steps, dim)):
        w = apply(q[-1][:, None])[:, 0]
        alpha.append(float(q[-1] @ w))
        for _ in range(2):
            w = w - np.array(q).T @ (np.array(q) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(alpha):
            break
        q.append(w / beta[-1])
    t = np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1) + np.diag(beta[:len(alpha) - 1], -1)
    values, vectors = np.linalg.eigh(t)
    return max(0.0, float(values[0] - beta[-1] * abs(vectors[-1, 0])))


def rayleigh_ritz(q: np.ndarray, aq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), Ritz vectors and their residual norms."""
    h = q.T @ aq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    v = q @ turn
    return values, v, np.linalg.norm(aq @ turn - v * values, axis=0)


def degree(values: np.ndarray, k: int, mid: float, half: float, most: int) -> int:
    """The filter's degree: the first value may outgrow the k-th by 1e8 at most, or rounding drowns the k-th."""
    grow = np.arccosh(np.maximum(1.0, (values[[0, k - 1]] - mid) / half))
    return int(np.clip(np.log(1e8) / max(grow[0] - grow[1], 1e-9), 2, most))


def filtered(apply, v: np.ndarray, mid: float, half: float, m: int) -> np.ndarray:
    """The Chebyshev polynomial of degree m on [mid - half, mid + half] in A, times v; columns keep their size."""
    size = np.ones(v.shape[1])
    old, new = v, (apply(v) - mid * v) / half
    for _ in range(m - 1):
        old, new = new, 2 / half * (apply(new) - mid * new) - old
        size = np.maximum(np.linalg.norm(new, axis=0), 1e-300)
        old, new = old / size, new / size
    return new


def principal(apply, dim: int, k: int, trace: float, guard: int = GUARD, most: int = DEGREE, cycles: int = CYCLES) -> Fit:
    """The k largest eigenpairs of the matrix that ``apply`` multiplies by."""
    k, width, rng, passes = min(k, dim), min(dim, k + guard), np.random.default_rng(SEED), 0

    def times(q):
        nonlocal passes
        passes += 1
        return apply(q)

    low = lower_end(times, dim) if width < dim else 0.0
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0] if width < dim else np.eye(dim)
    values, v, residual = rayleigh_ritz(q, times(q))
    best, before = np.inf, None
    for _ in range(cycles):
        top = max(float(values[0]), 0.0)
        worst = float(residual[:k].max())
        same = before is not None and np.abs(values[:k] - before).max() <= STALLED * top
        if width == dim or top == 0 or same and (worst <= TOLERANCE * top or worst <= STALLED * top and worst > best / 2):
            break
        best, before = min(best, worst), values[:k].copy()
        high = max(float(values[-1]), 1e-3 * float(values[k - 1]), 1e-12 * top)
        low = min(low, 0.99 * high)
        mid, half = (high + low) / 2, (high - low) / 2
        m = degree(values, k, mid, half, most)
        v[:, -1] = rng.standard_normal(dim) / np.sqrt(dim)     # a probe for directions the block has missed
        q = np.linalg.qr(filtered(times, v, mid, half, m))[0]
        values, v, residual = rayleigh_ritz(q, times(q))
    else:
        if residual[:k].max() > 1e-8 * values[0]:
            raise RuntimeError("subspace iteration did not converge")
    kept = int((values[:k] > RANK * max(float(values[0]), 0.0)).sum()) if trace > 0 else 0
    return Fit(values[:kept].copy(), v[:, :kept].copy(), trace, passes, float(residual[:k].max(initial=0)))


def fit(data: DataFrame, s: Sums, k: int = COMPONENTS) -> Fit:
    """Principal components of the blocks of one vector length."""
    dim, n = len(s.total), s.n

    def apply(q: np.ndarray) -> np.ndarray:
        def term(x):
            y = s.centred(x)
            return y.T @ (y @ q)
        return gathered(data, (dim, q.shape[1]), term) / n

    trace = gathered(data, (dim, 1), lambda x: (s.centred(x) ** 2).sum(0)[:, None]).sum() / n
    return principal(apply, dim, k, float(trace))


def identity_error(data: DataFrame, s: Sums, f: Fit) -> float:
    """Largest entry of the whitened rows' covariance less the identity, the rows centred once more."""
    dim, p = len(s.total), f.vectors / np.sqrt(f.values)
    mean = gathered(data, (dim, 1), lambda x: s.centred(x).sum(0)[:, None])[:, 0] / s.n @ p

    def term(x):
        w = s.centred(x) @ p - mean
        out = np.zeros((dim, w.shape[1]))
        out[:w.shape[1]] = w.T @ w
        return out
    cov = gathered(data, (dim, len(f.values)), term)[:len(f.values)] / s.n
    return float(np.abs(cov - np.eye(len(cov))).max())


def whiten(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component."""
    data = blocks(vectors)
    known = sums(data)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    fitted = {}
    for d, s in known.items():                      # lengths of vectors: a few
        own = data.where(F.col("dim") == d)
        f = fit(own, s, k)
        if len(f.values):
            fitted[d] = (s, f, identity_error(own, s, f))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, ids, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if d not in fitted:
                    continue
                s, f, error = fitted[d]
                x, c = matrix(raw, d), len(f.values)
                w = s.centred(x) @ f.vectors / np.sqrt(f.values)
                size = len(x) * c
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), c))),
                    pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), len(x))), pa.array(np.full(size, s.n)),
                    pa.array(s.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), c))),
                    pa.array(w.ravel()), pa.array(np.tile(f.values / f.trace, len(x))), pa.array(np.full(size, error))], names)

    return data.mapInArrow(project, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
