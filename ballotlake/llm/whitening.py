"""Operator 12: whitening of embeddings by Chebyshev-filtered subspace
iteration.

The covariance is never formed. One pass over the vectors multiplies it by
a thin block: every task adds up (x - mean)ᵀ((x - mean) Q) over its rows, and
the cells of these d x b matrices are summed by key. A polynomial of such
passes, Chebyshev's on the interval of the unwanted eigenvalues (its lower
end from a few Lanczos steps, its upper end from the block), damps them;
QR and Rayleigh-Ritz on the driver (matrices of d x b numbers, whatever the
number of vectors) follow, until the residuals certify the wanted pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Vectors of a block row are at most about this many bytes.
BLOCK_BYTES = 1 << 20
#: Degree of the filter, columns of the block beyond the wanted ones, and most rounds.
DEGREE, EXTRA, ROUNDS = 8, 24, 200
#: Lanczos steps for the lower end of the spectrum.
STEPS = 10


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``block, d``: the usable vectors as rows of packed 64-bit integers
    floor(1024 * c) + 100000 with their ids; ``d`` entries each.

    Vectors that are null, empty or hold null or non-finite entries are
    left out. floor(1024 * c) saturates at 2 ** 40 on either side.
    """
    usable = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists(
        "v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .where(usable))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            size = lists.value_lengths().to_numpy()
            to = np.r_[0, np.cumsum(size)]
            flat = np.floor(lists.flatten().to_numpy() * 1024.0)
            flat = np.clip(flat, -(2.0 ** 40), 2.0 ** 40).astype(np.int64) + 100000
            # Rows of equal length that follow one another share a block.
            new = np.flatnonzero(np.r_[True, size[1:] != size[:-1]]) if len(size) else []
            for lo, hi in zip(new, [*new[1:], len(size)]):
                step = max(1, BLOCK_BYTES // (8 * int(size[lo])))
                for i in range(lo, hi, step):
                    j = min(i + step, hi)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(size[lo])], pa.int64()),
                         pa.array([b.column("vec_id")[i:j].to_pylist()], pa.list_(pa.int64())),
                         pa.array([flat[to[i]:to[j]].tobytes()], pa.binary())], ["d", "ids", "x"])

    return rows.mapInArrow(pack, "d long, ids array<bigint>, x binary")


def _sums(blocks: DataFrame, cells: Callable[[np.ndarray], np.ndarray], size: int, kind: str = "double") -> np.ndarray:
    """The sum over all blocks of ``cells(x)``, ``size`` numbers. Each task
    adds up its own blocks, Spark adds the tasks' cells by key; ``size`` rows
    reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for d, x in zip(b.column("d").to_pylist(), b.column("x")):
                part = cells(np.frombuffer(x.as_buffer(), np.int64).reshape(-1, d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total.reshape(-1))],
                                             ["cell", "value"])

    rows = (blocks.select("d", "x").mapInArrow(run, f"cell int, value {kind}")
            .groupBy("cell").agg(F.sum("value").alias("value")).toPandas())
    out = np.zeros(size, np.int64 if kind == "long" else float)
    out[rows["cell"]] = rows["value"]
    return out


def _centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """x - S / n, with one rounding where n * x - S is exact."""
    if abs(int(n)) * (int(np.abs(x).max(initial=0)) + 1) < 1 << 62:
        return (n * x - s) / n
    return x - s / n


def lowest(product: Callable[[np.ndarray], np.ndarray], d: int, rng: np.random.Generator, steps: int = STEPS) -> float:
    """A value that is most likely below all eigenvalues, 0 at least: the
    smallest Ritz value of a few Lanczos steps less the last remainder's
    length. Were it too high, the eigenvalues below it would be damped less,
    and the search would take longer."""
    q = [rng.standard_normal(d)]
    q[0] /= np.linalg.norm(q[0])
    diagonal, off = [], []
    for _ in range(min(steps, d)):
        z = product(q[-1][:, None])[:, 0]
        diagonal.append(float(q[-1] @ z))
        for _ in range(2):
            z -= np.array(q).T @ (np.array(q) @ z)
        off.append(float(np.linalg.norm(z)))
        if off[-1] <= 1e-10 * abs(diagonal[0]):
            return 0.0
        q.append(z / off[-1])
    t = np.diag(diagonal) + np.diag(off[:-1], 1) + np.diag(off[:-1], -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - off[-1])


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, trace: float, seed: int = 12,
               degree: int = DEGREE, extra: int = EXTRA, rounds: int = ROUNDS, tol: float = 1e-14
               ) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues, their unit eigenvectors (columns) and
    the largest residual of the positive semidefinite ``product``.

    Rounds go on until every wanted residual |Vq - eq| is at most ``tol``
    times the largest eigenvalue, or until rounding stops it from falling
    below a value that is itself at most 1e-9 of it; otherwise an error is
    raised. The eigenvalues left over can't add up to more than the trace.
    """
    b = min(d, k + extra)
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((d, b)))[0]
    best, bottom = np.inf, None
    for _ in range(rounds):
        z = product(q)
        h = q.T @ z
        value, turn = np.linalg.eigh((h + h.T) / 2)
        order = np.argsort(-value)
        value, q, z = value[order], q @ turn[:, order], z @ turn[:, order]
        top = max(value[0], 0.0)
        worst = float(np.linalg.norm(z - q * value, axis=0)[:k].max())
        if worst <= tol * top or top <= trace * 1e-15:
            break
        if worst <= 1e-9 * top and worst > best / 2:
            break
        best = min(best, worst)
        if b == d:
            # The block spans the whole space: one more Rayleigh-Ritz step is all that is left.
            q = np.linalg.qr(q)[0]
            continue
        if bottom is None:
            bottom = lowest(product, d, rng)
        # Scaled Chebyshev recurrence: small from the bottom to the block's smallest Ritz value, 1 at the largest.
        edge = max(value[-1], top * 1e-12)
        low = bottom if bottom < edge else 0.0
        c, e = (edge + low) / 2, (edge - low) / 2
        sigma = first = e / (top - c)
        y0, y1 = q, (z - c * q) * (sigma / e)
        for _ in range(1, degree):
            nxt = 1.0 / (2.0 / first - sigma)
            y0, y1 = y1, (product(y1) - c * y1) * (2.0 * nxt / e) - (sigma * nxt) * y0
            sigma = nxt
        q = np.linalg.qr(y1)[0]
    else:
        raise ArithmeticError(f"no certified eigenpairs after {rounds} rounds: residual {worst:g} of {top:g}")
    return value[:k], q[:, :k], worst


def whiten(vectors: DataFrame, k: int = 8, vec_id: str = "vec_id", vector: str = "embedding", **search) -> DataFrame:
    """Per usable vector and component (1 to ``k``, by falling eigenvalue):
    ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    The list of usable vectors is the fit list. Ids may be null or repeated;
    repeated rows count and return as often as they occur. Components whose
    eigenvalue is zero (equal vectors, fewer vectors than components) have no
    whitened value and are not returned; without usable vectors there are no
    rows. A ``deviation`` beyond the range of long is null. Vectors of
    different lengths have no common covariance: ValueError. Columns of other
    names are not read.
    """
    blocks = written(integer_vectors(vectors, vec_id, vector), "whitening-blocks")
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = vectors.sparkSession
    dims = [r["d"] for r in blocks.select("d").distinct().limit(2).collect()]
    if len(dims) > 1:
        raise ValueError(f"vectors of different lengths: {dims}")
    if not dims:
        return spark.createDataFrame([], out)
    d = dims[0]
    first = _sums(blocks, lambda x: np.append(x.sum(axis=0), len(x)), d + 1, "long")
    s, n = first[:d], int(first[d])
    trace = float(_sums(blocks, lambda x: np.array([np.square(_centred(x, n, s)).sum()]), 1)[0]) / n

    def product(q: np.ndarray) -> np.ndarray:
        def cells(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, s)
            return c.T @ (c @ q)

        return _sums(blocks, cells, d * q.shape[1]).reshape(d, -1) / n

    if not trace > 0:
        return spark.createDataFrame([], out)
    value, basis, _ = eigenpairs(product, d, min(k, d), trace, **search)
    kept = value > trace * 1e-13
    value, basis = value[kept], basis[:, kept]
    m = len(value)
    scale = basis / np.sqrt(value)

    def moments(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, s) @ scale
        return np.append(w.sum(axis=0), (w.T @ w).reshape(-1))

    total = _sums(blocks, moments, m + m * m) / n
    error = float(np.abs(total[m:].reshape(m, m) - np.outer(total[:m], total[:m]) - np.eye(m)).max())
    share = value / trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, raw in zip(b.column("ids"), b.column("x")):
                x = np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, d)
                w = _centred(x, n, s) @ scale
                with np.errstate(over="ignore"):
                    gap = n * x - s
                    dev = (gap * gap).sum(axis=1)  # exact modulo 2 ** 64
                size = np.square(n * x.astype(float) - s).sum(axis=1)
                dev = pa.array(np.repeat(dev, m), mask=np.repeat(size >= 2.0 ** 63 * (1 - 1e-9), m))
                count = len(x)
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(pa.array(np.repeat(np.arange(count), m))),
                     pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), count)), pa.array(np.full(count * m, n)), dev,
                     pa.array(w.reshape(-1)), pa.array(np.tile(share, count)), pa.array(np.full(count * m, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.select("ids", "x").mapInArrow(rows, out)
