"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X (n x d) stay distributed, as blocks of a few MB in the
checkpoint folder. From a random unit vector v the process alternates
``u = X v - beta u'`` and ``v = X'u - alpha v'``; both sides are
reorthogonalised against all their predecessors. The driver holds the right
vectors V (d x k), the recurrence's numbers and nothing that grows with n: as
``X V = U R`` with R small and triangular, a task gets its rows of U back as
``X P`` with ``P = V R^-1``, so no left vector is stored or shipped, and a
lost executor costs its blocks only. One pass over the blocks is one step: it
sums ``U'w`` (the reorthogonalisation of the left side), ``X'w`` and ``w'w``
for ``w = X v - beta u'``, from which ``alpha``, ``X'u`` and the next v
follow. Steps end when the residual of every wanted component is at the level
of rounding, or when V spans the space; the bidiagonal matrix's SVD then gives
components and deviations.

Entries become whole numbers ``floor(scale * c) + shift`` first, so sums,
means and each row's ``deviation`` are exact.

Defined results: rows whose vector is null, has null or non-finite entries, no
entries, entries beyond 2**40 in size, or not the commonest length (of ties the
longer) are left out. Repeated rows and null ids each count and come back
for themselves. Only components of positive variance are returned: at most
``min(top, d)``, none where all rows are equal or there are none. The sign of a
component is that which makes its entry of largest size positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import cut_lineage

BLOCK_BYTES = 4 << 20
LIMIT = float(1 << 40)


@dataclass
class Settings:
    top: int = 32
    scale: int = 64
    shift: int = 1_000_000
    seed: int = 11
    #: Residual of a wanted component against the largest deviation.
    tol: float = 1e-15
    #: Steps at most (None: the dimension); more are an error.
    steps: int | None = None


@dataclass
class Model:
    """Components (d x k, by falling eigenvalue), their eigenvalues, and the fit's sums."""

    rows: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    steps: int = 0
    residual: float = 0.0
    alpha: list = field(default_factory=list)
    beta: list = field(default_factory=list)


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LIMIT))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def _whole(c: np.ndarray, s: Settings) -> np.ndarray:
    return np.floor(s.scale * c).astype(np.int64) + s.shift


def _totals(partials: DataFrame) -> np.ndarray:
    """Sums of ``(pos, val)`` rows by pos: as many rows as positions, whatever
    the number of tasks."""
    rows = partials.groupBy("pos").agg(F.sum("val").alias("val")).collect()
    out = np.zeros(max((r.pos for r in rows), default=-1) + 1, dtype=object if rows and isinstance(rows[0].val, int) else float)
    for r in rows:
        out[r.pos] = r.val
    return out


def _long_rows(values: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values, kind)], names=["pos", "val"])


def _deviation(t: np.ndarray) -> list[int]:
    """Exact sums of squares of whole numbers by row."""
    if t.size and int(np.abs(t).max()) < (1 << 31) // max(1, int(np.ceil(np.sqrt(t.shape[1])))):
        return (t * t).sum(axis=1).tolist()
    return [sum(int(x) ** 2 for x in row) for row in t]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums`` as whole numbers (Python's where int64 is too small)."""
    if n * (int(np.abs(x).max()) if x.size else 0) + max(map(abs, sums)) >= 1 << 62:
        return n * x.astype(object) - np.array(sums, dtype=object)
    return n * x - np.array(sums, np.int64)


def _blocks(table: DataFrame, d: int, n: int, sums: list[int], s: Settings) -> DataFrame:
    """``(ids, deviations, rows, x)``: centred rows as doubles, BLOCK_BYTES a block."""
    step = max(1, BLOCK_BYTES // (8 * d))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                t = _centred(_whole(_matrix(part.column(1), d), s), n, sums)
                ids = pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), part.column(0))
                dev = pa.array([_deviation(t)], pa.list_(pa.decimal128(38, 0)))
                yield pa.RecordBatch.from_arrays(
                    [ids, dev, pa.array([len(t)], pa.int32()), pa.array([(t / n).astype(np.float64).tobytes()], pa.binary())],
                    names=["ids", "deviations", "rows", "x"])

    kind = dict(table.dtypes)["id"]
    return table.mapInArrow(run, f"ids array<{kind}>, deviations array<decimal(38,0)>, rows int, x binary")


def _load(b: pa.RecordBatch, d: int) -> Iterator[np.ndarray]:
    for raw in b.column("x"):
        yield np.frombuffer(raw.as_buffer(), np.float64).reshape(-1, d)


def _pass(blocks: DataFrame, d: int, sums_of) -> np.ndarray:
    """The sum over all blocks of the vectors ``sums_of(X)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in _load(b, d):
                got = sums_of(x)
                total = got if total is None else total + got
        if total is not None:
            yield _long_rows(total, pa.float64())

    return _totals(blocks.select("x").mapInArrow(run, "pos int, val double")).astype(float)


def _orthogonal(v: np.ndarray, V: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - V @ (V.T @ v)
    return v


def bidiagonalise(blocks: DataFrame, d: int, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, float]:
    """Right singular vectors (d x k) and singular values of the blocks' rows,
    by falling value, with the steps made and the largest residual."""
    rng = np.random.default_rng(s.seed)
    V, P = np.zeros((d, 0)), np.zeros((d, 0))
    alphas: list[float] = []
    betas: list[float] = []
    Z = np.zeros((d, 0))  # X'U
    v = rng.standard_normal(d)
    v /= np.linalg.norm(v)
    beta, limit, largest = 0.0, min(s.steps or d, d), 0.0
    while True:
        k = V.shape[1]
        last = P[:, -1] if k else np.zeros(d)

        def sums_of(x: np.ndarray, v=v, last=last, P=P, beta=beta) -> np.ndarray:
            w = x @ v - beta * (x @ last)
            xw = x.T @ w
            return np.concatenate([P.T @ xw if P.shape[1] else np.zeros(0), xw, [w @ w]])

        got = _pass(blocks, d, sums_of)
        h, xw, ww = got[:k], got[k:k + d], got[-1]
        # what is left of the earlier left vectors goes (h is of rounding size)
        norm2 = ww - h @ h
        alpha = float(np.sqrt(max(norm2, 0.0)))
        largest = max(largest, alpha, beta)
        if alpha <= 1e-13 * largest or largest == 0.0:
            alpha, p, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            p = (v - beta * last - P @ h) / alpha
            z = (xw - Z @ h) / alpha
        V, P, Z = np.column_stack([V, v]), np.column_stack([P, p]), np.column_stack([Z, z])
        alphas.append(alpha)
        k += 1
        nxt = _orthogonal(z - alpha * v, V)
        beta = float(np.linalg.norm(nxt))
        B = np.diag(alphas) + np.diag(betas, 1) if k > 1 else np.array([[alphas[0]]])
        left, sigma, right = np.linalg.svd(B)
        want = min(s.top, d)
        if beta <= 1e-13 * largest:  # the space of v is used up: go on beside it
            beta = 0.0
            nxt = _orthogonal(rng.standard_normal(d), V)
            residual = 0.0
        else:
            residual = beta * float(np.abs(left[-1, :want]).max())
            nxt = nxt / beta
        # a used-up space may lack components: only a full one, or one whose
        # residuals are of rounding size while it still grows, is final
        if k == d or largest == 0.0 or (k > want and beta > 0.0 and residual <= s.tol * sigma[0]):
            return V @ right.T, sigma, np.array([alphas, [*betas, 0.0]]), k, (0.0 if k == d else residual)
        if k >= limit:
            raise RuntimeError(f"{k} steps leave a residual of {residual / sigma[0]:.1e}; allow more")
        betas.append(beta)
        v = nxt / np.linalg.norm(nxt)


def fit(blocks: DataFrame, d: int, n: int, sums: list[int], s: Settings) -> Model:
    vectors, sigma, rows, steps, residual = bidiagonalise(blocks, d, s)
    values = sigma ** 2 / n
    trace = float(_pass(blocks, d, lambda x: np.array([np.vdot(x, x)]))[0]) / n
    keep = np.flatnonzero(values[:s.top] > 1e-20 * max(trace, 0.0))
    comp = vectors[:, keep]
    if comp.size:
        comp = comp * np.sign(comp[np.abs(comp).argmax(axis=0), np.arange(len(keep))])
    return Model(n, np.array(sums, dtype=object), comp, values[keep], trace, steps, residual, rows[0].tolist(), rows[1].tolist())


def identity_error(blocks: DataFrame, d: int, n: int, W: np.ndarray) -> float:
    """The largest entry, in size, of the covariance of the rows of ``X W`` less
    the identity; centred before multiplying."""
    k = W.shape[1]
    mean = _pass(blocks, d, lambda x: (x @ W).sum(axis=0)) / n

    def sums_of(x: np.ndarray) -> np.ndarray:
        y = x @ W - mean
        return (y.T @ y).ravel()

    return float(np.abs(_pass(blocks, d, sums_of).reshape(k, k) / n - np.eye(k)).max())


def prepare(vectors: DataFrame, id_col: str, vector: str, s: Settings) -> tuple[DataFrame, int, int, list[int]] | None:
    """Blocks of centred rows with the dimension, row count and sums; None without rows."""
    table = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("vector")).where(_usable(F.col("vector")))
    sizes = table.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max(F.struct("n", "d"))).first()[0]
    if most is None:
        return None
    n, d = most
    table = table.where(F.size("vector") == d)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for b in batches:
            total = [a + int(c) for a, c in zip(total, _whole(_matrix(b.column(0), d), s).sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total, pa.decimal128(38, 0))], names=["pos", "val"])

    total = [int(x) for x in _totals(table.select("vector").mapInArrow(sums, "pos int, val decimal(38,0)"))]
    return cut_lineage(_blocks(table, d, n, total, s)), d, n, total


def whiten(vectors: DataFrame, s: Settings = Settings(), id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, component, n, deviation decimal, whitened, explained,
    identity_error)`` for each usable row and component."""
    spark, kind = vectors.sparkSession, dict(vectors.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    got = prepare(vectors, id_col, vector, s)
    if got is None:
        return spark.createDataFrame([], schema)
    blocks, d, n, sums = got
    blocks = blocks.persist()
    try:
        model = fit(blocks, d, n, sums, s)
        if not model.values.size:
            return spark.createDataFrame([], schema)
        W = model.components / np.sqrt(model.values)
        error = identity_error(blocks, d, n, W)
    finally:
        blocks.unpersist()
    k, explained = W.shape[1], model.values / model.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, dev = b.column("ids"), b.column("deviations")
            for i, x in enumerate(_load(b, d)):
                r = len(x)
                rows = pa.array(np.repeat(np.arange(r), k))
                yield pa.RecordBatch.from_arrays([
                    ids[i].values.take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)),
                    pa.array(np.full(r * k, n)), dev[i].values.take(rows), pa.array((x @ W).ravel()),
                    pa.array(np.tile(explained, r)), pa.array(np.full(r * k, error))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.select("ids", "deviations", "x").mapInArrow(project, schema)
