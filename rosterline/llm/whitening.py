"""Whitening of vectors by the singular values and vectors of their centred rows, without forming a covariance.

1. One pass takes the number of rows and the exact sums of the components, made whole numbers floor(scale * c) + offset.
2. Blockwise QR: each partition folds its centred rows, block by block, into one triangle; the triangles are folded in
   groups until one is left.  Its singular values and right singular vectors are those of all centred rows.
3. The triangle, whose size depends on the number of components alone, becomes bidiagonal by Householder reflections;
   differential qd sweeps with shifts (dqds) find its singular values; twisted factorisations give their directions.
4. One pass projects the centred rows on the directions and divides by the standard deviations.

Rows with a null vector, or with null or non-finite components, are left out of fit and result.  Shorter vectors count
as ending in zeros.  A direction without variance (a singular value that rounding can't tell from zero) is no
component, so there may be fewer components than asked for; equal rows, a single row, no rows or vectors without components have none.
Null and repeated ids pass through.  Components of a size above 2**30 are an error.  Directions have their largest
entry positive; of equal eigenvalues any orthonormal basis.  Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship_code, stage
from .vectors import matrix, width

EPS = float(np.finfo(float).eps)
#: Rows per block of a QR step, and triangles that one task (or the driver, at last) folds into one.
ROWS, FOLD = 4096, 16


# -- singular values and directions of a triangle ---------------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, upper diagonal b and v with r = u @ bidiag(a, b) @ v.T, by Householder reflections from both sides."""
    r = r.copy()
    d = r.shape[1]
    v = np.eye(d)

    def mirror(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        h = x / size
        h[0] += math.copysign(1.0, h[0])
        return h / np.linalg.norm(h)

    for k in range(d):
        h = mirror(r[k:, k])
        if h is not None:
            r[k:, k:] -= 2 * np.outer(h, h @ r[k:, k:])
        if k < d - 2:
            h = mirror(r[k, k + 1 :])
            if h is not None:
                r[k:, k + 1 :] -= 2 * np.outer(r[k:, k + 1 :] @ h, h)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ h, h)
    return np.diag(r).copy(), np.diag(r, 1).copy(), v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, float]:
    """One differential qd step: the next q and e, the least d and the sum of 1/d; a negative d ends it."""
    d = q[0] - shift
    least, inverse, new_q, new_e = d, 0.0, [], []
    for k in range(len(e)):
        if d < 0:
            return new_q, new_e, d, inverse
        inverse += 1 / d if d > 0 else math.inf
        top = d + e[k]
        ratio = q[k + 1] / top if top > 0 else 0.0
        new_q.append(top)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift if top > 0 else q[k + 1] - shift
        least = min(least, d)
    inverse += 1 / d if d > 0 else math.inf
    new_q.append(d)
    return new_q, new_e, least, inverse


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling, by dqds.

    A sweep without a shift gives both bounds of the least value: 1 / sum(1/d) from below, the least d from above.  The
    next sweep shifts close to the upper one and, where that overshoots, closer to the lower one, which never does.
    """
    top = max([*np.abs(a), *np.abs(b), 0.0])
    if top == 0:
        return np.zeros(len(a))
    floor = (EPS / 16) ** 2
    q = [max(x * x, floor) for x in (a / top).tolist()]
    blocks, found = [(q, [x * x for x in (b / top).tolist()], 0.0)], []
    while blocks:
        q, e, past = blocks.pop()
        while True:
            cut = next((k for k, x in enumerate(e) if x <= EPS * EPS * (past + min(q[k], q[k + 1])) or x < floor * EPS), None)
            if cut is not None:
                blocks += [(q[: cut + 1], e[:cut], past), (q[cut + 1 :], e[cut + 1 :], past)]
                break
            if len(q) == 1:
                found.append(past + q[0])
                break
            if q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            q, e, most, inverse = _sweep(q, e, 0.0)
            safe = 1 / inverse if inverse > 0 else 0.0
            for shift in (most * (1 - 1e-3), (most + safe) / 2, safe, safe * (1 - 1e-9)):
                new_q, new_e, least, _ = _sweep(q, e, shift)
                if least >= 0:
                    q, e, past = [max(x, floor * EPS) for x in new_q], new_e, past + shift
                    break
    return np.sort(np.array(found))[::-1] * top * top


def directions(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A right singular vector of bidiag(a, b) for each squared singular value, by twisted factorisations.

    For a value x, bidiag'bidiag - x is factored downwards and upwards; where the two meet with the least pivot, the
    vector follows by products alone.  Of values too close to give vectors at right angles, the next least pivot is taken.
    """
    n, top = len(a), max(np.abs(a).max(), np.abs(b).max() if len(b) else 0.0)
    tiny = EPS * top / 16
    a = np.where(np.abs(a) < tiny, tiny, a)
    diag, low = a * a, b / a[:-1]
    guard = np.finfo(float).tiny / EPS
    out = np.zeros((n, 0))
    for x in values:
        s, p = np.empty(n), np.empty(n)
        down, up = np.empty(n - 1), np.empty(n - 1)
        s[0] = -x
        for k in range(n - 1):
            pivot = diag[k] + s[k]
            down[k] = diag[k] * low[k] / (pivot if pivot != 0 else guard)
            s[k + 1] = down[k] * low[k] * s[k] - x
        p[-1] = diag[-1] - x
        for k in range(n - 2, -1, -1):
            pivot = diag[k] * low[k] ** 2 + p[k + 1]
            share = diag[k] / (pivot if pivot != 0 else guard)
            up[k] = low[k] * share
            p[k] = p[k + 1] * share - x
        best, rest = None, -1.0
        for twist in np.argsort(np.abs(np.nan_to_num(s + p + x, nan=np.inf)), kind="stable"):
            z = np.zeros(n)
            z[twist] = 1.0
            for k in range(twist - 1, -1, -1):
                z[k] = -down[k] * z[k + 1]
            for k in range(twist, n - 1):
                z[k + 1] = -up[k] * z[k]
            z /= np.abs(z).max()
            z /= np.linalg.norm(z)
            for _ in range(2):
                z = z - out @ (out.T @ z)
            if np.linalg.norm(z) > rest:
                best, rest = z, np.linalg.norm(z)
            if rest > 0.5:
                break
        out = np.column_stack([out, best / rest])
    return out


# -- the operator -----------------------------------------------------------------------------------------------------


@dataclass
class Whitening:
    """rows, exact sums, eigenvalues of the covariance (falling) and their directions as columns, trace of the covariance."""

    rows: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def _whole(rows: np.ndarray, scale: float, offset: int) -> np.ndarray:
    if rows.size and np.abs(rows).max() > 2.0**30:
        raise ValueError("a component is above 2**30 in size")
    return np.floor(rows * scale).astype(np.int64) + offset


def _centred(whole: np.ndarray, rows: int, sums: list[int]) -> np.ndarray:
    """whole - sums / rows: the whole part is subtracted exactly, so that nothing cancels."""
    parts = [divmod(s, rows) for s in sums]
    return (whole - np.array([q for q, _ in parts], np.int64)) - np.array([r / rows for _, r in parts])


def _triangle(*blocks: np.ndarray) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = 8, scale: float = 1024.0, offset: int = 100_000) -> Whitening:
    """The whitening of all rows of ``vectors``."""
    spark = vectors.sparkSession
    ship_code(spark)
    dim = width(vectors, vector_col)
    only = vectors.select(F.col(vector_col).cast("array<double>").alias("_vec"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dim, np.int64)
        for batch in batches:
            whole = _whole(matrix(batch.column(0), dim)[1], scale, offset)
            n, sums = n + len(whole), sums + whole.sum(axis=0)
        yield pa.record_batch([pa.array([n], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.int64()))], names=["n", "sums"])

    parts = stage(only.mapInArrow(add, "n bigint, sums array<bigint>"), "sums")
    n = parts.agg(F.sum("n")).first()[0] or 0
    by_place = parts.select(F.posexplode("sums").alias("k", "s")).groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = [int(r["s"]) for r in by_place.orderBy("k").collect()]  # one row per component of a vector
    none = Whitening(n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0)
    if n < 2 or dim == 0:
        return none

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, dim))
        for batch in batches:
            y = _centred(_whole(matrix(batch.column(0), dim)[1], scale, offset), n, sums)
            for k in range(0, len(y), ROWS):
                r = _triangle(r, y[k : k + ROWS])
        if len(r):
            yield pa.record_batch([pa.array([r.tobytes()], pa.binary())], names=["r"])

    def again(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"r": [_triangle(*(np.frombuffer(x).reshape(-1, dim) for x in part["r"])).tobytes()]})

    left = stage(only.mapInArrow(fold, "r binary").withColumn("k", F.monotonically_increasing_id()), "triangles")
    while (count := left.count()) > FOLD:
        left = left.withColumn("g", F.pmod(F.xxhash64("k"), F.lit(math.ceil(count / FOLD))))
        left = stage(left.groupBy("g").applyInPandas(again, "r binary").withColumn("k", F.monotonically_increasing_id()), "triangles")
    r = _triangle(*(np.frombuffer(bytes(x["r"])).reshape(-1, dim) for x in left.select("r").collect()))  # FOLD triangles at most
    r = np.vstack([r, np.zeros((dim - len(r), dim))])

    a, b, v = bidiagonal(r)
    squares = squared_singular_values(a, b)
    real = np.sqrt(squares) > max(n, dim) * EPS * math.sqrt(squares[0]) if squares[0] > 0 else np.zeros(dim, bool)
    chosen = squares[real][:components]
    if not len(chosen):
        return none
    found = v @ directions(a, b, chosen)
    found *= np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    return Whitening(n, sums, chosen / n, found, float((r * r).sum() / n))


def project(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0, offset: int = 100_000) -> DataFrame:
    """id, deviation (sum of (rows * whole - sums)**2, exact) and whitened (array, one number per component) of every row."""
    ship_code(vectors.sparkSession)
    n, sums, dim = model.rows, model.sums, len(model.sums)
    turn = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, rows = matrix(batch.column(1), dim)
            whole = _whole(rows, scale, offset)
            apart = (whole - np.array([s // n for s in sums], np.int64)).astype(object) if n else whole
            size = n * max(np.abs(apart).max(), 1) + n if apart.size else 0
            exact = (apart if size * size * dim >= 2**62 else apart.astype(np.int64)) * n - np.array([s % n for s in sums], np.int64) if n else whole
            deviation = [int(x) for x in (exact * exact).sum(axis=1)]
            white = _centred(whole, n, sums) @ turn if n else np.zeros((0, 0))
            ids = batch.column(0).filter(pa.array(good))
            yield pa.record_batch([ids, pa.array(deviation, pa.decimal128(38, 0)), pa.array(list(white), pa.list_(pa.float64()))], names=["_id", "deviation", "whitened"])

    cols = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_vec"))
    return cols.mapInArrow(run, f"_id {cols.schema['_id'].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>").withColumnRenamed("_id", id_col)


def identity_error(projected: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity (0 without components)."""
    if not components:
        return 0.0
    w = [F.col("whitened")[k] for k in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    means = projected.agg(*(F.avg(x) for x in w)).first()
    centred = [x - F.lit(float(m)) for x, m in zip(w, means)]
    moments = projected.agg(*(F.avg(centred[i] * centred[j]) for i, j in pairs)).first()
    return max(abs(m - (i == j)) for m, (i, j) in zip(moments, pairs))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8, scale: float = 1024.0, offset: int = 100_000) -> DataFrame:
    """id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error: a row for every
    row that is left and every component."""
    model = fit(vectors, vector_col, components, scale, offset)
    rows = stage(project(vectors, model, id_col, vector_col, scale, offset), "whitened")
    error = identity_error(rows, len(model.values))
    share = F.array(*(F.lit(x) for x in model.explained)) if model.explained else F.array().cast("array<double>")
    out = rows.select(F.col(id_col), "deviation", F.posexplode("whitened").alias("_k", "_w"))
    return out.select(
        id_col, (F.col("_k") + 1).cast("int").alias("component"), F.lit(model.rows).cast("long").alias("n"), "deviation", F.col("_w").alias("whitened"),
        F.get(share, F.col("_k")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
