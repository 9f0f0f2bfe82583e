"""Embedding whitening: decorrelated, unit-variance components of all vectors.

Every entry c of a vector becomes the whole number ``x = floor(64 * c) + 1000000``; sums
and deviations of the x are exact integers. The directions are found without ever
forming a covariance matrix, whose small eigenvalues would drown in rounding:

1. *Blockwise QR.* Every task folds its centred rows, one Arrow batch at a time, into a
   d x d triangle R; the triangles are merged 16 at a time until one is left. A task
   holds one batch and one triangle, a merge 16 triangles, whatever the number of rows.
2. *Householder bidiagonalisation* of R: R = Q B P'.
3. *dqds* finds the squared singular values of B from its squared entries by
   differential quotient-difference steps, whose shifts are lower bounds of the smallest
   value left (one over the trace of the inverse, a by-product of an unshifted step).
4. *Twisted factorisations* of B'B - lambda give each direction: stationary and
   progressive steps meet where they leave the smallest remainder. Directions whose
   values lie close together are made orthogonal to each other.

Components are numbered from 1 by falling variance; the sign makes a direction's largest
entry positive. Steps 2 to 4 run on the driver on one d x d matrix.

Defined results: a vector that is null or empty, or holds null or non-finite entries, is
left out; of the rest, those with the most common length count (of several, the
longest), others are left out too. Entries beyond +-2^40 / 64 count as that. A deviation
beyond a 64-bit integer is null. Components with a variance of zero (up to rounding),
as with fewer distinct vectors than dimensions, have no whitened form and give no rows;
with no vectors, or equal ones only, there are no rows at all. Repeated rows count and
are returned each time; a null id is kept; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .base import written

SCALE, SHIFT, LARGEST = 64.0, 1_000_000, float(1 << 40)
FAN = 16
EPS = np.finfo(np.float64).eps


def whole_numbers(col: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the vectors of length ``d`` that count, and their x (rows x d, int64)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    length = np.asarray(col.value_lengths().fill_null(-1))
    rows = np.flatnonzero(length == d)
    if not len(rows):
        return rows, np.zeros((0, d), np.int64)
    # null entries of the rows taken become NaN
    flat = col.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    values = flat.reshape(len(rows), d)
    good = np.isfinite(values).all(1)
    scaled = np.clip(np.floor(SCALE * np.clip(values[good], -LARGEST, LARGEST)), -LARGEST, LARGEST)
    return rows[good], scaled.astype(np.int64) + SHIFT


@dataclass
class Centre:
    """Exact mean of the x: ``whole + part / n`` per dimension."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.part = np.array([s % self.n for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.part / self.n

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Exact sum of ``(n x - S)^2``; null where it exceeds 64 bits."""
        about = (self.centred(x) ** 2).sum(1) * float(self.n) ** 2
        with np.errstate(over="ignore"):
            exact = ((self.n * (x - self.whole) - self.part) ** 2).sum(1)
        return pa.array(exact, pa.int64(), mask=about >= 9.2e18)


def triangle(blocks) -> np.ndarray | None:
    """The R of all rows of all blocks, one block at a time."""
    r = None
    for block in blocks:
        if len(block):
            r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
    return r


# -- one d x d matrix on the driver -----------------------------------------


def _reflector(v: np.ndarray) -> tuple[np.ndarray, float]:
    """``w, beta`` with ``(I - beta w w') v`` along the first axis."""
    w, norm = v.copy(), float(np.linalg.norm(v))
    if norm == 0.0:
        return w, 0.0
    w[0] += math.copysign(norm, v[0])
    return w, 2.0 / float(w @ w)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and P, with ``r = Q B P'``."""
    a, d = r.copy(), r.shape[1]
    p = np.eye(d)
    for k in range(d):
        w, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(w, w @ a[k:, k:])
        if k < d - 2:
            w, beta = _reflector(a[k, k + 1:])
            a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ w, w)
            p[:, k + 1:] -= beta * np.outer(p[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _dqds_step(q: list[float], e: list[float], shift: float):
    """One transform; also its smallest d and the sum of 1 / d."""
    out_q, out_e, d = [], [], q[0] - shift
    least, inverse = d, math.inf if d <= 0 else 1 / d
    for i in range(len(e)):
        t = d + e[i]
        ratio = q[i + 1] / t if t else 0.0
        out_q.append(t)
        out_e.append(e[i] * ratio)
        d = (d * ratio if t else q[i + 1]) - shift
        least = min(least, d)
        inverse = math.inf if d <= 0 else inverse + 1 / d
    out_q.append(d)
    return out_q, out_e, least, inverse


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal (a, b), falling."""
    scale = max([*np.abs(a), *np.abs(b), 0.0])
    if scale == 0.0:
        return np.zeros(len(a))
    found: list[float] = []
    blocks = [([float(x / scale) ** 2 for x in a], [float(x / scale) ** 2 for x in b], 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        for _ in range(100 * len(q)):
            # values go off the end; a negligible e inside splits the block
            while e and e[-1] <= EPS * EPS * (moved + q[-1]):
                found.append(moved + q.pop())
                e.pop()
            cut = next((i for i in range(len(e) - 1) if e[i] <= EPS * EPS * (moved + min(q[i], q[i + 1]))),
                       None)
            if cut is not None:
                blocks.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if not e:
                break
            q, e, _, inverse = _dqds_step(q, e, 0.0)
            shift = (1 - 4 * EPS * len(q)) / inverse if inverse < math.inf else 0.0
            while shift > EPS * (moved + min(q)):
                next_q, next_e, least, _ = _dqds_step(q, e, shift)
                if least >= 0.0:
                    q, e, moved = next_q, next_e, moved + shift
                    break
                shift /= 4
        found += [moved + x for x in q]
    return np.sort(np.maximum(found, 0.0))[::-1] * scale ** 2


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Eigenvector of B'B for ``value`` from its twisted factorisation."""
    n = len(a)
    d, lower = a * a, b / a[:-1]
    tiny = np.finfo(np.float64).tiny
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):                                  # stationary, from the top
        pivot = s[i] + d[i] or tiny
        down[i] = lower[i] * d[i] / pivot
        s[i + 1] = down[i] * lower[i] * s[i] - value
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):                          # progressive, from the bottom
        pivot = d[i] * lower[i] ** 2 + p[i + 1] or tiny
        up[i] = lower[i] * d[i] / pivot
        p[i] = p[i + 1] * d[i] / pivot - value
    k = int(np.argmin(np.abs(np.nan_to_num(s + p + value, nan=np.inf))))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    size = np.abs(z).max()
    z = z / size if np.isfinite(size) and size > 0 else np.full(n, 1.0)
    return z / np.linalg.norm(z)


def _inverse_step(a: np.ndarray, b: np.ndarray, value: float, z: np.ndarray) -> np.ndarray:
    """Solve ``(B'B - value) y = z`` by elimination with row exchanges; y has unit length."""
    n = len(a)
    main = a * a
    main[1:] += b * b
    main -= value
    side = a[:-1] * b
    least = EPS * max(np.abs(main).max(), np.abs(side).max() if n > 1 else 0.0) or EPS
    u = np.zeros((n, 3))                                    # rows of the upper factor
    row, y = [main[0], side[0] if n > 1 else 0.0, 0.0], z.copy()
    for i in range(n - 1):
        below = [side[i], main[i + 1], side[i + 1] if i < n - 2 else 0.0]
        if abs(row[0]) >= abs(below[0]):
            pivot = row[0] if abs(row[0]) > least else math.copysign(least, row[0])
            factor, u[i] = below[0] / pivot, (pivot, row[1], row[2])
            row = [below[1] - factor * row[1], below[2] - factor * row[2], 0.0]
            y[i + 1] -= factor * y[i]
        else:
            factor, u[i] = row[0] / below[0], below
            row = [row[1] - factor * below[1], row[2] - factor * below[2], 0.0]
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
    u[-1] = (row[0] if abs(row[0]) > least else math.copysign(least, row[0]), 0.0, 0.0)
    for i in range(n - 1, -1, -1):
        for j in (1, 2):
            if i + j < n:
                y[i] -= u[i, j] * y[i + j]
        y[i] /= u[i, 0]
    return y / np.linalg.norm(y)


def _apart(v: np.ndarray, near: np.ndarray) -> np.ndarray | None:
    """``v`` made orthogonal to ``near``, of unit length; None if nothing is left."""
    for _ in range(3):
        v = v - near @ (near.T @ v)
        size = np.linalg.norm(v)
        if size < 1e-14:
            return None
        v /= size
    return v


def _residual(a: np.ndarray, b: np.ndarray, value: float, v: np.ndarray) -> float:
    """Length of ``(B'B - value) v``."""
    u = a * v
    u[:-1] += b * v[1:]
    w = a * u
    w[1:] += b * u[:-1]
    return float(np.linalg.norm(w - value * v))


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of ``r``, falling, and the first ``most`` right vectors
    (columns) whose values are above rounding."""
    d = r.shape[1]
    if d == 1:
        value = float((r ** 2).sum())
        return np.array([value]), np.ones((1, 1 if value > 0 and most else 0))
    full = np.zeros((d, d))
    full[:len(r)] = r
    a, b, p = bidiagonalise(full)
    values = dqds(a, b)
    above = values > (10 * d * EPS) ** 2 * values[0] if values[0] > 0 else np.zeros(d, bool)
    k = min(int(above.sum()), most)
    if not k:
        return values, np.zeros((d, 0))
    # a zero on the diagonal has no factorisation; rounding level is as good as zero
    floor = EPS * math.sqrt(values[0])
    a = np.where(np.abs(a) < floor, np.where(a < 0, -floor, floor), a)
    z = np.zeros((d, k))
    noise = np.random.default_rng(0)
    for j in range(k):
        close = [i for i in range(j) if values[i] - values[j] <= 1e-3 * values[i]]
        near = z[:, close]
        v = _apart(_twisted(a, b, values[j]), near)
        for _ in range(8):
            # a remainder of the directions found already is no eigenvector: solve again
            if v is not None and _residual(a, b, values[j], v) <= 64 * d * EPS * values[0]:
                break
            start = noise.standard_normal(d) if v is None else v
            v = _apart(_inverse_step(a, b, values[j], start), near)
        z[:, j] = _apart(noise.standard_normal(d), z[:, :j]) if v is None else v
    v = p @ z
    v *= np.sign(v[np.abs(v).argmax(0), np.arange(k)])
    return values, v


# -- the table --------------------------------------------------------------


def _merged(parts: DataFrame, combine, schema: str) -> DataFrame:
    """Merge the rows ``(part, value binary)`` of all tasks, ``FAN`` at a time, into one."""
    def merge(table: pa.Table) -> pa.Table:
        got = combine([np.frombuffer(x, np.float64) for x in table.column("value").to_pylist()])
        return pa.table({"part": table.column("up").slice(0, 1).cast(pa.int64()),
                         "value": pa.array([got.tobytes()], pa.binary())})

    last = parts.agg(F.max("part")).collect()[0][0]
    while last:
        last //= FAN
        parts = parts.withColumn("up", F.floor(F.col("part") / FAN)) \
            .groupBy("up").applyInArrow(merge, schema)
    return parts


@dataclass
class Whitening:
    """A fitted transform: centre, directions scaled to unit variance, and what they explain."""

    centre: Centre
    axes: np.ndarray            # d x k
    explained: np.ndarray       # k
    identity_error: float


def dimension(vectors: DataFrame, vec: str) -> int:
    """The most common length of the vectors (the longest of several); 0 without any."""
    top = vectors.where(F.col(vec).isNotNull()).groupBy(F.size(vec).alias("d")).count() \
        .orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    return top[0]["d"] if top else 0


def fit(vectors: DataFrame, vec: str = "embedding", components: int = 32) -> Whitening | None:
    """Learn the transform from all vectors; None if nothing varies."""
    d = dimension(vectors, vec)
    if not d:
        return None
    only = vectors.select(F.col(vec).alias("vec"))

    def total(batches):
        n, sums = 0, np.zeros(d, np.int64)
        for batch in batches:
            _, x = whole_numbers(batch.column(0), d)
            n, sums = n + len(x), sums + x.sum(0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, d), pa.int32()), pa.array(np.append(n, sums), pa.int64())],
                names=["at", "s"])

    sums = {r["at"]: r["s"] for r in only.mapInArrow(total, "at int, s long")
            .groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    if not sums:
        return None
    centre = Centre(int(sums[-1]), [int(sums[i]) for i in range(d)])

    def rows_of(batches):
        return (centre.centred(whole_numbers(batch.column(0), d)[1]) for batch in batches)

    def one(value: np.ndarray | None):
        if value is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()),
                 pa.array([value.tobytes()], pa.binary())], names=["part", "value"])

    schema = "part long, value binary"
    parts = written(only.mapInArrow(lambda batches: one(triangle(rows_of(batches))), schema),
                    "whitening-r")
    r = _merged(parts, lambda rs: triangle([x.reshape(-1, d) for x in rs]), schema).collect()
    values, v = directions(np.frombuffer(r[0]["value"], np.float64).reshape(-1, d), components)
    k = v.shape[1]
    if not k:
        return None
    variance = values / centre.n
    axes = v / np.sqrt(variance[:k])

    def moments(batches):
        got = np.zeros((k + 1, k))
        for z in rows_of(batches):
            w = z @ axes
            got[0] += w.sum(0)
            got[1:] += w.T @ w
        return one(got)

    parts = written(only.mapInArrow(moments, schema), "whitening-moments")
    m = _merged(parts, sum, schema).collect()
    m = np.frombuffer(m[0]["value"], np.float64).reshape(k + 1, k) / centre.n
    error = float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(k)).max())
    return Whitening(centre, axes, variance[:k] / variance.sum(), error)


def transform(vectors: DataFrame, model: Whitening | None, vec_id: str = "vec_id",
              vec: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per vector
    and component."""
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)

    def run(batches):
        d, k = model.axes.shape
        for batch in batches:
            rows, x = whole_numbers(batch.column(1), d)
            if not len(rows):
                continue
            each = pa.array(np.repeat(np.arange(len(rows)), k))
            total = len(rows) * k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)).take(each),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                 pa.array(np.full(total, model.centre.n), pa.int64()),
                 model.centre.deviation(x).take(each),
                 pa.array((model.centre.centred(x) @ model.axes).reshape(-1)),
                 pa.array(np.tile(model.explained, len(rows))),
                 pa.array(np.full(total, model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                       "identity_error"])

    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec).alias("vec")) \
        .mapInArrow(run, schema)
