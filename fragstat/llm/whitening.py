"""Whitening of embeddings by a bidiagonal qd solver.

Vectors are put on an integer grid, so that counts, sums and deviations are
exact.  The *fit list* is each distinct grid vector once; its covariance V is
never formed:

1. *Blockwise QR.*  Each task centres its part of the fit list and reduces it,
   block by block, to a triangle R; triangles are stacked and reduced again,
   ``FAN`` at a time, until one is left.  ``R'R`` is n times the covariance.
2. *Householder* reflections from both sides bring R to bidiagonal form B.
3. *dqds* (differential quotient-difference with shifts) finds the singular
   values of B, each to high relative accuracy.
4. *Twisted factorisations* of ``B'B - lambda`` give the direction of each
   component: stationary and progressive factors meet where the pivot is
   smallest, and two short products give the vector.  It is reflected back.

Steps 2 to 4 handle one triangle as large as the square of the vectors' length,
whatever the number of rows; the driver holds that and one row of sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragstat.config import scratch_path

#: Grid steps in a unit of a vector's entries.
GRID = 256
#: Rows that are reduced at once.
BLOCK_ROWS = 4096
#: Triangles that are stacked in one task.
FAN = 16
#: Grid entries at or beyond this bound do not fit a long.
_TOO_LARGE = float(1 << 63)
_EPS = np.finfo(float).eps
#: An off-diagonal entry of this share splits a qd array; its effect is of second order.
_NEGLIGIBLE = (10 * _EPS) ** 2


@dataclass(frozen=True)
class Whitening:
    """``n`` fitted vectors with exact sums; components by falling eigenvalue."""
    n: int
    sums: tuple[int, ...]
    directions: np.ndarray  # one unit eigenvector a row
    eigenvalues: np.ndarray
    trace: float


# --- dense solver for one triangle ----------------------------------------------------

def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit v such that x - 2 v (v.x) has zeros behind its first entry."""
    size = np.linalg.norm(x)
    if not np.any(x[1:]):
        return None
    v = x / size
    v[0] += math.copysign(1.0, v[0])
    return v / np.linalg.norm(v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(diagonal, superdiagonal, p)`` of B with ``r = u B p'`` for orthogonal u, p."""
    a, n = np.array(r, float), len(r)
    p = np.eye(n)
    for k in range(n):
        v = _reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < n:
            v = _reflector(a[k, k + 1:])
            if v is not None:
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
                p[:, k + 1:] -= 2 * np.outer(p[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One dqds transform; the third value is the smallest d (negative: the
    shift was too large, and nothing is usable but a late last d)."""
    new_q, new_e = [], []
    d = least = q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return [], [], d
        total = d + e[k]
        ratio = q[k + 1] / total if total > 0 else 0.0
        new_q.append(total)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift if total > 0 else q[k + 1] - shift
        least = min(least, d)
    new_q.append(d)
    return new_q, new_e, least


def _guess(q: list[float], e: list[float]) -> float:
    """A shift from the last two rows: their smaller eigenvalue less its residual."""
    a, b, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), math.sqrt(q[-2] * e[-1]), q[-1] + e[-1]
    if b == 0:
        return min(a, c)
    half = (a - c) / 2
    root = math.hypot(half, b)
    low = (q[-2] * q[-1] + (e[-2] * c if len(e) > 1 else 0.0)) / ((a + c) / 2 + root)
    part = b / math.hypot(b, low - a)  # of the eigenvector, at the upper of the two rows
    above = math.sqrt(q[-3] * e[-2]) if len(e) > 1 else 0.0
    return max(0.0, low - above * part)


def singular_values_squared(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squares of the singular values of an upper bidiagonal, falling, by dqds.

    Values that nearly agree make shifts of zero useless, as the ratio of neighbours is
    the rate then.  So an array that does not end gets a quarter of the smallest d, an
    upper bound for the smallest value, at least, and a shift that is too large is divided
    until it holds: each transform takes off a share of the smallest value.
    """
    found: list[float] = []
    blocks = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        if len(q) > 1 and q[0] < q[-1]:  # small values belong to the end
            q, e = q[::-1], e[::-1]
        shift, left, stalled = 0.0, (most := 60 * len(q) + 100), False
        while q:
            if len(q) == 1:
                found.append(sigma + max(q[0], 0.0))
                break
            cut = next((k for k in range(len(e) - 1, -1, -1)
                        if e[k] <= _NEGLIGIBLE * (sigma + min(q[k], q[k + 1]))), None)
            if cut is not None:
                blocks.append((q[:cut + 1], e[:cut], sigma))
                q, e, shift = q[cut + 1:], e[cut + 1:], 0.0
                continue
            left -= 1
            if left < 0:
                if stalled:
                    raise ArithmeticError("the qd iteration does not converge")
                left, stalled = most, True
            new_q, new_e, least = _qd_step(q, e, shift)
            if least < 0 and shift:
                late = bool(new_q) and all(x >= 0 for x in new_q[:-1])
                new_q, new_e, least = _qd_step(q, e, retry) if late and (retry := shift + new_q[-1]) > 0 else ([], [], -1.0)
                shift = retry if late and retry > 0 else shift
                while least < 0 and stalled and shift > _EPS * (sigma + shift):
                    shift /= 4
                    new_q, new_e, least = _qd_step(q, e, shift)
                if least < 0:
                    shift = 0.0
                    new_q, new_e, least = _qd_step(q, e, 0.0)
            q, e, sigma = new_q, new_e, sigma + shift
            shift = max(_guess(q, e), least / 4 if stalled else 0.0)
    return np.array(sorted(found, reverse=True))


def _twisted(d: np.ndarray, ratio: np.ndarray, value: float, tiny: float):
    """Factors of ``L D L' - value``: from above (pivots, multipliers), from
    below (pivots, multipliers), and the pivot of each twist."""
    n = len(d)
    above, down = np.empty(n), np.empty(max(n - 1, 0))
    below, up = np.empty(n), np.empty(max(n - 1, 0))
    s = np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        above[i] = s[i] + d[i] or tiny
        down[i] = d[i] * ratio[i] / above[i]
        s[i + 1] = down[i] * ratio[i] * s[i] - value
    above[n - 1] = s[n - 1] + d[n - 1] or tiny
    p = np.empty(n)
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        below[i + 1] = d[i] * ratio[i] ** 2 + p[i + 1] or tiny
        t = d[i] / below[i + 1]
        up[i] = ratio[i] * t
        p[i] = p[i + 1] * t - value
    below[0] = p[0] or tiny
    return above, down, below, up, s + p + value


def _direction(d: np.ndarray, ratio: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """The unit eigenvector of ``L D L'`` at ``value``, orthogonal to ``others``
    (those of eigenvalues so near that factors alone cannot tell them apart)."""
    n = len(d)
    above, down, below, up, twist = _twisted(d, ratio, value, _EPS * value or np.finfo(float).tiny)
    k = int(np.argmin(np.abs(twist)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    z /= np.linalg.norm(z)
    if not others:
        return z
    for attempt in range(1, 9):
        free = z - sum((o * (o @ z) for o in others), np.zeros(n))
        size = np.linalg.norm(free)
        if size > 0.5:
            z = free / size
            return (z := z - sum((o * (o @ z) for o in others), np.zeros(n))) / np.linalg.norm(z)
        if size < 1e-6:  # the same vector once more: begin elsewhere
            free = np.cos(np.arange(1, n + 1) * (attempt + 0.5))
            free -= sum((o * (o @ free) for o in others), np.zeros(n))
        y = free / np.linalg.norm(free)  # a step of inverse iteration through the factors from above
        for i in range(n - 1):
            y[i + 1] -= down[i] * y[i]
        y /= above
        for i in range(n - 2, -1, -1):
            y[i] -= down[i] * y[i + 1]
        z = y / np.linalg.norm(y)
    free = z - sum((o * (o @ z) for o in others), np.zeros(n))
    return free / np.linalg.norm(free)


def principal_directions(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of ``r'r`` (as many as are not zero, at most
    ``components``) and their unit eigenvectors, one a row."""
    scale = float(np.max(np.abs(r))) if r.size else 0.0
    if scale == 0:
        return np.zeros(0), np.zeros((0, len(r)))
    diagonal, above, p = bidiagonal(r / scale)
    # Where B falls into blocks, each has eigenvalues of its own; only then can some be equal.
    cuts = np.flatnonzero(np.abs(above) <= _EPS * np.max(np.abs(diagonal))) + 1
    blocks = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(diagonal)]))
    found = sorted(((float(v), k) for k, (i, j) in enumerate(blocks)
                    for v in singular_values_squared(diagonal[i:j], above[i:j - 1])), key=lambda x: (-x[0], x[1]))
    found = [x for x in found if x[0] > found[0][0] * (len(diagonal) * _EPS) ** 2][:components]
    vectors = np.zeros((len(found), len(diagonal)))
    for number, (value, k) in enumerate(found):
        i, j = blocks[k]
        near = [vectors[m, i:j] for m in range(number) if found[m][1] == k and found[m][0] - value <= 1e-5 * value]
        a = np.where(np.abs(diagonal[i:j]) < _EPS ** 2, _EPS ** 2, diagonal[i:j])
        vectors[number, i:j] = _direction(a ** 2, above[i:j - 1] / a[:-1], value, near)
    values = np.array([v for v, _ in found])
    turned = np.array([p @ z for z in vectors])
    sign = np.sign(turned[np.arange(len(turned)), np.argmax(np.abs(turned), axis=1)])
    return values * scale ** 2, turned * sign[:, None]


# --- Spark side ----------------------------------------------------------------------------

def on_grid(vector: Column | str, grid: int = GRID) -> Column:
    """``floor(grid * c)`` of each entry as a long; null for vectors that are
    null or empty, or hold an entry that is null, not finite or beyond a long."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    scaled = F.transform(vector, lambda c: F.lit(float(grid)) * c.cast("double"))
    sound = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_TOO_LARGE)))
    return F.when((F.size(vector) > 0) & sound, F.transform(scaled, lambda c: F.floor(c).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long, whole lists as a matrix of longs."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _exact_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """How many vectors, and the sum of each entry, exactly."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, high, low = 0, 0, 0
        for batch in batches:
            x = _matrix(batch.column("x"))
            rows, high, low = rows + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(high))), pa.array([rows] * len(high)), pa.array(high), pa.array(low)],
                ["entry", "n", "high", "low"])

    sums = fit.mapInArrow(add, "entry long, n long, high long, low long").groupBy("entry").agg(
        *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "high", "low")]).orderBy("entry").collect()
    return (int(sums[0].n) if sums else 0), [(int(r.high) << 32) + int(r.low) for r in sums]


def _centred(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return x.astype(float) - mean


def _triangle(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def _reduced(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """The triangle R of the centred fit list."""
    width = len(mean)

    def reduce_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, held = np.zeros((0, width)), []
        for batch in batches:
            x = _matrix(batch.column("x"))
            for at in range(0, len(x), BLOCK_ROWS):
                held.append(_centred(x[at:at + BLOCK_ROWS], mean))
                if sum(map(len, held)) >= BLOCK_ROWS:
                    r, held = _triangle([r, *held]), []
        if held:
            r = _triangle([r, *held])
        if len(r):
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])

    def stack(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("part").to_numpy())  # the same order in every attempt
        r = _triangle([np.frombuffer(group.column("r")[int(k)].as_py()).reshape(-1, width) for k in order])
        return pa.table({"part": pa.array([group.column("part")[0].as_py() // FAN], pa.int64()),
                         "r": pa.array([r.tobytes()], pa.binary())})

    parts = max(fit.rdd.getNumPartitions(), 1)
    triangles = fit.mapInArrow(reduce_part, "part long, r binary")
    while parts > 1:
        triangles = triangles.groupBy(F.expr(f"part div {FAN}").alias("place")).applyInArrow(
            lambda group: stack(group), "part long, r binary")
        parts = -(-parts // FAN)
    last = triangles.collect()
    blocks = [np.frombuffer(row.r).reshape(-1, width) for row in last]
    r = _triangle([*blocks, np.zeros((width, width))]) if blocks else np.zeros((width, width))
    return r[:width]


def _write_fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct grid vector once, in the shared folder; a vector that very
    many rows have is combined before it is shuffled."""
    path = scratch_path(rows.sparkSession, "fit-list")
    rows.select("x").distinct().write.parquet(path)
    return rows.sparkSession.read.schema("x array<bigint>").parquet(path)


def _sound_rows(vectors: DataFrame, id_col: str, vec_col: str, grid: int) -> DataFrame:
    rows = vectors.select(F.col(id_col).alias("_id"), on_grid(vec_col, grid).alias("x")).where("x IS NOT NULL")
    lengths = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(2).collect()
    return rows.where(F.size("x") == lengths[0]["size"]) if len(lengths) > 1 else rows


def fit_whitening(fit: DataFrame, components: int) -> Whitening:
    """The model of a fit list (``x array<bigint>``, each vector once)."""
    n, sums = _exact_sums(fit)
    if not n:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0)
    r = _reduced(fit, np.array([s / n for s in sums]))
    values, directions = principal_directions(r, components)
    return Whitening(n, tuple(sums), directions, values / n, float(np.sum(r * r)) / n)


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    mean = np.array([s / model.n for s in model.sums])
    return _centred(x, mean) @ (model.directions / np.sqrt(model.eigenvalues)[:, None]).T


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened fit list's covariance minus the
    identity; null without components."""
    k = len(model.eigenvalues)
    if not k:
        return None

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            w = _whitened(_matrix(batch.column("x")), model) if batch.num_rows else np.zeros((0, k))
            total += np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["entry", "total"])

    sums = fit.mapInArrow(moments, "entry long, total double").groupBy("entry").agg(F.sum("total")).orderBy("entry").collect()
    total = np.array([row[1] for row in sums]) / model.n
    mean, square = total[:k], total[k:].reshape(k, k)
    return float(np.max(np.abs(square - np.outer(mean, mean) - np.eye(k))))


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum of ``(n x - S) ** 2``, exactly; null where that does not fit a long."""
    largest = model.n * int(np.abs(x).max()) + max(map(abs, model.sums)) if x.size else 0
    if largest ** 2 * max(len(model.sums), 1) < 1 << 63:
        gap = model.n * x - np.array(model.sums, np.int64)
        return (gap * gap).sum(axis=1).tolist()
    exact = [sum((model.n * c - s) ** 2 for c, s in zip(row, model.sums)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 4,
           grid: int = GRID) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``:
    a row for each sound row of ``vectors`` and component.

    A row is sound if its vector is not null or empty, all entries are numbers
    that are finite and fit the grid (``floor(grid * c)`` as a long), and it has
    the commonest length of such vectors (of two as common, the larger).  Other rows
    give nothing.  Rows that repeat, or have a null id, count and come back like
    any other; the fit list has each grid vector once.  There are no more components
    than directions in which the fit list varies (none for a single vector, so no rows
    then), and none for an empty table.  ``deviation`` is null where it does not fit a
    long.  Components have either sign, with the entry of largest size positive.
    Other columns are not read.
    """
    rows = _sound_rows(vectors, id_col, vec_col, grid)
    fit = _write_fit_list(rows)
    model = fit_whitening(fit, components)
    error = identity_error(fit, model)
    k = len(model.eigenvalues)
    shares = (model.eigenvalues / model.trace).tolist() if k else []

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch.column("x"))
            rows, each = np.repeat(np.arange(len(x)), k), np.tile(np.arange(k), len(x))
            yield pa.RecordBatch.from_arrays([
                batch.column("_id").take(pa.array(rows)), pa.array(each + 1, pa.int32()),
                pa.array(np.full(len(rows), model.n)), pa.array(_deviations(x, model), pa.int64()).take(pa.array(rows)),
                pa.array(_whitened(x, model).ravel()), pa.array(np.array(shares)[each]),
                pa.array(np.full(len(rows), error))],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = T.StructType([
        T.StructField(id_col, vectors.schema[id_col].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]])
    return rows.mapInArrow(apply, schema)
