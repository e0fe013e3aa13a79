"""Embedding whitening through a bidiagonal qd solver.

*Data passes* (Spark). Vectors become integers x = floor(scale * c) + offset, written once. Count and sums per dimension
are exact. Each task reduces its centred rows, batch by batch, to one triangular factor R (blockwise QR); the factors
are reduced FAN at a time, so that the driver sees FAN of them at most, each dims x dims, whatever the number of rows.
The covariance is never formed: V = R'R / n.

*Solver* (driver, dims x dims). Householder reflections bring R to upper bidiagonal form, dqds finds its singular
values, and for each wanted one a twisted factorisation of B'B - s I, by the differential qd transforms from both
ends, gives the singular vector; vectors of values that lie close together are made orthogonal among themselves and
turned to the Ritz vectors of their span. The reflections carry the vectors back to directions of x.

*Results.* Every row is projected on the first directions and divided by the standard deviation. The covariance of the
result over all rows is measured by another pass (count, mean and centred products of each task, merged pairwise).

Results for odd input: a null vector or one with a null or non-finite component is left out; vectors of another length
than the most frequent one (of equals the longer) share no directions with it: they are not in the fit and have no
rows; a null id is an id; repeated rows count each and have rows each; directions in which the vectors do not vary
(equal vectors, fewer rows than dimensions) cannot be brought to variance one and are no components; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.centroids import integer_vectors
from basketflow.llm.common import Stages

# The passes run in Python workers: ship them by value, so that the workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
FAN = 32
MAX_DIMS = 4_096  # the driver and a task of the reduction hold FAN factors of dims x dims
EPS = np.finfo(float).eps


# ---------------------------------------------------------------- the solver: dims x dims

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and W of R = U B W', by Householder reflections."""
    m = np.array(r, float)
    d = m.shape[0]
    w = np.eye(d)

    def reflector(v):
        v = v.copy()
        norm = np.linalg.norm(v)
        if norm == 0.0:
            return None
        v[0] += math.copysign(norm, v[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        u = reflector(m[k:, k])
        if u is not None:
            m[k:, k:] -= 2.0 * np.outer(u, u @ m[k:, k:])
        if k + 2 < d:
            u = reflector(m[k, k + 1:])
            if u is not None:
                m[k:, k + 1:] -= 2.0 * np.outer(m[k:, k + 1:] @ u, u)
                w[:, k + 1:] -= 2.0 * np.outer(w[:, k + 1:] @ u, u)
    return np.diag(m).copy(), np.diag(m, 1).copy(), w


def _pieces(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Ranges [i, j) between negligible superdiagonals."""
    size = EPS * (max(np.abs(a).max(), np.abs(b).max() if len(b) else 0.0) if len(a) else 0.0)
    cuts = [i + 1 for i in range(len(b)) if abs(b[i]) <= max(EPS * min(abs(a[i]), abs(a[i + 1])), size * EPS)]
    edges = [0, *cuts, len(a)]
    return list(zip(edges, edges[1:]))


def _sweep(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform with shift s; None where the shift was beyond the smallest value."""
    n = len(q)
    nq, ne = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - s
    for i in range(n - 1):
        if d < 0.0:
            return None
        nq[i] = d + e[i]
        if nq[i] == 0.0:
            ne[i], d = 0.0, q[i + 1] - s
        else:
            t = q[i + 1] / nq[i]
            ne[i], d = e[i] * t, d * t - s
    if d < 0.0:
        return None
    nq[n - 1] = d
    return nq, ne


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squared singular values of the bidiagonal (a, b), largest first."""
    out: list[float] = []
    todo = [([float(x) ** 2 for x in a[i:j]], [float(x) ** 2 for x in b[i:j - 1]], 0.0) for i, j in _pieces(a, b)]
    tiny = (16 * EPS) ** 2
    while todo:
        q, e, shift = todo.pop()
        for turn in range(60 * len(q) + 60):
            n = len(q)
            if n == 0:
                break
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= tiny * (shift + min(q[i], q[i + 1])) or e[i] == 0.0), None)
            if n == 1 or cut == n - 2:
                out.append(shift + q[-1])
                q, e = q[:-1], e[:-1]
                continue
            if cut is not None:
                todo.append((q[cut + 1:], e[cut + 1:], shift))
                q, e = q[:cut + 1], e[:cut]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            # The smaller value of the last 2 x 2, less its tie to the rest: rarely beyond the smallest value.
            x, y, z = q[-2] + (e[-2] if n > 2 else 0.0), q[-2] * e[-1], q[-1] + e[-1]
            half = (x - z) / 2.0
            low = z - y / (half + math.copysign(math.sqrt(half * half + y), half)) if half or y else z
            s = max(0.0, min(low, q[-1])) * (1.0 - 4 * EPS)
            done = None
            for s in (s, 0.5 * s, 0.0625 * s, 0.0):
                done = _sweep(q, e, s)
                if done is not None:
                    break
            if done is None:  # a zero shift never leaves the positive values but by rounding
                raise ArithmeticError("dqds lost positivity")
            q, e = done
            shift += s
        else:
            raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(out))[::-1]


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float, choice: int = 0) -> np.ndarray:
    """The unit vector z of B'B z = value z, from the twisted factorisation with the (choice + 1)-th smallest pivot."""
    n = len(a)
    floor = EPS * EPS * max(float(np.max(a * a)), value, 1e-300)
    safe = lambda x: x if abs(x) > floor else math.copysign(floor, x)
    upper, lower = [0.0] * n, [0.0] * n  # L+ and U- of the two factorisations
    s, p = [0.0] * n, [0.0] * n
    s[0] = -value
    for i in range(n - 1):
        pivot = safe(a[i] * a[i] + s[i])
        lower[i] = a[i] * b[i] / pivot
        s[i + 1] = b[i] * b[i] * s[i] / pivot - value
    p[n - 1] = a[n - 1] * a[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = safe(b[i] * b[i] + p[i + 1])
        upper[i] = a[i] * b[i] / pivot
        p[i] = p[i + 1] * a[i] * a[i] / pivot - value
    gamma = np.abs(np.array(s) + np.array(p) + value)
    r = int(np.argsort(gamma, kind="stable")[min(choice, n - 1)])
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -upper[i] * z[i]
        if abs(z[i + 1]) > 1e100:
            z /= abs(z[i + 1])
    top = np.abs(z).max()
    return (z / top) / np.linalg.norm(z / top)


def _vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal columns for ``values`` (falling) of one piece."""
    n = len(a)
    t = np.diag(a * a + np.concatenate([[0.0], b * b])) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    out = np.zeros((n, len(values)))
    start = 0
    for k in range(len(values)):
        if k and values[k - 1] - values[k] > 1e-3 * values[k - 1]:
            start = k
        for choice in range(n):
            z = twisted_vector(a, b, values[k], choice)
            for _ in range(2):
                z = z - out[:, start:k] @ (out[:, start:k].T @ z)
                size = np.linalg.norm(z)
                if size < 1e-8:
                    break
                z = z / size
            if size >= 1e-8:
                break
        out[:, k] = z
        last = k + 1 == len(values) or values[k] - values[k + 1] > 1e-3 * values[k]
        if last and k > start:  # close values: the Ritz vectors of their span
            basis, _ = np.linalg.qr(out[:, start:k + 1])
            ritz, turn = np.linalg.eigh(basis.T @ t @ basis)
            out[:, start:k + 1] = basis @ turn[:, np.argsort(-ritz, kind="stable")]
    return out


def directions(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Squared singular values (falling, at most ``components`` and none that is zero by rounding), their right singular
    vectors as columns, and the sum of all squared singular values."""
    d = r.shape[0]
    scale = np.abs(r).max() if r.size else 0.0
    if not scale:
        return np.zeros(0), np.zeros((d, 0)), 0.0
    a, b, w = bidiagonalise(r / scale)
    found: list[tuple[float, int, int]] = []
    pieces = _pieces(a, b)
    parts = [dqds(a[i:j], b[i:j - 1]) for i, j in pieces]
    for at, values in enumerate(parts):
        found += [(v, at, k) for k, v in enumerate(values)]
    found.sort(key=lambda x: (-x[0], x[1], x[2]))
    floor = (64 * d * EPS) ** 2 * found[0][0]
    wanted = [x for x in found[:components] if x[0] > floor]
    z = np.zeros((d, len(wanted)))
    for at, (i, j) in enumerate(pieces):
        mine = [c for c, x in enumerate(wanted) if x[1] == at]
        if mine:
            z[i:j, mine] = _vectors(a[i:j], b[i:j - 1], np.array([wanted[c][0] for c in mine]))
    v = w @ z
    sign = np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])]) if v.size else np.ones(0)
    total = float(sum(x[0] for x in found))
    return np.array([x[0] for x in wanted]) * scale ** 2, v * sign, total * scale ** 2


# ---------------------------------------------------------------- the passes over the rows

def _rows(column, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims)


def _centre(x: np.ndarray, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    """x - S / n for integers x: the whole part of the mean goes exactly."""
    return (x - whole).astype(float) - part


def _sums(dims: int):
    def run(batches):
        n, total = 0, np.zeros(dims, np.int64)
        for batch in batches:
            x = _rows(batch.column(0), dims)
            n += len(x)
            total += x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n", "s"])
    return run


def _square(r: np.ndarray, dims: int) -> np.ndarray:
    out = np.zeros((dims, dims))
    out[:r.shape[0]] = r
    return out


def _factor(dims: int, whole: np.ndarray, part: np.ndarray):
    """One triangular factor of the centred rows of a task."""
    def run(batches):
        from pyspark import TaskContext
        r = None
        for batch in batches:
            if batch.num_rows:
                x = _centre(_rows(batch.column(0), dims), whole, part)
                r = np.linalg.qr(x if r is None else np.vstack([r, x]), mode="r")
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_square(r, dims).ravel().tolist()])], names=["part", "m"])
    return run


def _joined_factor(dims: int):
    def run(table):
        stacked = np.vstack([_rows(column, dims * dims).reshape(-1, dims) for column in table.column("m").chunks])
        r = np.linalg.qr(stacked, mode="r")
        return pa.table({"part": pa.array([table.column("part")[0].as_py() // FAN], pa.int64()), "m": pa.array([_square(r, dims).ravel().tolist()])})
    return run


def _moments(dims: int, project):
    """(part, m): count, mean and centred products of a task's projected rows, as one array."""
    def run(batches):
        from pyspark import TaskContext
        state = None
        for batch in batches:
            if batch.num_rows:
                y = project(_rows(batch.column(0), dims))
                mean = y.mean(axis=0)
                new = (float(len(y)), mean, (y - mean).T @ (y - mean))
                state = new if state is None else _merge(state, new)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_flat(state)])], names=["part", "m"])
    return run


def _flat(state) -> list[float]:
    return [state[0], *state[1].tolist(), *state[2].ravel().tolist()]


def _state(values, k: int):
    v = np.asarray(values)
    return float(v[0]), v[1:1 + k], v[1 + k:].reshape(k, k)


def _merge(a, b):
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def _joined_moments(k: int):
    def run(table):
        state = None
        for values in table.column("m").to_pylist():
            state = _state(values, k) if state is None else _merge(state, _state(values, k))
        return pa.table({"part": pa.array([table.column("part")[0].as_py() // FAN], pa.int64()), "m": pa.array([_flat(state)])})
    return run


def _reduce(parts: DataFrame, join, stages: Stages, name: str) -> list:
    """The rows (part, m) reduced FAN at a time until at most FAN are left, which reach the driver."""
    parts = stages.write(parts, f"{name}-0")
    turn = 0
    while parts.count() > FAN:
        # Numbers without gaps, so that a round takes FAN rows together; one row per task of the pass before.
        turn += 1
        parts = stages.write(parts.groupBy(F.floor(F.col("part") / FAN).alias("group")).applyInArrow(join, "part long, m array<double>"), f"{name}-{turn}")
    return [r.m for r in parts.orderBy("part").collect()]


def whiten(vectors: DataFrame, stages: Stages, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET,
           vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n, deviation decimal, whitened array, explained array, identity_error) of every row of the fit.

    ``deviation`` is the sum over dimensions of (n x - S)^2, exact.
    """
    spark = vectors.sparkSession
    x = integer_vectors(vectors, None, scale, vec_id, vector)
    x = stages.write(x.select("vec_id", F.transform("x", lambda c: c + offset).alias("x")), "x")
    none = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    dims = x.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if dims is None or not dims.dims:
        return spark.createDataFrame([], none)
    dims = dims.dims
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} components; at most {MAX_DIMS}")
    x = x.where(F.size("x") == dims)
    only = x.select("x")

    parts = only.mapInArrow(_sums(dims), "n long, s array<bigint>")
    sums = parts.select("n", F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows = sums.orderBy("i").collect()  # one row per dimension
    n, total = rows[0].n, [int(r.s) for r in rows]
    whole = np.array([s // n for s in total], np.int64)
    part = np.array([(s % n) / n for s in total])

    factors = _reduce(only.mapInArrow(_factor(dims, whole, part), "part long, m array<double>"), _joined_factor(dims), stages, "r")
    r = np.linalg.qr(np.vstack([np.asarray(f).reshape(dims, dims) for f in factors]), mode="r")
    squares, axes, trace = directions(_square(r, dims), components)
    k = len(squares)
    if not k:
        return spark.createDataFrame([], none)
    values = squares / n
    turn = axes / np.sqrt(values)
    explained = (squares / trace).tolist()

    def project(rows):
        return _centre(rows, whole, part) @ turn

    state = None
    for m in _reduce(only.mapInArrow(_moments(dims, project), "part long, m array<double>"), _joined_moments(k), stages, "moments"):
        state = _state(m, k) if state is None else _merge(state, _state(m, k))
    error = float(np.abs(state[2] / n - np.eye(k)).max())

    def deviation(rows):
        y = rows - whole
        # n x - S = n (x - whole) - (S mod n), in machine integers where they hold it.
        rest = np.array([s % n for s in total], np.int64)
        high = (int(np.abs(y).max()) + 1) * n
        if high * high * dims >= 2 ** 63:
            y, rest = y.astype(object), rest.astype(object)
        y = y * n - rest
        return (y * y).sum(axis=1)

    def emit(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _rows(batch.column(1), dims)
            y = project(rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, y.size + 1, k, dtype="int32")), pa.array(y.ravel()))
            dev = [str(v) for v in deviation(rows).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dev), lists], names=["vec_id", "deviation", "whitened"])

    out = x.select("vec_id", "x").mapInArrow(emit, "vec_id long, deviation string, whitened array<double>")
    return out.select("vec_id", F.lit(n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened",
                      F.array(*map(F.lit, explained)).alias("explained"), F.lit(error).alias("identity_error"))
