"""Embedding whitening through a bidiagonal qd solver.

Vectors are put on an integer grid, and each distinct grid vector is fitted
once.  Their centred rows are reduced to one triangle by blockwise QR: a task
folds its rows into a triangle, and triangles are folded in a tree.
Householder reflections make the triangle bidiagonal, differential qd sweeps
with shifts (dqds) give its singular values to high relative accuracy, and
twisted factorisations of the bidiagonal's square give the directions, which
the reflections carry back.  No covariance matrix is formed on the way, so
small variances keep their digits.

The driver holds triangles and directions alone, d by d for vectors of length
d.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrecon.llm.common import BATCH_BYTES, cut, rows_of

SCALE, ORIGIN, COMPONENTS = 64, 1_000_000, 16
#: Triangles that a task folds into one.
FAN_IN = 32
#: Rows that are folded into a triangle at once, in multiples of their length.
_BLOCK = 8
_EPS = np.finfo(float).eps


# -- the bidiagonal solver

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U' r V for a square ``r``, and V."""
    b, d = np.array(r, dtype=float), len(r)
    v = np.eye(d)
    for k in range(d):
        _reflect(b[k:, k:], None)
        if k + 2 < d:
            _reflect(b[k:, k + 1:].T, v[:, k + 1:].T)
    return np.diagonal(b).copy(), np.diagonal(b, 1).copy(), v


def _reflect(a: np.ndarray, also: np.ndarray | None) -> None:
    """Reflect the rows of ``a`` (and of ``also``) so that its first column
    is zero below the top."""
    x = a[:, 0].copy()
    scale = np.abs(x).max()
    if scale == 0:
        return
    x /= scale
    norm = math.sqrt(x @ x)
    x[0] += math.copysign(norm, x[0])
    x /= math.sqrt(x @ x)
    for m in (a, also):
        if m is not None:
            m -= np.outer(2 * x, x @ m)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The singular values of an upper bidiagonal matrix, largest first."""
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if scale == 0:
        return np.zeros(len(diagonal))
    out, work = [], [((np.asarray(diagonal) / scale) ** 2, (np.asarray(above) / scale) ** 2, 0.0)]
    while work:
        q, e, shift = work.pop()
        q, e = q.tolist(), e.tolist()
        while len(q) > 1:
            # a coupling that changes no value to working accuracy is cut
            weak = next((i for i in reversed(range(len(e)))
                         if e[i] <= _EPS * _EPS * (shift + q[i + 1]) or e[i] <= _EPS * _EPS * q[i]), None)
            if weak is not None:
                if weak < len(e) - 1:
                    work.append((np.array(q[:weak + 1]), np.array(e[:weak]), shift))
                    q, e = q[weak + 1:], e[weak + 1:]
                    continue
                out.append(shift + q.pop())
                e.pop()
                continue
            if q[0] < q[-1]:  # sweeps carry small values to the end
                q, e = q[::-1], e[::-1]
                continue
            s = _below(q, e)
            while True:
                swept = _sweep(q, e, s)
                if swept is not None:
                    break
                s = s / 2 if s > _EPS * (shift + q[-1]) else 0.0
            q, e = swept
            shift += s
        out += [shift + x for x in q]
    return scale * np.sqrt(np.sort(out)[::-1])


def _below(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest squared singular value: one over the
    trace of the inverse, which is summed without a subtraction."""
    if min(q) <= 0:
        return 0.0
    row = total = 1 / q[-1]
    for i in range(len(e) - 1, -1, -1):
        row = (1 + e[i] * row) / q[i]
        total += row
        if not math.isfinite(total):
            return 0.0
    return (1 - 4 * _EPS) / total


def _sweep(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float]] | None:
    """One dqds step with shift ``s``; None if the shift was too large."""
    d, new_q, new_e = q[0] - s, [], []
    for i in range(len(e)):
        if d < 0:
            return None
        top = d + e[i]
        new_q.append(top)
        ratio = q[i + 1] / top if top > 0 else 0.0
        new_e.append(e[i] * ratio)
        d = d * ratio - s if top > 0 else q[i + 1] - s
    if d < 0:
        return None
    return [*new_q, d], new_e


def twisted(q: np.ndarray, e: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of L D L' for the eigenvalue ``value``, where D
    is ``q`` and the square of L's subdiagonal times D is ``e``: forward and
    backward differential qd transforms meet where the twist's pivot is
    smallest, and the vector is read from there both ways without a solve."""
    n, tiny = len(q), _EPS * _EPS * (abs(value) + q.max())
    l = np.sqrt(e / q[:-1])  # noqa: E741
    sign = lambda x: x if abs(x) > tiny else math.copysign(tiny, x)
    down, up = np.zeros(n), np.zeros(n)
    s, p = np.zeros(n), np.zeros(n)
    lower, upper = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):
        down[i] = sign(s[i] + q[i])
        lower[i] = q[i] * l[i] / down[i]
        s[i + 1] = lower[i] * l[i] * s[i] - value
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        up[i + 1] = sign(e[i] + p[i + 1])
        ratio = q[i] / up[i + 1]
        upper[i] = l[i] * ratio
        p[i] = p[i + 1] * ratio - value
    gamma = s + p + value
    r = int(np.abs(gamma).argmin())
    z = np.zeros(n)
    z[r] = 1
    for i in range(r - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.sqrt(z @ z)


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors (columns) of an upper bidiagonal matrix for its
    largest singular values ``values``, largest first.

    Values that lie close together share a space: their vectors are made
    orthogonal, and one that the space already holds is found anew by inverse
    iteration."""
    n, top = len(diagonal), values[0]
    floor = _EPS * top
    a = np.maximum(np.abs(diagonal), floor)
    b = above * np.sign(np.where(diagonal[:-1] == 0, 1, diagonal[:-1])) if n > 1 else above
    # B'B = L D L' with D = a^2 and L D = a b; rows' signs don't matter
    q, ab = a * a, a[:-1] * b
    e = (b * b) if n > 1 else np.zeros(0)
    signs = np.ones(n)
    for i in range(n - 1):
        signs[i + 1] = signs[i] * (-1 if ab[i] < 0 else 1)
    tri = np.diag(q) + np.diag(np.concatenate([[0], e])) + np.diag(np.abs(ab), 1) + np.diag(np.abs(ab), -1)
    out = np.zeros((n, len(values)))
    random = np.random.default_rng(0)
    for k, value in enumerate(values):
        near = out[:, [j for j in range(k) if values[j] - value <= 1e-3 * value]]
        z = twisted(q, e, value * value)
        for again in range(5):
            for _ in range(2):
                z = z - near @ (near.T @ z)
            norm = math.sqrt(z @ z)
            z /= max(norm, floor)
            if norm > 0.1 and np.abs(tri @ z - value * value * z).max() <= 64 * n * _EPS * top * top:
                break
            z = random.normal(size=n) if again == 0 else z
            z -= near @ (near.T @ z)
            z = np.linalg.solve(tri - value * value * (1 + 4 * _EPS * (again + 1)) * np.eye(n), z)
            z /= math.sqrt(z @ z)
        out[:, k] = z
    return out * signs[:, None]


def principal(r: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """From the triangle of n centred rows: the largest eigenvalues of their
    covariance, its unit eigenvectors as columns, and its trace.  Values that
    are zero to working accuracy are left out."""
    diagonal, above, v = bidiagonal(r)
    values = dqds(diagonal, above)
    kept = values[:most]
    kept = kept[kept > 8 * len(r) * _EPS * max(values[0], 0)] if len(values) and values[0] > 0 else kept[:0]
    if not len(kept):
        return np.zeros(0), np.zeros((len(r), 0)), 0.0
    return kept ** 2 / n, v @ directions(diagonal, above, kept), float((values ** 2).sum()) / n


# -- the Spark side

def grid(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, x) of the rows of ``vectors`` (vec_id, embedding) that
    can be whitened; x is the packed vector of 64-bit integers."""
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("x", pa.binary())])

    def run(stream):
        for held in _chunks(stream):
            rows = []
            for vec, values in held:
                if values is None or not len(values) or any(c is None for c in values):
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(SCALE * np.array(values, dtype=np.float64))
                if np.isfinite(x).all() and np.abs(x).max() < 2 ** 53:
                    rows.append((vec, len(x), (x.astype("<i8") + ORIGIN).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)],
                                                 schema=schema)

    return (vectors.select(F.col("vec_id").cast("long"), "embedding")
            .mapInArrow(run, "vec_id long, dim int, x binary"))


def _chunks(stream: Iterator[pa.RecordBatch], count: int = 2048) -> Iterator[list[tuple]]:
    held = []
    for row in rows_of(stream):
        held.append(row)
        if len(held) == count:
            yield held
            held = []
    if held:
        yield held


def _matrix(held: list[tuple]) -> np.ndarray:
    return np.frombuffer(b"".join([r[-1] for r in held]), "<i8").reshape(len(held), -1)


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and sum of each dimension of ``fit`` (x), exactly."""
    schema = pa.schema([("at", pa.int32()), ("n", pa.int64()), ("total", pa.int64())])

    def run(stream):
        n, total = 0, 0
        for held in _chunks(stream):
            x = _matrix(held)
            n, total = n + len(x), total + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total)),
                                              pa.array(total)], schema=schema)

    got = (fit.select("x").mapInArrow(run, "at int, n long, total long")
           .groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
           .orderBy("at").collect())
    return (got[0].n, [int(r.total) for r in got]) if got else (0, [])


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - S / n: whole parts are taken off before anything is rounded."""
    whole = np.array([t // n for t in total], dtype=np.int64)
    rest = np.array([t % n / n for t in total])
    return (x - whole) - rest


def _fold(triangle: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    both = rows if triangle is None else np.vstack([triangle, rows])
    r = np.linalg.qr(both, mode="r")
    return r if len(r) == r.shape[1] else np.vstack([r, np.zeros((r.shape[1] - len(r), r.shape[1]))])


def triangle(fit: DataFrame, dim: int, n: int, total: list[int]) -> np.ndarray:
    """R of the QR factorisation of the centred rows of ``fit`` (x)."""
    kinds = "r binary"

    def leaves(stream):
        r = None
        for held in _chunks(stream, _BLOCK * max(dim, 32)):
            r = _fold(r, _centred(_matrix(held), n, total))
        if r is not None:
            yield pa.RecordBatch.from_pydict({"r": pa.array([r.tobytes()], pa.binary())})

    def joins(table):
        r = None
        for part in table["r"].to_pylist():
            r = _fold(r, np.frombuffer(part).reshape(dim, dim))
        return pa.table({"r": pa.array([r.tobytes()], pa.binary())})

    parts = cut(fit.select("x").mapInArrow(leaves, kinds), "triangles")
    count = parts.count()
    while count > FAN_IN:
        lanes = -(-count // FAN_IN)
        parts = cut(parts.withColumn("lane", F.pmod(F.xxhash64("r"), F.lit(lanes))).groupBy("lane")
                    .applyInArrow(joins, kinds), "triangles")
        count = parts.count()
    r = None
    for row in parts.orderBy("r").collect():
        r = _fold(r, np.frombuffer(row.r).reshape(dim, dim))
    return r


def identity_error(fit: DataFrame, n: int, total: list[int], onto: np.ndarray) -> float:
    """The largest absolute entry of the whitened rows' covariance less the
    identity, from the rows of ``fit`` themselves: tasks give their number of
    rows, mean and centred products, which are joined pair by pair."""
    width = onto.shape[1]
    schema = pa.schema([("n", pa.int64()), ("mean", pa.binary()), ("products", pa.binary())])

    def join(a, b):
        if a is None:
            return b
        m, step = a[0] + b[0], b[1] - a[1]
        return m, a[1] + step * (b[0] / m), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / m)

    def packed(s):
        return pa.RecordBatch.from_arrays([pa.array([s[0]], pa.int64()), pa.array([s[1].tobytes()], pa.binary()),
                                           pa.array([s[2].tobytes()], pa.binary())], schema=schema)

    def unpacked(r):
        return r[0], np.frombuffer(r[1]), np.frombuffer(r[2]).reshape(width, width)

    def leaves(stream):
        s = None
        for held in _chunks(stream):
            w = _centred(_matrix(held), n, total) @ onto
            mean = w.mean(axis=0)
            s = join(s, (len(w), mean, (w - mean).T @ (w - mean)))
        if s is not None:
            yield packed(s)

    def joins(table):
        s = None
        for r in zip(*[table[c].to_pylist() for c in schema.names]):
            s = join(s, unpacked(r))
        return pa.Table.from_batches([packed(s)])

    kinds = "n long, mean binary, products binary"
    parts = cut(fit.select("x").mapInArrow(leaves, kinds), "products")
    count = parts.count()
    while count > FAN_IN:
        lanes = -(-count // FAN_IN)
        parts = cut(parts.withColumn("lane", F.pmod(F.xxhash64("mean", "products"), F.lit(lanes))).groupBy("lane")
                    .applyInArrow(joins, kinds), "products")
        count = parts.count()
    s = None
    for r in parts.orderBy("mean").collect():
        s = join(s, unpacked((r.n, r["mean"], r.products)))
    return float(np.abs(s[2] / n - np.eye(width)).max())


def _deviation(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2; null beyond 64 bits."""
    reach = max((abs(int(v) * n - t) for bound in (x.min(axis=0), x.max(axis=0)) for v, t in zip(bound, total)),
                default=0)
    if reach * reach * x.shape[1] < 2 ** 63 and max(map(abs, total)) < 2 ** 62 and n * int(np.abs(x).max()) < 2 ** 62:
        y = x * n - np.array(total, dtype=np.int64)
        return (y * y).sum(axis=1).tolist()
    out = [sum((n * v - t) ** 2 for v, t in zip(row, total)) for row in x.tolist()]
    return [v if v < 2 ** 63 else None for v in out]


def _whitened(rows: DataFrame, n: int, total: list[int], onto: np.ndarray, explained: list[float],
              error: float) -> DataFrame:
    width = onto.shape[1]
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    count = max(1, min(1024, BATCH_BYTES // (56 * width)))

    def run(stream):
        for held in _chunks(stream, count):
            x = _matrix(held)
            k = len(x)
            dev = pa.array(_deviation(x, n, total), pa.int64())
            each = np.repeat(np.arange(k), width)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in held], pa.int64()).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), k)),
                pa.array(np.full(k * width, n)), dev.take(pa.array(each)),
                pa.array((_centred(x, n, total) @ onto).ravel()),
                pa.array(np.tile(explained, k)), pa.array(np.full(k * width, error))], schema=schema)

    return rows.select("vec_id", "x").mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, "
             "identity_error double")


def whiten(vectors: DataFrame, *, components: int = COMPONENTS) -> DataFrame:
    """For each row of ``vectors`` (vec_id, embedding) that can be whitened
    and each component, numbered from 1 by falling variance: vec_id,
    component, n (vectors fitted), deviation, whitened, explained,
    identity_error.

    Rows whose vector is null, empty, or holds null, non-finite or such large
    entries that the grid of doubles is coarser than 1 have no result.  Each
    distinct grid vector is fitted once, so repeated rows change nothing and
    have equal results.  Vectors of different length are fitted apart.  There
    are at most ``components`` components and none of zero variance (so none
    at all for one distinct vector).  A deviation beyond 64 bits is null.  Null
    vec_ids are carried through; other columns are not read; an empty table
    gives an empty result.
    """
    rows = cut(grid(vectors), "grid")
    fit = cut(rows.select("dim", "x").distinct(), "fit")
    out = vectors.sparkSession.createDataFrame(
        [], "vec_id long, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")
    for r in fit.select("dim").distinct().orderBy("dim").collect():
        own = fit.where(F.col("dim") == r.dim)
        n, total = sums(own)
        values, axes, trace = principal(triangle(own, r.dim, n, total), n, components)
        if not len(values):
            continue
        onto = axes / np.sqrt(values)
        error = identity_error(own, n, total, onto)
        out = out.union(_whitened(rows.where(F.col("dim") == r.dim), n, total, onto, (values / trace).tolist(), error))
    return out
