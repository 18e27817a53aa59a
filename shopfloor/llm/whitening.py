"""Whitening of embeddings: directions from a bidiagonal qd solver, fitted and applied by Spark.

Entries become whole numbers, so sums over all rows are exact. Each task reduces its centred rows, block
by block, to a triangular R (QR), and the Rs of tasks are joined in a tree of FAN, again by QR; the
covariance itself is never formed. R's square has n times the covariance's eigenvalues. On the driver,
which gets one d x d matrix: Householder reflections make R bidiagonal, the shifted quotient-difference
algorithm (dqds) finds the singular values to high relative accuracy, and twisted factorisations
of the shifted square give each one's vector by a single back substitution both ways. Vectors of values
too close to each other are separated by inverse iteration within their group. A task then projects its
rows; the whitened rows' covariance is summed as before and its distance from the identity returned.

The embeddings are read once a pass and never shuffled or stored.

Cases: rows whose vector is null or empty, holds null or non-finite entries, has another length than most
(of equally common lengths the shorter counts) or an entry of which 64 times is 2**52 or more take no
part; zero vectors and rows with null vec_id do; repeated rows count each. Components whose eigenvalue is
zero to double precision are left out, so equal vectors alone give no rows, nor does an empty table. A
deviation beyond 64 bits is null. Other columns are left out.
"""

from __future__ import annotations

import io
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.text import saved

SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0**52
FAN = 64
BLOCK_ROWS = 8192
COMPONENTS = 32
EPS = np.finfo(float).eps


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vec (array of double) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("vec"))
    fits = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < LARGEST))
    rows = rows.where(fits & (F.size("vec") > 0))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0]["n"] if sizes else 0))


def whole_numbers(column: pa.Array) -> np.ndarray:
    """[row, dimension] of a column of equally long arrays."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.floor(values * SCALE).astype(np.int64) + SHIFT


def blocks(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield part, whole_numbers(part.column("vec"))


def reduced(rows: DataFrame, add: Callable, join: Callable) -> np.ndarray | None:
    """One numpy array from all rows, or None: each task adds its blocks, one by one, to what it has (None at
    first), then the tasks' arrays are joined FAN at a time, in their order, until one is left."""
    def of_task(batches):
        out = None
        for _, x in blocks(batches):
            out = add(out, x)
        task = TaskContext.get().partitionId()
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([packed(out)], pa.binary())],
                                             ["block", "data"])

    found = saved(rows.mapInArrow(of_task, "block long, data binary"))

    def joined(table: pa.Table) -> pa.Table:
        table, out = table.sort_by("block"), None
        for data in table.column("data").to_pylist():
            out = unpacked(data) if out is None else join(out, unpacked(data))
        return pa.table([table.column("block").slice(0, 1), pa.array([packed(out)], pa.binary())], ["block", "data"])

    span = FAN
    while found.count() > 1:
        found = saved(found.groupBy(F.floor(F.col("block") / span)).applyInArrow(joined, "block long, data binary"))
        span *= FAN
    one = found.first()
    return None if one is None else unpacked(one["data"])


def packed(x: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, x, allow_pickle=False)
    return out.getvalue()


def unpacked(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


def triangle(rows: np.ndarray) -> np.ndarray:
    """R of the rows' QR factorisation; fewer rows than columns give as many rows."""
    return np.linalg.qr(rows, mode="r")


def moments(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and each dimension's sum, exact: high and low parts are summed apart."""
    def whole(a, b):
        high, low, n = a + b
        return np.array([high + (low >> 26), low & (1 << 26) - 1, n])

    def add(out, x):
        block = np.array([(x >> 26).sum(0), (x & (1 << 26) - 1).sum(0), np.full(x.shape[1], len(x))])
        return whole(block, 0 * block if out is None else out)

    out = reduced(rows, add, whole)
    if out is None:
        return 0, []
    return int(out[2, 0]), [(int(h) << 26) + int(low) for h, low in zip(out[0], out[1], strict=True)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, rounded once: with S = n * whole + rest the whole part is taken off exactly."""
    parts = [divmod(s, n) for s in sums]
    return (x - np.array([a for a, _ in parts], np.int64)) - np.array([b / n for _, b in parts])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums over dimensions of (n * x - S)**2, exact."""
    parts = [divmod(s, n) for s in sums]
    off, rest = x - np.array([a for a, _ in parts], np.int64), np.array([b for _, b in parts], object)
    about = (centred(x, n, sums)**2).sum(1) * float(n)**2
    with np.errstate(over="ignore"):
        y = off.astype(np.uint64) * np.uint64(n % 2**64) - rest.astype(np.uint64)
        low = (y * y).sum(1, dtype=np.uint64)  # right modulo 2**64, so right if it is below that
    out = low.tolist()
    for i in np.flatnonzero(about > 2.0**62):
        exact = sum((n * int(a) - b)**2 for a, b in zip(off[i], rest, strict=True))
        out[i] = exact if exact < 2**63 else None
    return out


# The solver: matrices of the size of one vector's length squared.

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V of r = U B V^T, by Householder reflections from both sides in turn."""
    a = np.array(r, np.float64)
    d = a.shape[1]
    if len(a) < d:
        a = np.vstack([a, np.zeros((d - len(a), d))])
    v = np.eye(d)
    for i in range(d):
        h, beta = reflector(a[i:, i])
        a[i:, i:] -= np.outer(beta * h, h @ a[i:, i:])
        if i < d - 2:
            h, beta = reflector(a[i, i + 1:])
            a[i:, i + 1:] -= np.outer(a[i:, i + 1:] @ h, beta * h)
            v[:, i + 1:] -= np.outer(v[:, i + 1:] @ h, beta * h)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """h and beta for which I - beta h h^T turns x onto the first axis."""
    h, size = x.copy(), np.abs(x).max(initial=0.0)
    if size == 0.0 or not np.any(x[1:]):
        return np.zeros_like(h), 0.0
    h /= size
    h[0] += np.copysign(np.sqrt(h @ h), h[0])
    return h, 2.0 / (h @ h)


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Squared singular values, from the squares of a bidiagonal matrix's diagonal and superdiagonal (all
    positive): shifted quotient-difference steps with shifts below the least value left."""
    q, e, total, found = list(q), list(e), 0.0, []
    nothing = EPS**4 * max([*q, *e])  # far below what counts as zero
    while q:
        if len(q) == 1 or e[-1] <= EPS * EPS * (total + q[-1]) + nothing:
            found.append(total + q.pop())
            e = e[:-1]
            continue
        # Trace of the inverse: 1 / sum(1 / d) is below the least value.
        d, inverse = q[0], 1.0 / q[0]
        for i in range(len(e)):
            d = max(d * (q[i + 1] / (d + e[i])), 1e-300)
            inverse += 1.0 / d
        shift = (1.0 - 4 * EPS * len(q)) / inverse
        if shift < EPS * EPS * total:
            shift = 0.0
        while True:
            new_q, new_e, d = [], [], q[0] - shift
            for i in range(len(e)):
                both = d + e[i]
                ratio = q[i + 1] / both
                new_q.append(both)
                new_e.append(e[i] * ratio)
                d = d * ratio - shift
                if d < 0:
                    break
            if d >= 0 or shift == 0.0:
                break
            shift = shift / 2 if shift > EPS * total else 0.0  # rounding took it beyond
        q, e, total = [max(x, 1e-300) for x in [*new_q, d]], [max(x, 1e-300) for x in new_e], total + shift
    return found


class Twisted:
    """B^T B - value, factorised from both ends of the bidiagonal B to meet at each place."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        d, ratio, n = diagonal**2, above / diagonal[:-1], len(diagonal)
        small = EPS * EPS * (d.max() + value)
        self.down, self.up = np.zeros(n - 1), np.zeros(n - 1)  # multipliers from the top and from the bottom
        self.top, self.bottom = np.zeros(n), np.zeros(n)  # pivots
        s = -value
        from_top = [s]
        for i in range(n - 1):
            pivot = s + d[i]
            pivot = pivot if abs(pivot) > small else -small
            self.top[i], self.down[i] = pivot, d[i] * ratio[i] / pivot
            s = self.down[i] * ratio[i] * s - value
            from_top.append(s)
        self.top[-1] = s + d[-1]
        p = d[-1] - value
        from_bottom = [p]
        for i in range(n - 2, -1, -1):
            pivot = d[i] * ratio[i]**2 + p
            pivot = pivot if abs(pivot) > small else -small
            self.bottom[i + 1], self.up[i] = pivot, ratio[i] * d[i] / pivot
            p = p * d[i] / pivot - value
            from_bottom.append(p)
        self.bottom[0] = p
        self.meet = np.array(from_top) + np.array(from_bottom[::-1]) + value
        self.meet = np.where(np.abs(self.meet) > small, self.meet, small)

    def vector(self) -> np.ndarray:
        """The vector of the value: one back substitution both ways from where the pivots meet closest."""
        at, n = int(np.argmin(np.abs(self.meet))), len(self.meet)
        z = np.zeros(n)
        z[at] = 1.0
        for i in range(at - 1, -1, -1):
            z[i] = -self.down[i] * z[i + 1]
        for i in range(at, n - 1):
            z[i + 1] = -self.up[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, x: np.ndarray) -> np.ndarray:
        """One step of inverse iteration."""
        at, n = int(np.argmin(np.abs(self.meet))), len(self.meet)
        y = x.copy()
        for i in range(at):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(n - 1, at, -1):
            y[i - 1] -= self.up[i - 1] * y[i]
        y[:at] /= self.top[:at]
        y[at] /= self.meet[at]
        y[at + 1:] /= self.bottom[at + 1:]
        for i in range(at - 1, -1, -1):
            y[i] -= self.down[i] * y[i + 1]
        for i in range(at, n - 1):
            y[i + 1] -= self.up[i] * y[i]
        return y / np.linalg.norm(y)


def eigenvectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal vectors (columns) of B^T B for its values, falling."""
    out, rng = np.zeros((len(diagonal), len(values))), np.random.default_rng(5)
    group = 0  # where the values close to this one begin
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-5 * values[j - 1]:
            group = j
        twisted = Twisted(diagonal, above, value)
        z, near = twisted.vector(), out[:, group:j]
        best = 0.0
        for attempt in range(12 if j > group else 0):
            apart = z - near @ (near.T @ z)
            apart -= near @ (near.T @ apart)
            left = np.linalg.norm(apart)
            if left > best:
                best, found = left, apart / left
            if left > 0.5:
                break
            start = apart / left if left > 1e-8 and attempt % 3 else rng.normal(size=len(z))
            start -= near @ (near.T @ start)
            z = twisted.solve(start)
        z = found if best else z
        out[:, j] = z
    return out


def principal(r: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues of r^T r / n, falling, their vectors as columns, and the trace; at most ``most``, without zeros."""
    scale = np.abs(r).max(initial=0.0)
    if scale == 0.0:
        return np.zeros(0), np.zeros((r.shape[1], 0)), 0.0
    diagonal, above, v = bidiagonal(r / scale)
    least = 1e-150
    diagonal = np.where(np.abs(diagonal) > least, diagonal, least)
    smaller = np.minimum(np.abs(diagonal[:-1]), np.abs(diagonal[1:]))
    # Where the superdiagonal is zero to double precision the matrix falls apart; each part has values of its own.
    cuts = [0, *(np.flatnonzero(np.abs(above) <= 4 * EPS * smaller) + 1).tolist(), len(diagonal)]
    found = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        values = np.sort(dqds((diagonal[lo:hi]**2).tolist(), (above[lo:hi - 1]**2).tolist()))[::-1]
        found += [(value, lo, hi, i) for i, value in enumerate(values)]
    trace = sum(f[0] for f in found)
    found.sort(reverse=True)
    zero = (len(diagonal) * EPS)**2 * found[0][0]
    found = [f for f in found[:most] if f[0] > zero]
    vectors = np.zeros((len(diagonal), len(found)))
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        mine = [j for j, f in enumerate(found) if f[1] == lo]
        if mine:
            vectors[lo:hi, mine] = eigenvectors(diagonal[lo:hi], above[lo:hi - 1], np.array([found[j][0] for j in mine]))
    vectors = v @ vectors
    vectors *= np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    unit = scale * scale / n
    return np.array([f[0] for f in found]) * unit, vectors, trace * unit


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each row that takes part and
    each of the ``most`` largest components."""
    rows = usable(vectors)
    ddl = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [c.split(" ")[0] for c in ddl.split(", ")]
    n, sums = moments(rows)
    if not n:
        return rows.sparkSession.createDataFrame([], ddl)
    r = reduced(rows,
                lambda out, x: triangle(np.vstack([*([] if out is None else [out]), centred(x, n, sums)])),
                lambda a, b: triangle(np.vstack([a, b])))
    values, directions, trace = principal(r, n, most)
    k = len(values)
    if not k:
        return rows.sparkSession.createDataFrame([], ddl)
    to_white = directions / np.sqrt(values)

    def add(out, x):
        white = centred(x, n, sums) @ to_white
        block = np.vstack([white.T @ white, white.sum(0)])
        return block if out is None else out + block

    total = reduced(rows, add, lambda a, b: a + b) / n
    covariance = total[:k] - np.outer(total[k], total[k])
    identity_error = float(np.abs(covariance - np.eye(k)).max())
    explained = values / trace

    def project(batches):
        for batch, x in blocks(batches):
            white = centred(x, n, sums) @ to_white
            size = batch.num_rows
            at = pa.array(np.repeat(np.arange(size), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                 pa.array(np.full(size * k, n), pa.int64()), pa.array(deviations(x, n, sums), pa.int64()).take(at),
                 pa.array(white.ravel(), pa.float64()), pa.array(np.tile(explained, size), pa.float64()),
                 pa.array(np.full(size * k, identity_error), pa.float64())], names)

    return rows.mapInArrow(project, ddl)
