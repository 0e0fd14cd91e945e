"""Whitening of embeddings by blockwise QR and a bidiagonal qd solver.

A vector's entries c become whole numbers ``x = floor(1024 c) + 100000``.  One scan gives the number of vectors and
the exact sum of each dimension.  A second scan centres each block of rows and keeps only the triangle R of
its QR; triangles of tasks are stacked and reduced again, ``FAN`` at a time, until one is left, so that no task
and not the driver sees more than a few d x d triangles.  On the driver, Householder reflections make R bidiagonal,
dqds (shifted quotient differences, which only add, multiply and divide positive numbers) finds its singular
values to high relative accuracy, and twisted factorisations of the tridiagonal product give one vector for each.
Where values agree too closely, the product is shifted next to them, which parts them, and their
vectors come from there.  The covariance is never formed.  A third scan adds up the covariance of the
whitened rows, whose largest distance from the identity is ``identity_error``; the last scan gives the rows.

Defined results: a vector that is null or holds a null or non-finite entry is left out; all others must have one
length, and where lengths differ the most frequent counts (of ties the longer) and the others are left out.
Whole numbers are held within +-2^53.  Repeated rows and ids and null ids count and return like any others.  Components
stop at the rank: a direction without variance has none, so vectors that are all equal give no rows, like an
empty table.  ``deviation`` is null where it exceeds a long; ``deviation_exact`` holds it then (null beyond 38 digits).
Only id and vector are read, so other columns cannot clash.  The rows are scanned several times: give
a table, or a frame that repeats itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import ready
from tenura.session import cut

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 53)
COMPONENTS = 8
FAN = 32
EPS = np.finfo(np.float64).eps
CLOSE = 1e-7  # relative distance of eigenvalues below which the product is shifted
LONG = (1 << 63) - 1


def whole(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, vectors of whole numbers) of the usable vectors of a batch, by their length."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.maximum(lengths, 0)
    starts = np.cumsum(sizes) - sizes
    found = []
    for d in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == d)
        values = flat[starts[at][:, None] + np.arange(d)]
        good = np.isfinite(values).all(axis=1)
        if good.any():
            scaled = np.clip(np.floor(SCALE * values[good].clip(-LARGEST, LARGEST)) + SHIFT, -LARGEST, LARGEST)
            found.append((at[good], scaled.astype(np.int64)))
    return found


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, list] = {}
    for batch in batches:
        for _, x in whole(batch.column(0)):
            held = totals.setdefault(x.shape[1], [0, [0] * x.shape[1]])
            held[0] += len(x)
            high, low = (x >> 26).sum(axis=0).tolist(), (x & ((1 << 26) - 1)).sum(axis=0).tolist()
            held[1] = [s + (h << 26) + lo for s, h, lo in zip(held[1], high, low, strict=True)]
    for d, (n, sums) in totals.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)),
            ],
            names=["length", "dim", "n", "s"],
        )


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: the whole part of the mean is taken off exactly."""
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - base).astype(np.float64) - rest


def _of_length(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    return next((f for f in whole(column) if f[1].shape[1] == d), (np.zeros(0, np.int64), np.zeros((0, d), np.int64)))


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _block_qr(n: int, sums: list[int]):
    d = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            r = _triangle(np.vstack([r, centred(_of_length(batch.column(0), d)[1], n, sums)]))
        if len(r):
            part = TaskContext.get().partitionId() // FAN
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["part", "r"])

    return run


def _stacked(d: int):
    def run(group: pa.Table) -> pa.Table:
        r = np.zeros((0, d))
        for data in group["r"]:
            r = _triangle(np.vstack([r, np.frombuffer(data.as_buffer()).reshape(-1, d)]))
        return pa.table({"part": pa.array([group["part"][0].as_py() // FAN], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    return run


def reduced(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The triangle R of all centred rows, d x d."""
    d = len(sums)
    parts = cut(vectors.mapInArrow(_block_qr(n, sums), "part long, r binary"))
    while parts.count() > 1:
        parts = cut(parts.groupBy("part").applyInArrow(_stacked(d), "part long, r binary"))
    r = np.frombuffer(bytes(parts.first()["r"])).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v, beta with (1 - beta v v') x = (+-|x|, 0, ...)."""
    v, scale = x.copy(), np.abs(x).max(initial=0.0)
    if not scale:
        return v, 0.0
    v /= scale
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v, 2.0 / (v @ v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal, and V with ``r = U B V'``."""
    a, d = r.copy(), r.shape[1]
    right = np.eye(d)
    for k in range(d):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k + 2 <= d:
            v, beta = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= beta * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One dqds transform and its d; None if the shift is above the smallest eigenvalue."""
    d, out_q, out_e, ds = q[0] - shift, [], [], []
    for i, ei in enumerate(e):
        if d < 0:
            return None
        ds.append(d)
        total = d + ei
        if total <= 0:
            return None
        ratio = q[i + 1] / total
        out_q.append(total)
        out_e.append(ei * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    return [*out_q, d], out_e, [*ds, d]


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues of the qd array (squared singular values), rising."""
    found: list[float] = []
    floor = float(q.max(initial=0.0)) * 1e-60 or 1e-300
    blocks = [(np.maximum(q, floor).tolist(), e.tolist(), 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        weak = next((i for i in reversed(range(len(e))) if e[i] <= EPS * EPS * (q[i] + q[i + 1] + moved)), None)
        if len(q) == 1:
            found.append(q[0] + moved)
            continue
        if weak is not None:
            blocks += [(q[: weak + 1], e[:weak], moved), (q[weak + 1 :], e[weak + 1 :], moved)]
            continue
        if q[0] < 0.5 * q[-1]:  # the small ones belong at the end
            q, e = q[::-1], e[::-1]
        plain = _step(q, e, 0.0)
        if plain is None:  # a last entry of zero: the block is singular
            blocks.append(([max(x, floor) for x in q], [max(x, floor * EPS) for x in e], moved))
            continue
        least = min(plain[2])
        safe = 1.0 / sum(1.0 / d for d in plain[2]) * (1 - 8 * EPS * len(q)) if least > 0 else 0.0
        taken = None
        for part in (0.999, 0.9, 0.5, 0.1, 0.0):  # between a proven lower and an upper bound of the smallest
            shift = safe + part * (least - safe)
            taken = _step(q, e, shift) if shift > EPS * moved else None
            if taken:
                break
        if taken:
            blocks.append((taken[0], taken[1], moved + shift))
        else:
            blocks.append((plain[0], plain[1], moved))
    return np.sort(np.array(found))


def _stationary(lower: np.ndarray, d: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """L+, D+ and s of ``L D L' - shift = L+ D+ L+'``."""
    n, s = len(d), -shift
    out_l, out_d, ss = np.zeros(max(n - 1, 0)), np.zeros(n), np.zeros(n)
    tiny = EPS * EPS * max(np.abs(d).max(), 1e-300)
    for i in range(n):
        ss[i] = s
        out_d[i] = s + d[i] or tiny
        if i < n - 1:
            out_l[i] = d[i] * lower[i] / out_d[i]
            s = out_l[i] * lower[i] * s - shift
    return out_l, out_d, ss


def twisted(lower: np.ndarray, d: np.ndarray, value: float) -> np.ndarray:
    """The vector of ``value``, from the factorisation twisted where its pivot is least."""
    n = len(d)
    down, _, s = _stationary(lower, d, value)
    up, gamma = np.zeros(max(n - 1, 0)), np.zeros(n)
    tiny = EPS * EPS * max(np.abs(d).max(), 1e-300)
    p, gamma[n - 1] = d[n - 1] - value, s[n - 1] + d[n - 1]
    for i in range(n - 2, -1, -1):
        pivot = d[i] * lower[i] ** 2 + p or tiny
        ratio = d[i] / pivot
        up[i] = lower[i] * ratio
        gamma[i] = s[i] + ratio * p
        p = p * ratio - value
    k = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _below(lower: np.ndarray, d: np.ndarray, x: float) -> int:
    return int((_stationary(lower, d, x)[1] < 0).sum())


def _bisected(lower: np.ndarray, d: np.ndarray, rank: int, low: float, high: float) -> float:
    """The eigenvalue of this rank, to full relative accuracy."""
    while _below(lower, d, low) > rank:
        low -= max(abs(low), abs(high - low))
    while _below(lower, d, high) <= rank:
        high += max(abs(high), abs(high - low))
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high) or high - low <= 2 * EPS * max(abs(low), abs(high)):
            break
        low, high = (low, middle) if _below(lower, d, middle) > rank else (middle, high)
    return (low + high) / 2


def vectors_of(lower: np.ndarray, d: np.ndarray, values: np.ndarray, first: int = 0, depth: int = 0) -> np.ndarray:
    """Columns: vectors of the rising ``values``, those of rank ``first`` and on, of ``L D L'``."""
    out = np.zeros((len(d), len(values)))
    start = 0
    for stop in range(1, len(values) + 1):
        if stop < len(values) and values[stop] - values[stop - 1] <= CLOSE * max(abs(values[stop]), abs(values[stop - 1])):
            continue
        some = values[start:stop]
        if len(some) == 1 or depth > 4:
            for i, value in enumerate(some, start):
                out[:, i] = twisted(lower, d, value)
        else:  # next to the group its own members are far apart, relatively
            width = max(some[-1] - some[0], 4 * EPS * abs(some[0]))
            shift = some[0] - width
            l_near, d_near, _ = _stationary(lower, d, shift)
            near = [_bisected(l_near, d_near, first + i, v - shift - width, v - shift + width) for i, v in enumerate(some, start)]
            out[:, start:stop] = vectors_of(l_near, d_near, np.array(near), first + start, depth + 1)
        start = stop
    return out


def right_vectors(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of r, falling, and their right vectors as columns."""
    scale = np.abs(r).max(initial=0.0)
    if not scale:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    diagonal, upper, right = bidiagonal(r / scale)
    size = np.abs(diagonal).max(initial=0.0) + np.abs(upper).max(initial=0.0)
    diagonal = np.where(np.abs(diagonal) < 1e-30 * size, 1e-30 * size, diagonal)
    cuts = np.flatnonzero(np.abs(upper) <= EPS * EPS * size) + 1
    values, places = [], []
    for block in np.split(np.arange(len(diagonal)), cuts):
        q, e = diagonal[block] ** 2, upper[block[:-1]] ** 2
        values.append(dqds(q, e))
        places.append(block)
    owner = np.concatenate([np.full(len(v), i) for i, v in enumerate(values)])
    rank = np.concatenate([np.arange(len(v)) for v in values])
    flat = np.concatenate(values)
    order = np.argsort(-flat, kind="stable")[:most]
    order = order[flat[order] > (64 * len(flat) * EPS) ** 2 * flat.max()]  # below: rounding of the blocks
    out = np.zeros((r.shape[1], len(order)))
    for i, block in enumerate(places):
        mine = np.flatnonzero(owner[order] == i)
        if len(mine):
            lower, d = upper[block[:-1]] / diagonal[block[:-1]], diagonal[block] ** 2
            least = int(rank[order[mine]].min())
            z = vectors_of(lower, d, values[i][least:], least)
            out[np.ix_(block, mine)] = z[:, rank[order[mine]] - least]
    return flat[order] * scale * scale, right @ out


@dataclass
class Whitening:
    """What the scans have found; ``directions`` are columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float = 0.0

    def of(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ (self.directions / np.sqrt(self.values))


def _products(model: Whitening):
    k, d = len(model.values), len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = model.of(_of_length(batch.column(0), d)[1])
            w = np.column_stack([w, np.ones(len(w))])
            total += w.T @ w
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "s"])

    return run


def fit_whitening(rows: DataFrame, vector: str, components: int = COMPONENTS) -> Whitening | None:
    """Directions of most variance of all usable vectors; None if there is no vector."""
    ready(rows.sparkSession)
    vectors = rows.select(F.col(f"`{vector}`").alias("vector"))
    tallied = vectors.mapInArrow(_sums, "length int, dim int, n long, s decimal(38,0)")
    tallied = cut(tallied.groupBy("length", "dim").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")))
    best = tallied.agg(F.max(F.struct("n", "length")).alias("best")).first()["best"]
    if best is None:
        return None
    n = int(best["n"])
    sums = [int(r["s"]) for r in tallied.where(F.col("length") == best["length"]).orderBy("dim").collect()]
    r = reduced(vectors, n, sums)
    squares, directions = right_vectors(r, components)
    model = Whitening(n, sums, squares / n, directions, float((r * r).sum() / n))
    k = len(model.values)
    if k:
        found = vectors.mapInArrow(_products(model), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
        total = np.zeros((k + 1, k + 1))
        for row in found:
            total[row["i"], row["j"]] = total[row["j"], row["i"]] = row["s"]
        mean = total[:k, k] / n
        model.identity_error = float(np.abs(total[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return model


def _deviations(x: np.ndarray, model: Whitening) -> list[int]:
    n, sums = model.n, model.sums
    bound = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums))
    if bound < 1 << 62:
        away = n * x - np.array(sums, np.int64)
        if int(np.abs(away).max(initial=0)) ** 2 * len(sums) <= LONG:
            return (away * away).sum(axis=1).tolist()
        return [sum(a * a for a in row) for row in away.tolist()]
    return [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]


def _rows(model: Whitening):
    k, d = len(model.values), len(model.sums)
    explained = model.values / model.trace if k else model.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _of_length(batch.column(1), d)
            each = np.repeat(np.arange(len(at)), k)
            exact = _deviations(x, model) if len(x) else []
            as_long = pa.array([v if v <= LONG else None for v in exact], pa.int64())
            as_decimal = pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at[each])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(each), model.n)),
                    as_long.take(pa.array(each)),
                    pa.array(model.of(x).ravel()),
                    pa.array(np.tile(explained, len(at))),
                    pa.array(np.full(len(each), model.identity_error)),
                    as_decimal.take(pa.array(each)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"],
            )

    return run


def whitened(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    kind = rows.select(F.col(f"`{vec_id}`").alias("vec_id")).schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double, deviation_exact decimal(38,0)"
    )
    model = fit_whitening(rows, vector, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    narrow = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    return narrow.mapInArrow(_rows(model), schema)
