"""Embedding whitening through the singular values of the centred rows, without forming a covariance matrix.

Tasks reduce their centred rows block by block to a triangular R; the R's of all tasks are reduced the same way in two
rounds. Householder reflections bring the last R to bidiagonal form; dqds (differential quotient-difference steps with
shifts) finds its singular values to high relative accuracy, and twisted factorisations of B'B - s^2 I give the right
singular vectors of the largest ones, which the reflections carry back to whitening directions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motifspark.llm.common import materialise

EPS = float(np.finfo(np.float64).eps)
TINY = float(np.finfo(np.float64).tiny)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal and the right reflectors (unit vectors) of U' r V for a square ``r``."""
    a, d = r.astype(np.float64, copy=True), len(r)
    right: list[np.ndarray] = []

    def reflector(x: np.ndarray) -> np.ndarray | None:
        big = np.abs(x).max(initial=0.0)
        if big == 0 or not np.any(x[1:]):
            return None
        v = x / big
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        return v / np.sqrt(v @ v)

    for i in range(d):
        if (u := reflector(a[i:, i])) is not None:
            a[i:, i:] -= 2 * np.outer(u, u @ a[i:, i:])
        v = reflector(a[i, i + 1:]) if i < d - 2 else None
        if v is not None:
            a[i:, i + 1:] -= 2 * np.outer(a[i:, i + 1:] @ v, v)
        right.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def carry_back(z: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """V z for the reflectors of ``bidiagonalise``."""
    z = z.copy()
    for i in range(len(right) - 1, -1, -1):
        if right[i] is not None:
            z[i + 1:] -= 2 * right[i] * (right[i] @ z[i + 1:])
    return z


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One step on the squared diagonals; the least of the intermediate d is negative if the shift was too large."""
    d = q[0] - shift
    least, new_q, new_e = d, [], []
    for i in range(len(e)):
        x = d + e[i]
        new_q.append(x)
        ratio = q[i + 1] / x if x > TINY else (0.0 if q[i + 1] == 0 else 1.0)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        least = min(least, d)
    new_q.append(d)
    return new_q, new_e, least


def singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values, falling, of the upper bidiagonal matrix with diagonal ``a`` and superdiagonal ``b``."""
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(a))
    found: list[float] = []
    todo = [([float(x) ** 2 for x in a / scale], [float(x) ** 2 for x in b / scale], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        guess, steps = 0.0, 0
        while q:
            n = len(q)
            if n == 1:
                found.append(max(q[0], 0.0) + sigma)
                break
            if e[-1] <= EPS * EPS * (q[-1] + sigma) or e[-1] <= TINY:  # the last value stands alone
                found.append(max(q[-1], 0.0) + sigma)
                q, e, guess = q[:-1], e[:-1], 0.0
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS * EPS * (min(q[i], q[i + 1]) + sigma) or e[i] <= TINY), None)
            if cut is not None:  # falls apart
                todo.append((q[:cut + 1], e[:cut], sigma))
                q, e, guess = q[cut + 1:], e[cut + 1:], 0.0
                continue
            if steps % 8 == 0 and q[0] < q[-1]:  # the large end goes first: the small values settle at the last place
                q, e = q[::-1], e[::-1]
            # the least eigenvalue of the last two rows bounds the least of all from above
            half = (q[-1] + q[-2] + e[-1]) / 2
            root = max(half * half - q[-1] * q[-2], 0.0) ** 0.5
            above = q[-1] * q[-2] / (half + root) if half + root > 0 else 0.0
            shift = max(0.0, min(guess, above) * (1 - 4 * EPS)) if guess else 0.9 * above * (e[-1] < 0.25 * q[-1])
            for _ in range(3):
                nq, ne, least = _dqds_step(q, e, shift)
                if least >= 0 or shift == 0:
                    break
                shift = max(0.0, shift + least) if shift + least > 0.25 * shift else shift / 4
            else:
                shift = 0.0
                nq, ne, least = _dqds_step(q, e, 0.0)
            q, e, sigma, steps = nq, ne, sigma + shift, steps + 1
            guess = max(least, 0.0)
            if steps > 200 * (n + 5):
                raise ArithmeticError("dqds did not settle")
    return np.sqrt(np.array(sorted(found, reverse=True))) * scale


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Eigenvector of B'B for the eigenvalue near ``value``: forward and backward factorisations meet where least is left over."""
    n = len(a)
    tiny = EPS * EPS * max(float(a.max(initial=0.0)) ** 2, value, TINY)
    s, p = np.empty(n), np.empty(n)
    lower, upper = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        d = s[i] + a[i] ** 2
        d = d if abs(d) > tiny else tiny
        lower[i] = a[i] * b[i] / d
        s[i + 1] = b[i] ** 2 * s[i] / d - value
    p[-1] = a[-1] ** 2 - value
    for i in range(n - 2, -1, -1):
        d = b[i] ** 2 + p[i + 1]
        d = d if abs(d) > tiny else tiny
        upper[i] = a[i] * b[i] / d
        p[i] = p[i + 1] * a[i] ** 2 / d - value
    r = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -upper[i] * z[i]
        if abs(z[i + 1]) > 1e100:
            z /= abs(z[i + 1])
    big = np.abs(z).max()
    z /= big
    return z / np.sqrt(z @ z)


def _blocks(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Parts of the bidiagonal matrix that a negligible superdiagonal entry separates."""
    cut = [i + 1 for i in range(len(b)) if abs(b[i]) <= EPS * max(TINY, min(abs(a[i]), abs(a[i + 1])))]
    edges = [0, *cut, len(a)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def right_vectors(a: np.ndarray, b: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All singular values, falling, and the right singular vectors (rows) of the first ``count`` that aren't zero."""
    d = len(a)
    some: list[tuple[float, int, int]] = []
    for low, high in _blocks(a, b):
        some += [(float(s), low, high) for s in singular_values(a[low:high], b[low:high - 1])]
    some.sort(key=lambda x: (-x[0], x[1]))
    values = np.array([s for s, _, _ in some])
    wanted = [x for x in some[:count] if x[0] > d * EPS * values[0]]
    out = np.zeros((len(wanted), d))
    for k, (s, low, high) in enumerate(wanted):
        z = np.zeros(d)
        z[low:high] = _twisted(a[low:high], b[low:high - 1], s * s)
        for turn in range(6):
            rest = z - out[:k].T @ (out[:k] @ z)
            rest -= out[:k].T @ (out[:k] @ rest)
            length = np.sqrt(rest @ rest)
            if length > 0.7:
                break
            # a cluster whose vectors came out alike: inverse iteration from another start, away from those found
            start = np.random.default_rng([k, turn]).standard_normal(d)
            start -= out[:k].T @ (out[:k] @ start)
            t = np.diag(a ** 2 + np.concatenate([[0], b ** 2])) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
            near = t - s * s * (1 + 4 * EPS * (turn + 1)) * np.eye(d)
            for _ in range(3):
                start = np.linalg.solve(near, start / np.sqrt(start @ start))
                start -= out[:k].T @ (out[:k] @ start)
            z = start / np.sqrt(start @ start)
        out[k] = rest / length
    return values, out


def solve(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All singular values, falling, of the triangular ``r`` and unit right singular vectors (rows) of the first ``count`` that aren't zero.

    Each vector's largest entry (the first of equals) is positive, so that reruns agree.
    """
    d = r.shape[1]
    square = np.zeros((d, d))
    square[:len(r)] = r
    if not np.any(square):
        return np.zeros(d), np.zeros((0, d))
    scale = np.abs(square).max()
    a, b, right = bidiagonalise(square / scale)
    values, inner = right_vectors(a, b, count)
    out = np.array([carry_back(z, right) for z in inner]).reshape(len(inner), d)
    for v in out:
        v *= np.sign(v[np.argmax(np.abs(v) > np.abs(v).max() * (1 - 1e-9))]) / np.sqrt(v @ v)
    return values * scale, out


@dataclass
class Model:
    """What is fitted for vectors of one length: rows, exact sums, eigenvalues, their sum, and unit directions (rows)."""

    n: int
    sums: list[int]
    values: np.ndarray
    trace: float
    directions: np.ndarray
    identity_error: float | None = None


class Reducer:
    """Blockwise QR: rows in, the triangular factor of all of them out."""

    def __init__(self, d: int):
        self.r, self.kept, self.have, self.block = np.zeros((0, d)), [], 0, max(1024, 2 * d)

    def add(self, rows: np.ndarray) -> None:
        for at in range(0, len(rows), self.block):
            self.kept.append(rows[at:at + self.block])
            self.have += len(self.kept[-1])
            if self.have >= self.block:
                self.reduce()

    def reduce(self) -> np.ndarray:
        if self.kept:
            self.r = np.linalg.qr(np.vstack([self.r, *self.kept]), mode="r")
            self.kept, self.have = [], 0
        return self.r


def integers(vector: Column) -> Column:
    """floor(256 c) of every entry; null for a vector that is null or holds an entry that is null, not finite, or of 2^54 and more."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 54)))
    return F.when(vector.isNotNull() & F.coalesce(good, F.lit(False)), F.transform(vector, lambda c: F.floor(c * 256).cast("long")))


def _matrices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows of the batch, their long matrix) for each length of list in an Arrow column; empty lists left out."""
    size = np.diff(column.offsets.to_numpy())
    for d in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == d)
        part = column.take(pa.array(at)) if len(at) < len(column) else column
        yield d, at, part.flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: as longs where they fit, else as Python integers."""
    top = max(int(np.abs(x).max(initial=0)), 1)
    if top * n + max(map(abs, sums), default=0) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _totals(fit: DataFrame, lengths: list[int]) -> dict[int, tuple[int, list[int]]]:
    """Length -> (rows, exact sum of every dimension)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, at, x in _matrices(batch.column(0)):
                wide = int(np.abs(x).max()) * len(x) >= 1 << 62
                n[d] = n.get(d, 0) + len(at)
                sums[d] = sums.get(d, np.zeros(d, object)) + (x.astype(object) if wide else x).sum(0).astype(object)
        for d in n:
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n[d]] * d, pa.int64()),
                                              pa.array([str(s) for s in sums[d]])], ["d", "at", "n", "s"])

    made = fit.where(F.size("x").isin(lengths)).mapInArrow(run, "d int, at int, n long, s string")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in made.groupBy("d", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("d", "at").collect():
        out.setdefault(r.d, (r.n, []))[1].append(int(r.s))
    return out


def _fit(fit: DataFrame, totals: dict[int, tuple[int, list[int]]], count: int, spread: int = 64) -> dict[int, Model]:
    """Triangular factors of every task, reduced within ``spread`` groups of tasks and then to one, and its solution."""
    kinds = "d int, part int, r array<double>"

    def factors(d: int, part: int, reducer: Reducer) -> pa.RecordBatch:
        r = reducer.reduce()
        return pa.RecordBatch.from_arrays([pa.array([d] * len(r), pa.int32()), pa.array([part] * len(r), pa.int32()), pa.array(list(r), pa.list_(pa.float64()))], ["d", "part", "r"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reducers: dict[int, Reducer] = {}
        for batch in batches:
            for d, _, x in _matrices(batch.column(0)):
                n, sums = totals[d]
                reducers.setdefault(d, Reducer(d)).add(np.asarray(_scaled(x, n, sums) / n, np.float64))
        part = TaskContext.get().partitionId() % spread
        for d, reducer in reducers.items():
            yield factors(d, part, reducer)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Reducer]]:  # rows come sorted by length and part
        key, reducer = None, None
        for batch in batches:
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), len(batch)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if low < high and (now := (int(keys[0, low]), int(keys[1, low]))) != key:
                    if key is not None:
                        yield *key, reducer
                    key, reducer = now, Reducer(now[0])
                if low < high:
                    reducer.add(batch.column(2).slice(low, high - low).flatten().to_numpy().reshape(high - low, key[0]))
        if key is not None:
            yield *key, reducer

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, _, reducer in merged(batches):
            yield factors(d, 0, reducer)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, _, reducer in merged(batches):
            values, vectors = solve(reducer.reduce(), min(count, d))
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([values.tolist()], pa.list_(pa.float64())),
                                              pa.array([vectors.tolist()], pa.list_(pa.list_(pa.float64())))], ["d", "s", "v"])

    made = fit.where(F.size("x").isin(list(totals))).mapInArrow(first, kinds)
    made = made.repartition("d", "part").sortWithinPartitions("d", "part", "r").mapInArrow(second, kinds)
    made = made.repartition("d").sortWithinPartitions("d", "part", "r").mapInArrow(last, "d int, s array<double>, v array<array<double>>")
    out: dict[int, Model] = {}
    for r in made.collect():  # one row per length: (components + 1) times that many numbers
        n, sums = totals[r.d]
        e = np.array(r.s) ** 2 / n
        v = np.array(r.v, np.float64).reshape(-1, r.d)
        out[r.d] = Model(n, sums, e[:len(v)], float(e.sum()), v)
    return out


def _whitened(x: np.ndarray, m: Model) -> np.ndarray:
    return np.asarray(_scaled(x, m.n, m.sums) / m.n, np.float64) @ (m.directions / np.sqrt(m.values)[:, None]).T


def _check(fit: DataFrame, models: dict[int, Model]) -> None:
    """Set each model's identity_error: the covariance of the whitened fit rows, centred, against the identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _matrices(batch.column(0)):
                w = _whitened(x, models[d])
                with_one = np.hstack([w, np.ones((len(w), 1))])
                sums[d] = sums.get(d, 0) + with_one.T @ with_one
        for d, s in sums.items():
            i, j = np.indices(s.shape)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, d, np.int32)), pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(s.ravel())],
                                             ["d", "i", "j", "s"])

    made = fit.where(F.size("x").isin(list(models))).mapInArrow(run, "d int, i int, j int, s double")
    found: dict[int, np.ndarray] = {d: np.zeros((len(m.values) + 1,) * 2) for d, m in models.items()}
    for r in made.groupBy("d", "i", "j").agg(F.sum("s").alias("s")).collect():
        found[r.d][r.i, r.j] = r.s
    for d, m in models.items():
        if k := len(m.values):
            mean = found[d][:k, k] / m.n  # whitened rows are centred already: this is rounding
            m.identity_error = float(np.abs(found[d][:k, :k] / m.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", most_numbers: int = 4_000_000) -> DataFrame:
    """One row per vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries (or entries of 2^54 and more, whose integers would not fit)
    are dropped. The fit takes each distinct integer vector once, so repeated rows don't weigh more, and each of them is
    returned. Vectors of each length are fitted by themselves; a length has at most as many components as dimensions,
    and directions without variance (eigenvalue zero to double precision: all of a length's vectors equal, or fewer of
    them than dimensions) are no components and give no rows, nor do empty vectors. ``deviation`` is null where the
    exact value exceeds a long. Ids may be null or repeat; other columns are not read; an empty table gives an empty one.

    Shuffled: distinct integer vectors once (copies are dropped in each task first, so a hot vector is a row per task)
    and one triangle per task. The driver holds the list of lengths and, for lengths of at most ``most_numbers``
    numbers together at a time, sums and directions.
    """
    rows = vectors.select(F.col(id_col).alias("id"), integers(F.col(vector_col).cast("array<double>")).alias("x")).where(F.size("x") > 0)
    fit = materialise(rows.select("x").distinct(), "whitening_fit")
    kind = rows.schema["id"].dataType.simpleString()
    kinds = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = vectors.sparkSession.createDataFrame([], kinds)
    lengths = sorted(r[0] for r in fit.select(F.size("x")).distinct().collect())
    while lengths:
        some, numbers = [], 0
        while lengths and (not some or numbers + (components + 2) * lengths[0] <= most_numbers):
            numbers += (components + 2) * lengths[0]
            some.append(lengths.pop(0))
        models = _fit(fit, _totals(fit, some), components)
        _check(fit, models)
        out = out.unionAll(_project(rows.where(F.size("x").isin(some)), models, id_col, kinds))
    return out


def _project(rows: DataFrame, models: dict[int, Model], id_col: str, kinds: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, x in _matrices(batch.column(1)):
                m = models[d]
                k = len(m.values)
                if not k:
                    continue
                y = _scaled(x, m.n, m.sums)
                if y.dtype != object and int(np.abs(y).max()) ** 2 * d >= 1 << 63:
                    y = y.astype(object)
                deviation = [int(s) if s < 1 << 63 else None for s in (y * y).sum(1)]
                each = np.repeat(at, k)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))), pa.array(np.full(len(each), m.n, np.int64)),
                     pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))), pa.array(_whitened(x, m).ravel()),
                     pa.array(np.tile(m.values / m.trace, len(at))), pa.array(np.full(len(each), m.identity_error))],
                    [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, kinds)
