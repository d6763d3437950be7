"""Whitening of embeddings by blockwise QR and a bidiagonal qd solver (operator 11)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cellflux.llm.common import materialise, released

# The grid that an entry is rounded down to.
STEPS = 64
OFFSET = 1_000_000

_BLOCK = 2048  # rows that one QR step adds
_FAN = 16  # partial results that one merge takes
_MODEL_BYTES = 64 << 20  # models that the scoring tasks hold at a time
_EPS = np.finfo(float).eps
_STEPS = 2000  # qd steps without a value found; a few are usual
_CLOSE = 1e-3  # relative gap under which directions are kept apart by orthogonalisation


# ---- bidiagonal solver ----


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of the bidiagonal form of a square matrix, and the right reflections."""
    work = np.array(r, float)
    n = len(work)
    rights = []

    def reflection(x: np.ndarray) -> np.ndarray:
        """A unit vector v: x less 2 v (v x) has its first entry only."""
        scale = np.abs(x).max(initial=0.0)
        if scale == 0:
            return np.zeros_like(x)
        v = x / scale
        v[0] += math.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflection(work[k:, k])
        work[k:, k:] -= 2 * np.outer(v, v @ work[k:, k:])
        if k < n - 2:
            v = reflection(work[k, k + 1 :])
            work[k:, k + 1 :] -= 2 * np.outer(work[k:, k + 1 :] @ v, v)
            rights.append(v)
    return np.diag(work).copy(), np.diag(work, 1).copy(), rights


def rotated(z: np.ndarray, rights: list[np.ndarray]) -> np.ndarray:
    """A right vector of the bidiagonal form as one of the matrix that it came from."""
    out = z.copy()
    for k in range(len(rights) - 1, -1, -1):
        v = rights[k]
        out[k + 1 :] -= 2 * v * (v @ out[k + 1 :])
    return out


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One differential qd step with a shift: the next q and e, and its d; None if the shift is too large."""
    n = len(q)
    next_q, next_e, ds = [0.0] * n, [0.0] * (n - 1), [0.0] * n
    d = q[0] - shift
    for k in range(n - 1):
        ds[k] = d
        if d < 0:
            return None
        total = d + e[k]
        next_q[k] = total
        ratio = q[k + 1] / total if total > 0 else 0.0
        next_e[k] = e[k] * ratio
        d = d * ratio - shift if total > 0 else q[k + 1] - shift
    ds[-1] = next_q[-1] = d
    return None if d < 0 else (next_q, next_e, ds)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, largest first, each to nearly full relative accuracy.

    The squares go through differential qd steps. The d of a step without a shift are the inverse of the diagonal of the
    inverse, so that one over the sum of their inverses is a lower bound for the smallest value, and a shift that
    is always safe. What the shifts took off is added up and given back. A matrix whose off-diagonal entry has become
    negligible falls apart there.
    """
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(diagonal))
    parts = [([float(x) for x in (diagonal / scale) ** 2], [float(x) for x in (above / scale) ** 2], 0.0)]
    found: list[float] = []
    while parts:
        q, e, taken = parts.pop()
        if len(q) == 1:
            found.append(q[0] + taken)
            continue
        for _ in range(_STEPS):
            cut = _negligible(q, e, taken)
            if cut is not None:
                parts += [(q[:cut], e[: cut - 1], taken), (q[cut:], e[cut:], taken)]
                break
            plain = _step(q, e, 0.0)
            lowest = min(plain[2])
            # A little less than the bound, for what rounding may take.
            shift = (1 - 8 * len(q) * _EPS) / sum(1 / d for d in plain[2]) if lowest > 0 else 0.0
            moved = _step(q, e, shift) if shift > _EPS * taken / 4 else None
            q, e = (moved or plain)[:2]
            taken += shift if moved else 0.0
        else:
            raise ArithmeticError("the qd steps did not come to an end")
    return scale * np.sqrt(np.sort(np.array(found))[::-1])


def _negligible(q: list[float], e: list[float], taken: float) -> int | None:
    """Where a qd array falls apart without a change that the values, with what was taken off, could show."""
    for k in range(len(e) - 1, -1, -1):
        if e[k] <= _EPS**2 * min(q[k], q[k + 1]) or e[k] * (q[k] + q[k + 1] + e[k]) <= (_EPS * taken / 4) ** 2:
            return k + 1
    return None


class _Twisted:
    """The twisted factorisation of B'B less `square` that is nearest to singular.

    From the top the stationary, from the bottom the progressive differential transform; where they meet with the smallest
    pivot, the solution of the homogeneous system starts with 1 and runs both ways.
    """

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, square: float):
        n = len(diagonal)
        d, o, m = diagonal * diagonal, above * above, diagonal[:-1] * above
        tiny = _EPS * max(abs(square), float(d.max(initial=0.0)), np.finfo(float).tiny) * _EPS
        self.down, self.up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        s, p = np.empty(n), np.empty(n)
        s[0] = -square
        for k in range(n - 1):
            pivot = s[k] + d[k]
            pivot = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
            self.down[k] = m[k] / pivot
            s[k + 1] = o[k] / pivot * s[k] - square
        p[n - 1] = d[n - 1] - square
        for k in range(n - 2, -1, -1):
            pivot = o[k] + p[k + 1]
            pivot = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
            self.up[k] = m[k] / pivot
            p[k] = d[k] / pivot * p[k + 1] - square
        gamma = s + p + square
        gamma[n - 1] = s[n - 1] + d[n - 1]
        gamma = np.where(np.isfinite(gamma), gamma, np.inf)
        self.twist = int(np.argmin(np.abs(gamma)))
        self.pivots = np.r_[(s + d)[: self.twist], gamma[self.twist], (np.r_[0.0, o] + p)[self.twist + 1 :]]
        self.pivots = np.where(np.abs(self.pivots) > tiny, self.pivots, tiny)

    def _back(self, w: np.ndarray) -> np.ndarray:
        y = w.copy()
        for k in range(self.twist - 1, -1, -1):
            y[k] -= self.down[k] * y[k + 1]
        for k in range(self.twist, len(y) - 1):
            y[k + 1] -= self.up[k] * y[k]
        return y / np.linalg.norm(y)

    def direction(self) -> np.ndarray:
        start = np.zeros(len(self.pivots))
        start[self.twist] = 1.0
        return self._back(start)

    def solved(self, right: np.ndarray) -> np.ndarray:
        """The direction of the solution for a right side: a step of inverse iteration."""
        w, r = right.copy(), self.twist
        for k in range(r):
            w[k + 1] -= self.down[k] * w[k]
        for k in range(len(w) - 2, r - 1, -1):
            w[k] -= self.up[k] * w[k + 1]
        w /= self.pivots
        return self._back(w / np.abs(w).max())


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors of an upper bidiagonal matrix, one row per singular value of `values`, largest first.

    Values that lie close together share what a twisted factorisation can tell them apart by; their directions are
    made orthogonal, and found again by inverse iteration where nothing is left.
    """
    out = np.zeros((len(values), len(diagonal)))
    random = np.random.default_rng(0)
    for k, value in enumerate(values):
        twisted = _Twisted(diagonal, above, value * value)
        near = [j for j in range(k) if values[j] - value <= _CLOSE * values[0]]
        z = twisted.direction()
        for attempt in range(12):
            for _ in range(2):
                z = z - out[near].T @ (out[near] @ z)
            size = np.linalg.norm(z)
            if size > 0.5 or (attempt and size > 0.01 and attempt % 4 == 3):
                break
            z = twisted.solved(z / size if attempt % 4 and size > 0 else random.standard_normal(len(z)))
        z /= np.linalg.norm(z)
        out[k] = z - out[near].T @ (out[near] @ z)
        out[k] /= np.linalg.norm(out[k])
    return out


def principal(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of a triangular factor and their right vectors (rows).

    Values that rounding alone could have made are left out. A vector's largest entry is positive.
    """
    diagonal, above, rights = bidiagonal(r)
    values = dqds(diagonal, above)[:count]
    values = values[values > len(r) * 8 * _EPS * max(values.max(initial=0.0), np.finfo(float).tiny)]
    found = directions(diagonal, above, values)
    vectors = np.array([rotated(z, rights) for z in found]).reshape(len(values), len(r))
    signs = np.sign(vectors[np.arange(len(values)), np.abs(vectors).argmax(axis=1)]) if len(values) else np.ones(0)
    return values, vectors * signs[:, None]


# ---- distributed passes ----


def _on_grid(rows: DataFrame, vector: str) -> DataFrame:
    """`x`, the vector on the grid; rows without a usable vector go."""
    values = F.col(vector).cast("array<double>")
    limit = F.lit(float(2**62))
    usable = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * STEPS) < limit))
    kept = rows.filter(F.col(vector).isNotNull()).filter(usable).filter(F.size(vector) > 0)
    return kept.withColumn("x", F.transform(values, lambda c: F.floor(c * STEPS) + OFFSET))


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per length of the vectors in a batch: the length, the rows and their vectors as a matrix."""
    lists = batch.column(batch.schema.get_field_index(column))
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    begins = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        for part in range(0, len(at), _BLOCK):
            rows = at[part : part + _BLOCK]
            yield size, rows, flat[begins[rows][:, None] + np.arange(size)]


def _partial(
    rows: DataFrame, add: Callable[[int, object, np.ndarray], object], pack: Callable[[object], bytes]
) -> DataFrame:
    """(length, part, state): what `add` gathers from a task's vectors `x`, per length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        states: dict[int, object] = {}
        for batch in batches:
            for size, _, x in _by_length(batch, "x"):
                states[size] = add(size, states.get(size), x)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(states), pa.int32()),
                pa.array([part] * len(states), pa.int64()),
                pa.array([pack(s) for s in states.values()], pa.binary()),
            ],
            names=["length", "part", "state"],
        )

    return rows.select("x").mapInArrow(
        lambda batches: released(run(batches)), "length int, part bigint, state binary"
    )


def _merged(parts: DataFrame, merge: Callable[[list[bytes]], bytes], label: str) -> DataFrame:
    """One state per length, by a tree of merges of a few states each; every level is a written table."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        state = merge(list(group.sort_values("part")["state"]))
        return pd.DataFrame({"length": group["length"][:1], "part": group["part"][:1] // _FAN, "state": [state]})

    parts = materialise(parts, label)
    while True:
        most = parts.groupBy("length").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return parts
        # The last merges go to one state whatever the tasks' numbers are.
        nearby = F.floor(F.col("part") / _FAN) if most > _FAN else F.lit(0)
        level = parts.groupBy("length", nearby.alias("near")).applyInPandas(one, parts.schema)
        parts = materialise(level, label)


def _packed_sums(state: tuple[int, np.ndarray, np.ndarray]) -> bytes:
    return np.r_[np.int64(state[0]), state[1], state[2]].astype(np.int64).tobytes()


def _add_sums(size: int, state, x: np.ndarray):
    """Rows and sums; the upper and lower halves of the entries apart, so that nothing overflows."""
    n, high, low = state or (0, np.zeros(size, np.int64), np.zeros(size, np.int64))
    high, low = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
    return n + len(x), high + (low >> 32), low & 0xFFFFFFFF


def _merge_sums(states: list[bytes]) -> bytes:
    rows = [np.frombuffer(s, np.int64) for s in states]
    size = (len(rows[0]) - 1) // 2
    high, low = sum(r[1 : size + 1] for r in rows), sum(r[size + 1 :] for r in rows)
    return _packed_sums((sum(int(r[0]) for r in rows), high + (low >> 32), low & 0xFFFFFFFF))


def _means(raw: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    """n, and the sums as n * base + rest with 0 <= rest < n."""
    state = np.frombuffer(raw, np.int64)
    n, size = int(state[0]), (len(state) - 1) // 2
    sums = [int(h) * 2**32 + int(low) for h, low in zip(state[1 : size + 1], state[size + 1 :], strict=True)]
    base, rest = zip(*[divmod(s, n) for s in sums], strict=True)
    return n, np.array(base, np.int64), np.array(rest, np.int64)


def _centred(x: np.ndarray, n: int, base: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x less the mean; the whole part is taken off before anything is rounded."""
    return (x - base) - rest / n


def _triangle(rows: np.ndarray) -> np.ndarray:
    r = np.linalg.qr(rows, mode="r")
    size = rows.shape[1]
    return r if len(r) == size else np.vstack([r, np.zeros((size - len(r), size))])


def _matrix(raw: bytes) -> np.ndarray:
    flat = np.frombuffer(raw, float)
    return flat.reshape(math.isqrt(len(flat)), -1)


def _merge_triangles(states: list[bytes]) -> bytes:
    return _triangle(np.vstack([_matrix(s) for s in states])).tobytes()


def _moments(raw: bytes) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, means and centred products; of k coordinates they are 1 + k + k * k numbers."""
    flat = np.frombuffer(raw, float)
    k = (math.isqrt(4 * len(flat) - 3) - 1) // 2
    return flat[0], flat[1 : k + 1], flat[k + 1 :].reshape(k, k)


def _merge_moments(states: list[bytes]) -> bytes:
    total = _moments(states[0])
    for raw in states[1:]:
        total = _joined_moments(total, _moments(raw))
    return np.r_[total[0], total[1], total[2].ravel()].tobytes()


def _joined_moments(a, b):
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


class Model:
    """What scoring needs for vectors of one length."""

    def __init__(self, n: int, base, rest, vectors, spread, explained, identity_error: float = math.nan):
        self.n = n
        self.base, self.rest = np.array(base, np.int64), np.array(rest, np.int64)
        self.spread, self.explained = np.array(spread, float), np.array(explained, float)
        self.vectors = np.array(vectors, float).reshape(len(self.spread), len(self.base))
        self.identity_error = identity_error

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.base, self.rest) @ self.vectors.T / self.spread

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, exact; missing where it is no 64-bit number."""
        off = x - self.base
        if self.n * (float(np.abs(off).max(initial=0)) + 1) * math.sqrt(x.shape[1]) < 2.0**31:
            small = self.n * off - self.rest
            return (small * small).sum(axis=1).tolist()
        rest = self.rest.tolist()
        exact = [sum((self.n * v - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in off.tolist()]
        return [v if v < 2**63 else None for v in exact]


_MODEL = (
    "length int, n bigint, base array<bigint>, rest array<bigint>, vectors array<double>, "
    "spread array<double>, explained array<double>"
)


def _passes(models: DataFrame) -> Iterator[dict[int, tuple]]:
    """A small table (length, ...) as dictionaries by length, each of at most `_MODEL_BYTES` and one row more."""
    held, part = 0, {}
    for row in models.orderBy("length").toLocalIterator():
        part[row[0]] = tuple(row[1:])
        held += sum(len(v) * (1 if isinstance(v, (bytes, bytearray)) else 8) for v in row[1:] if hasattr(v, "__len__"))
        if held >= _MODEL_BYTES:
            yield part
            held, part = 0, {}
    if part:
        yield part


def fitted(fit: DataFrame, components: int = 16) -> DataFrame:
    """One model per vector length of `fit` (`x`, distinct vectors on the grid), written as a table.

    First rows and sums per dimension, exact. Then each task takes the mean off its rows and carries one triangular factor
    along: a block of rows is put under it and both are factored again. Factors of tasks are merged a few at a time, so
    that no task holds more than a few small matrices; only the last factor of each length is solved, in a task.
    """
    spark = fit.sparkSession
    sums = _merged(_partial(fit, _add_sums, _packed_sums), _merge_sums, "whitening-sums")
    sums = sums.select("length", F.col("state").alias("sums"))
    parts: DataFrame | None = None
    for part in _passes(sums):
        means = spark.sparkContext.broadcast({size: _means(bytes(raw)) for size, (raw,) in part.items()})

        def add(size: int, state: np.ndarray | None, x: np.ndarray, means=means) -> np.ndarray | None:
            if size not in means.value:
                return None
            rows = _centred(x, *means.value[size])
            return _triangle(rows if state is None else np.vstack([state, rows]))

        own = _partial(fit, add, lambda state: b"" if state is None else state.tobytes())
        own = own.filter(F.length("state") > 0)
        parts = own if parts is None else parts.unionByName(own)
    if parts is None:
        return spark.createDataFrame([], _MODEL)
    triangles = _merged(parts, _merge_triangles, "whitening-triangles")

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        n, base, rest = _means(rows["sums"].iloc[0])
        r = _matrix(rows["state"].iloc[0])
        values, vectors = principal(r, components)
        all_of_it = max(float((r * r).sum()), np.finfo(float).tiny)
        return pd.DataFrame(
            {
                "length": [len(base)],
                "n": [n],
                "base": [base],
                "rest": [rest],
                "vectors": [vectors.ravel()],
                "spread": [values / math.sqrt(n)],
                "explained": [values**2 / all_of_it],
            }
        )

    both = triangles.join(sums, "length").select("length", "sums", "state")
    return materialise(both.groupBy("length").applyInPandas(solve, _MODEL), "whitening-models")


def _identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """Largest entry of the covariance of the whitened fit list less the identity, per length, measured."""
    shared = fit.sparkSession.sparkContext.broadcast(models)

    def add(size: int, state, x: np.ndarray):
        if size not in shared.value:
            return None
        z = shared.value[size].whitened(x)
        mean = z.mean(axis=0)
        one = (float(len(z)), mean, (z - mean).T @ (z - mean))
        return one if state is None else _joined_moments(state, one)

    def pack(state) -> bytes:
        return b"" if state is None else np.r_[state[0], state[1], state[2].ravel()].tobytes()

    parts = _partial(fit, add, pack).filter(F.length("state") > 0)
    out = {}
    for row in _merged(parts, _merge_moments, "whitening-identity").toLocalIterator():
        n, _, products = _moments(row["state"])
        out[row["length"]] = float(np.abs(products / n - np.eye(len(products))).max(initial=0.0))
    return out


def whitened(rows: DataFrame, components: int = 16, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Whitened coordinates of all rows with a usable vector, by the principal directions of the distinct ones.

    An entry c becomes floor(64 c) + 1000000 as a long; the fit list is each distinct vector of such entries once.
    Returns per row and component (numbered from 1 by falling variance): the key, component, n (fit
    list), deviation (sum of (n x - S)^2 over the dimensions, exact; missing where no 64-bit number holds it),
    whitened, explained (share of the total variance), identity_error.

    Rows whose vector is missing, empty or holds a missing or non-finite entry, or one whose long would have no
    64 bits, go. Vectors of each length are a space of their own, with its own fit list. Directions without
    variance (there are at most n - 1 with) have no rows; an empty table has none. Equal vectors, repeated keys and
    missing keys each keep their rows. Other columns are left out, so that none clashes. All rows of a
    frequent vector are one before they are shuffled.
    """
    spark = rows.sparkSession
    usable = _on_grid(rows.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector").select("key", "x")
    fit = materialise(usable.select("x").distinct(), "whitening-fit")
    kind = usable.schema["key"].dataType
    schema = StructType([StructField(key, kind)]).add("component", "integer").add("n", "long").add("deviation", "long")
    schema = schema.add("whitened", "double").add("explained", "double").add("identity_error", "double")
    out: DataFrame | None = None
    for part in _passes(fitted(fit, components)):
        models = {size: Model(*values) for size, values in part.items()}
        for size, error in _identity_errors(fit, models).items():
            models[size].identity_error = error
        shared = spark.sparkContext.broadcast(models)
        own = usable.mapInArrow(_scored(shared, schema.names), schema)
        out = own if out is None else out.unionByName(own)
    return spark.createDataFrame([], schema) if out is None else out


def _scored(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, at, x in _by_length(batch, "x"):
                model = shared.value.get(size)
                if model is None or not len(model.spread):
                    continue
                k = len(model.spread)
                out = [
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                    pa.array(np.full(len(at) * k, model.n), pa.int64()),
                    pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                    pa.array(model.whitened(x).ravel(), pa.float64()),
                    pa.array(np.tile(model.explained, len(at)), pa.float64()),
                    pa.array(np.full(len(at) * k, model.identity_error), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return lambda batches: released(run(batches))
