"""Whitening of embeddings.

Every entry becomes a whole number, floor(SCALE * entry) + OFFSET, and each distinct vector of whole numbers counts once
for the fit. Tasks pack vectors into a few bytes, one shuffle finds the distinct ones, and passes over that table give
sums, scatter and, at the end, the covariance of the whitened vectors.

1. Sums give the mean; the scatter is taken about the whole number next to the mean, in whole numbers, and moved to the
   exact mean on the driver. So the covariance is exact up to one rounding, whatever the tasks' order.
2. Pivoted Cholesky turns the covariance C into L L' with a triangular L of as many columns as C has rank.
3. One-sided Jacobi rotates pairs of L's columns until all are orthogonal. Squared column norms are the eigenvalues,
   normalised columns the components.

Only matrices of dimension x dimension numbers reach the driver (embeddings have at most some thousand dimensions),
never vectors.

Defined cases: vectors that are missing, or hold missing or non-finite entries, or entries of 2^40 and more in amount
(beyond the range in which sums stay exact) are left out; so are vectors of another length than the commonest one among
the distinct vectors (of two, the longer), and empty ones. Rows without an id stay. Repeated rows are returned each, and
fitted once. Components of no variance are not returned, so that a table with a single distinct vector gives no
components; an empty table gives an empty result. A deviation beyond 64 bits is null. Other columns are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.common import type_of, written

SCALE, OFFSET = 64, 1_000_000
LARGEST = 2.0**40
COMPONENTS = 16
#: Rows and amounts below which products sum exactly in doubles: 2^12 rows of at most 2^20.
_ROWS, _SMALL = 1 << 12, 1 << 20


@dataclass(frozen=True)
class Whitening:
    """The fit: the fit list's size n, sums per dimension, eigenvalues, components as columns, trace of the covariance,
    and the largest entry by which the whitened fit list's covariance differs from the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace for v in self.values]

    @property
    def middle(self) -> np.ndarray:
        """The whole number next to the mean, per dimension."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the mean exceeds that whole number by."""
        return [s - self.n * int(q) for s, q in zip(self.sums, self.middle, strict=True)]

    def project(self, about: np.ndarray) -> np.ndarray:
        """Whitened rows of vectors that are given about middle."""
        centred = about - np.array([r / self.n for r in self.rest])
        return centred @ self.components / np.sqrt(self.values)


def whole_numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries as whole numbers without OFFSET, each vector's length and which vectors count."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten()
    numbers = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    fine = np.abs(numbers) < LARGEST  # not so for nan
    bad = np.concatenate([[0], np.cumsum(~fine)])
    ends = np.cumsum(lengths)
    counts = (bad[ends] == bad[ends - lengths]) & (lengths > 0)
    return np.floor(SCALE * np.where(fine, numbers, 0)).astype(np.int64), lengths, counts


def _by_length(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the vectors of each length, and their entries as a matrix."""
    flat, lengths, counts = whole_numbers(vectors)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths[counts]):
        places = np.flatnonzero(counts & (lengths == length))
        if len(places) * length == len(flat):
            yield places, flat.reshape(len(places), length)
        else:
            yield places, flat[starts[places][:, None] + np.arange(length)]


def _packed(matrix: np.ndarray) -> list[bytes]:
    """Each row in the least number of bytes an entry, 1, 2, 4 or 8, that holds all its entries."""
    amount = np.abs(matrix).max(axis=1, initial=0)
    out: list[bytes] = [b""] * len(matrix)
    for kind, low, high in (("i1", -1, 1 << 7), ("<i2", 1 << 7, 1 << 15), ("<i4", 1 << 15, 1 << 31), ("<i8", 1 << 31, 1 << 62)):
        places = np.flatnonzero((amount >= low) & (amount < high))
        for place, row in zip(places.tolist(), matrix[places].astype(kind), strict=True):
            out[place] = row.tobytes()
    return out


def _unpacked(packed: pa.Array, dims: int) -> np.ndarray:
    """Rows of _packed, as 64-bit numbers."""
    matrix = np.empty((len(packed), dims), dtype=np.int64)
    widths = pa.compute.binary_length(packed).to_numpy(zero_copy_only=False) // dims
    for width in np.unique(widths):
        places = np.flatnonzero(widths == width)
        raw = b"".join(packed.take(pa.array(places)).to_pylist())
        matrix[places] = np.frombuffer(raw, dtype=f"<i{width}").reshape(-1, dims)
    return matrix


def distinct_vectors(df: DataFrame, column: str) -> DataFrame:
    """(dims, packed) of each distinct vector of whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in _by_length(batch[column]):
                dims = pa.array(np.full(len(places), matrix.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_pydict({"dims": dims, "packed": pa.array(_packed(matrix), pa.binary())})

    return df.select(column).mapInArrow(run, "dims int, packed binary").distinct()


def _decimals(numbers: list[int]) -> pa.Array:
    return pa.array([Decimal(x) for x in numbers], pa.decimal128(38, 0))


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            matrix = _unpacked(batch["packed"], dims)
            n += len(matrix)
            total = [t + int(s) for t, s in zip(total, matrix.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(dims), pa.int32()), "n": pa.array([n] * dims, pa.int64()), "s": _decimals(total)})

    found = fit.mapInArrow(run, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    rows = sorted(found.collect())
    return rows[0].n, [int(r.s) + r.n * OFFSET for r in rows]


def _products(y: np.ndarray) -> np.ndarray:
    """y'y in exact whole numbers."""
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    large = np.abs(y).max(axis=1, initial=0) >= _SMALL
    small = y[~large].astype(np.float64)
    for k in range(0, len(small), _ROWS):
        piece = small[k : k + _ROWS]
        total += (piece.T @ piece).astype(np.int64).astype(object)
    if large.any():
        exact = y[large].astype(object)
        total += exact.T.dot(exact)
    return total


def _covariance(fit: DataFrame, model: Whitening) -> np.ndarray:
    """Covariance with divisor n, each entry rounded once."""
    dims, middle = len(model.sums), model.middle - OFFSET
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), dtype=object)
        for batch in batches:
            total += _products(_unpacked(batch["packed"], dims) - middle)
        i, j = (pa.array(u.astype(np.int32)) for u in upper)
        yield pa.RecordBatch.from_pydict({"i": i, "j": j, "s": _decimals(total[upper].tolist())})

    found = fit.mapInArrow(run, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s"))
    out, rest, n = np.zeros((dims, dims)), model.rest, model.n
    for i, j, s in found.collect():
        out[i, j] = out[j, i] = (n * int(s) - rest[i] * rest[j]) / (n * n)
    return out


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triangular factor with as many columns as the matrix has rank, and the matrix rows its rows stand for: of the
    dimensions left, the one with the most variance left comes next."""
    left, dims = matrix.copy(), len(matrix)
    order, factor = np.arange(dims), np.zeros((dims, dims))
    least = dims * np.finfo(float).eps * np.diag(left).max(initial=0)
    for k in range(dims):
        p = k + int(np.argmax(np.diag(left)[k:]))
        if left[p, p] <= least:
            return factor[:, :k], order
        swap, back = [k, p], [p, k]
        left[swap] = left[back]
        left[:, swap] = left[:, back]
        factor[swap, :k] = factor[back, :k]
        order[swap] = order[back]
        factor[k, k] = np.sqrt(left[k, k])
        factor[k + 1 :, k] = left[k + 1 :, k] / factor[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def _rounds(columns: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns in rounds of disjoint pairs, as in a tournament."""
    players = list(range(columns + columns % 2))
    out = []
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(a, b) for a, b in zip(players[:half], reversed(players[half:]), strict=True) if max(a, b) < columns]
        out.append((np.array([a for a, _ in pairs], dtype=int), np.array([b for _, b in pairs], dtype=int)))
        players = [players[0], players[-1], *players[1:-1]]
    return out


def jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns rotated by pairs until all are orthogonal to working precision."""
    g, close = factor.copy(), max(factor.shape) * np.finfo(float).eps
    rounds = _rounds(factor.shape[1]) if factor.shape[1] > 1 else []
    for _ in range(sweeps):
        worst = 0.0
        for left, right in rounds:
            a, b = g[:, left], g[:, right]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            cosine = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, float(cosine.max()))
            turn = cosine > close
            zeta = np.where(turn, bb - aa, 0) / np.where(turn, 2 * ab, 1)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta)), 0)
            c = 1 / np.hypot(1, t)
            s = c * t
            g[:, left], g[:, right] = c * a - s * b, s * a + c * b
        if worst <= close:
            break
    return g


def principal(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns."""
    factor, order = pivoted_cholesky(covariance)
    turned = jacobi(factor)
    norms = np.sqrt((turned * turned).sum(axis=0))
    first = np.argsort(-norms, kind="stable")[:components]
    vectors = np.empty((len(covariance), len(first)))
    vectors[order] = turned[:, first] / norms[first]
    return norms[first] ** 2, vectors


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance less the identity. Tasks centre their rows at their own mean."""
    dims, middle, k = len(model.sums), model.middle - OFFSET, len(model.values)
    i, j = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, scatter = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.project(_unpacked(batch["packed"], dims) - middle)
            own = w.mean(axis=0)
            gap, m = own - mean, len(w)
            scatter += (w - own).T @ (w - own) + np.outer(gap, gap) * (n * m / (n + m))
            mean, n = mean + gap * (m / (n + m)), n + m
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "s": (scatter + n * np.outer(mean, mean))[i, j], "a": n * mean[i], "b": n * mean[j]})

    total = [F.sum(c).alias(c) for c in ("s", "a", "b")]
    rows = fit.mapInArrow(run, "i int, j int, s double, a double, b double").groupBy("i", "j").agg(*total).collect()
    return max((abs((r.s - r.a * r.b / model.n) / model.n - (r.i == r.j)) for r in rows), default=0.0)


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Whitening learned from the distinct vectors of a column."""
    vectors = written(distinct_vectors(df, column), "whitening-fit")
    common = vectors.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not common:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    dims = common[0].dims
    listed = vectors.filter(F.col("dims") == dims).select("packed")
    n, sums = _sums(listed, dims)
    none = Whitening(n, sums, np.zeros(0), np.zeros((dims, 0)), 0.0)
    covariance = _covariance(listed, none)
    values, vectors_ = principal(covariance, components)
    model = Whitening(n, sums, values, vectors_, float(np.trace(covariance)))
    return Whitening(n, sums, values, vectors_, model.trace, _identity_error(listed, model))


def _deviations(y: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over dimensions of (n * x - sum)^2 for vectors about the middle, exact; none beyond 64 bits."""
    n, rest = model.n, model.rest
    rough = ((n * y.astype(np.float64) - np.array(rest, dtype=np.float64)) ** 2).sum(axis=1)
    sure = rough < 9.0e18
    out: list[int | None] = [None] * len(y)
    if sure.any():
        t = n * y[sure] - np.array(rest, dtype=np.int64)
        for place, total in zip(np.flatnonzero(sure).tolist(), (t * t).sum(axis=1).tolist(), strict=True):
            out[place] = total
    for place in np.flatnonzero(~sure & (rough < 9.5e18)).tolist():
        total = sum((n * v - r) ** 2 for v, r in zip(y[place].tolist(), rest, strict=True))
        out[place] = total if total < 1 << 63 else None
    return out


def whiten(df: DataFrame, model: Whitening, column: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """The id, the deviation and the whitened vector of every row that counts."""
    dims = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = model.middle - OFFSET if dims else None
        for batch in batches:
            for places, matrix in _by_length(batch[column]):
                if matrix.shape[1] != dims:
                    continue
                about = matrix - middle
                whitened = model.project(about)
                ends = pa.array(np.arange(len(places) + 1, dtype=np.int32) * whitened.shape[1])
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch[id_column].take(pa.array(places)),
                        "deviation": pa.array(_deviations(about, model), pa.int64()),
                        "whitened": pa.ListArray.from_arrays(ends, pa.array(whitened.ravel())),
                    }
                )

    rows = df.select(F.col(id_column), F.col(column))
    out = rows.mapInArrow(run, f"id {type_of(df, id_column)}, deviation long, whitened array<double>")
    return out.select(F.col("id").alias(id_column), "deviation", "whitened")
