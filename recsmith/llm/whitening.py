"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Components become whole numbers x = floor(scale * c) + shift, so counts n and sums S are exact.  The covariance
V = sum (x - S/n)(x - S/n)' / n is summed per partition from differences taken before multiplying (n x - S is exact), in a
tree of partial matrices; what reaches the driver is one matrix of dim x dim numbers a vector length.

V is factored as P V P' = L L' with diagonal pivoting, which stops at the numerical rank, so directions without
variance never enter.  One-sided Jacobi then turns the columns of L directly (never the product again, which would square
its condition) until they are orthogonal: L J = U D.  Hence V = (P'U) D^2 (P'U)': the squared norms of the turned columns
are the eigenvalues, the normalised columns, back in the original order, the components.

Whitened values are projections of x - S/n on a component over the root of its eigenvalue.  The identity error is read
from the whitened values themselves: their covariance is summed per partition around the partition's own mean and merged.

Defined cases: vectors that are NULL or hold NULL or non-finite entries are dropped; vectors of different lengths are
whitened apart, each length with its own fit list; a length has at most as many components as its covariance has rank
(one vector, or equal vectors only: none, so they yield no rows); components of equal variance are any orthonormal basis of
their space, the same for all rows; repeated rows and NULL ids pass through; an empty table gives an empty result;
further columns are ignored.  A deviation beyond the long range raises OverflowError.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.llm.common import read_table
from recsmith.session import materialize

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Partial matrices meet in this many groups a vector length, then in one.
GROUPS = 16
_LONG = 2 ** 63


def whole_vectors(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vectors (vec_id, embedding, ..) -> vec_id, x array<long>, dim; unusable rows go."""
    x = F.col("embedding")
    fine = x.isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long") + F.lit(shift).cast("long"))
    return vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"), F.size(x).alias("dim"))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows of the batch with it, their vectors as a matrix of whole numbers)."""
    x, dims = batch.column("x"), np.asarray(batch.column("dim"))
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        if d:
            yield int(d), at, np.asarray(x.take(pa.array(at)).flatten(), np.int64).reshape(-1, d)


# ---- the factorisation -----------------------------------------------------

def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): v[order][:, order] = L L', L lower trapezoidal with as many columns as v has numerical rank."""
    n = len(v)
    order, left = np.arange(n), v.astype(np.float64).copy()
    factor = np.zeros((n, n))
    least = n * np.finfo(float).eps * max(0.0, v.diagonal().max(initial=0.0))
    for k in range(n):
        p = k + int(np.argmax(left.diagonal()[k:]))
        if left[p, p] <= least:
            return factor[:, :k], order
        if p != k:
            for m in (left, factor):
                m[[k, p]] = m[[p, k]]
            left[:, [k, p]] = left[:, [p, k]]
            order[[k, p]] = order[[p, k]]
        root = np.sqrt(left[k, k])
        factor[k, k] = root
        factor[k + 1:, k] = left[k + 1:, k] / root
        left[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def _rounds(r: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each pair of r columns once, in rounds of disjoint pairs (a round-robin tournament)."""
    seats = list(range(r)) + [-1] * (r % 2)
    m = len(seats)
    for _ in range(m - 1):
        pairs = [(seats[i], seats[m - 1 - i]) for i in range(m // 2)]
        pairs = [(min(p), max(p)) for p in pairs if -1 not in p]
        yield np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)
        seats = [seats[0], seats[-1], *seats[1:-1]]


def one_sided_jacobi(a: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``a`` turned against each other until they are orthogonal, longest first.

    A rotation that makes two columns orthogonal leaves the others alone, so the disjoint pairs of a round turn at once."""
    a = a.copy()
    small = np.finfo(float).eps * max(1, len(a)) ** 0.5
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(a.shape[1]):
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            todo = np.abs(xy) > small * np.sqrt(xx * yy)
            if not todo.any():
                continue
            turned = True
            with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
                zeta = (yy - xx) / (2 * xy)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(todo, t, 0.0)
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            a[:, p], a[:, q] = c * x - s * y, s * x + c * y
        if not turned:
            break
    else:
        raise RuntimeError(f"the columns are not orthogonal after {sweeps} sweeps")
    return a[:, np.argsort(-(a * a).sum(axis=0), kind="stable")]


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a covariance, as many as its numerical rank."""
    scale = float(np.abs(v).max(initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((len(v), 0))
    factor, order = pivoted_cholesky(v / scale)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(axis=0))
    vectors = np.zeros_like(turned)
    vectors[order] = turned / norms
    return norms * norms * scale, vectors


# ---- on tables -------------------------------------------------------------

def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """parts (dim, part, m binary doubles) -> the sum by dim, added in the order of the partitions, in two steps."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        total = sum(np.frombuffer(m) for m in pdf["m"])
        return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "part": [pdf["part"].iloc[0]], "m": [total.tobytes()]})

    schema = "dim int, part int, m binary"
    some = (parts.withColumn("g", F.col("part") % GROUPS).groupBy("dim", "g").applyInPandas(add, schema)
            .groupBy("dim").applyInPandas(add, schema))
    return {r["dim"]: np.frombuffer(r["m"]) for r in some.toLocalIterator()}  # one row of dim^2 numbers a vector length


@dataclass
class Whitening:
    """The fit of one vector length: exact n and S, all eigenvalues and unit components (as columns), the trace of V."""
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray
    scale: int = SCALE
    shift: int = SHIFT

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S of rows x, exact."""
        if x.size and self.n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, self.sums)) >= _LONG:
            return x.astype(object) * self.n - np.array(self.sums, object)
        return x * self.n - np.array(self.sums, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n

    def whiten(self, x: np.ndarray, k: int) -> np.ndarray:
        return (self.centred(x) @ self.components[:, :k]) / np.sqrt(self.values[:k])

    def squares(self, x: np.ndarray) -> list[int]:
        """The sum over dimensions of (n x - S)^2 of each row, exact."""
        d = self.deviations(x)
        if d.dtype == object or (d.size and float(np.abs(d).max()) ** 2 * d.shape[1] >= _LONG):
            out = [sum(int(e) * int(e) for e in row) for row in d]
            if any(s >= _LONG for s in out):
                raise OverflowError("a deviation beyond the long range")
            return out
        return (d * d).sum(axis=1).tolist()


def fit(rows: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> dict[int, Whitening]:
    """rows (x, dim, ..) of whole_vectors -> the fit by vector length."""
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for d, at, x in _by_length(b):
                n[d] = n.get(d, 0) + len(at)
                sums[d] = sums.get(d, 0) + x.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"dim": pa.array(list(n), pa.int32()), "n": pa.array(list(n.values()), pa.int64()),
                                          "s": pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))})

    each = rows.select("x", "dim").mapInArrow(totals, "dim int, n long, s array<long>")
    # one row a vector length and dimension reaches the driver
    total = each.select("dim", "n", F.posexplode("s").alias("at", "s")).groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    fits: dict[int, Whitening] = {}
    for r in total.orderBy("dim", "at").toLocalIterator():
        f = fits.setdefault(r["dim"], Whitening(r["n"], [], 0.0, np.zeros(0), np.zeros((r["dim"], 0)), scale, shift))
        f.sums.append(r["s"])

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in _by_length(b):
                c = fits[d].centred(x)
                sums[d] = sums.get(d, 0) + c.T @ c
        yield pa.RecordBatch.from_pydict({"dim": pa.array(list(sums), pa.int32()), "part": pa.array([TaskContext.get().partitionId()] * len(sums), pa.int32()),
                                          "m": pa.array([m.tobytes() for m in sums.values()], pa.binary())})

    for d, m in _summed(rows.select("x", "dim").mapInArrow(scatter, "dim int, part int, m binary")).items():
        v = m.reshape(d, d) / fits[d].n
        v = (v + v.T) / 2
        fits[d].values, fits[d].components = eigen(v)
        fits[d].trace = float(np.trace(v))
    return fits


def _merged(a: tuple, b: tuple) -> tuple:
    """(n, mean, centred sums of products) of two sets together."""
    n = a[0] + b[0]
    step = b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)


def identity_errors(rows: DataFrame, fits: dict[int, Whitening], k: int = COMPONENTS) -> dict[int, float]:
    """The largest absolute entry of the whitened values' covariance less the identity, by vector length."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        got: dict[int, tuple] = {}
        for b in batches:
            for d, _, x in _by_length(b):
                w = fits[d].whiten(x, k)
                if w.shape[1]:
                    mean = w.mean(axis=0)
                    own = len(w), mean, (w - mean).T @ (w - mean)
                    got[d] = _merged(got[d], own) if d in got else own
        packed = [np.concatenate([[n], mean, m.ravel()]).tobytes() for n, mean, m in got.values()]
        yield pa.RecordBatch.from_pydict({"dim": pa.array(list(got), pa.int32()), "part": pa.array([TaskContext.get().partitionId()] * len(got), pa.int32()),
                                          "m": pa.array(packed, pa.binary())})

    def unpacked(m: bytes) -> tuple:
        a = np.frombuffer(m)
        width = int(np.sqrt(len(a)))  # 1 + w + w^2 numbers
        return a[0], a[1:width + 1], a[width + 1:].reshape(width, width)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = None
        for m in pdf.sort_values("part")["m"]:
            total = unpacked(m) if total is None else _merged(total, unpacked(m))
        packed = np.concatenate([[total[0]], total[1], total[2].ravel()]).tobytes()
        return pd.DataFrame({"dim": [pdf["dim"].iloc[0]], "part": [pdf["part"].min()], "m": [packed]})

    schema = "dim int, part int, m binary"
    merged = (rows.select("x", "dim").mapInArrow(moments, schema).withColumn("g", F.col("part") % GROUPS)
              .groupBy("dim", "g").applyInPandas(merge, schema).groupBy("dim").applyInPandas(merge, schema))
    out = {}
    for r in merged.toLocalIterator():  # one row a vector length
        n, _, m = unpacked(r["m"])
        out[r["dim"]] = float(np.abs(m / n - np.eye(len(m))).max(initial=0.0))
    return out


def transform(rows: DataFrame, fits: dict[int, Whitening], k: int = COMPONENTS) -> DataFrame:
    """rows (vec_id, x, dim) -> vec_id, dim, n, deviation, whitened array<double>; lengths without a fit have NULLs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, at, x in _by_length(b):
                f = fits.get(d)
                found = ([f.n] * len(at), f.squares(x), f.whiten(x, k).tolist()) if f else ([None] * len(at),) * 3
                yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(at)), pa.array([d] * len(at), pa.int32()),
                                                  pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.list_(pa.float64()))],
                                                 names=["vec_id", "dim", "n", "deviation", "whitened"])

    return rows.select("vec_id", "x", "dim").mapInArrow(run, "vec_id long, dim int, n long, deviation long, whitened array<double>")


def by_length(name: str, values: dict[int, float]) -> Callable[[DataFrame], DataFrame]:
    """Adds a column with one value a vector length (their number is that of the models, not of the rows)."""
    def add(df: DataFrame) -> DataFrame:
        found = F.lit(None).cast("double")
        for d, v in values.items():
            found = F.when(F.col("dim") == d, F.lit(v)).otherwise(found)
        return df.withColumn(name, found)
    return add


def whiten(vectors: DataFrame, k: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vectors (vec_id, embedding, ..) -> vec_id, component, n, deviation, whitened, explained, identity_error:
    a row for each vector and component up to ``k``."""
    rows = materialize(whole_vectors(vectors, scale, shift))
    fits = fit(rows, scale, shift)
    errors = identity_errors(rows, fits, k)
    long = transform(rows, fits, k).select("vec_id", "dim", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    long = long.withColumn("component", (F.col("at") + 1).cast("int")).transform(by_length("identity_error", errors))
    explained = F.lit(None).cast("double")
    for d, f in fits.items():  # at most ``k`` shares a vector length
        for j, e in enumerate(f.values[:k]):
            explained = F.when((F.col("dim") == d) & (F.col("at") == j), F.lit(float(e / f.trace))).otherwise(explained)
    return long.withColumn("explained", explained).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every vector and its first 8 components."""
    return whiten(read_table(spark, sf_dir, "embeddings"))
