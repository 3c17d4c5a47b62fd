"""Whitening of embeddings by refined eigenvectors of their covariance.

Vector entries become integers x = floor(scale * entry). The model is fitted
on the distinct x vectors, each once. Sums and products are added up in whole
numbers: products are taken of x less the integer nearest to the mean, and
what that leaves of the mean (half a unit at most) is taken off exactly, so the
covariance has no rounding and does not depend on the order of the rows. Every
task sends one row per pair of dimensions; the driver holds one matrix of
dimension x dimension.

Its eigenvectors come from single precision and are corrected by
Ogita-Aishima iterations, which are matrix products in the widest float of the
machine. Eigenvalues closer than an iteration can tell apart form clusters; a
cluster's vectors are turned by a sub-solve of the covariance within their
span, shifted by the cluster's mean.

Results at the edges: rows whose vector is null or empty, or holds an entry
that is null, not finite, or beyond 2^53 as x, are left out, as are rows whose
vector has not the commonest length (of equally common ones the longest).
Rows with null ids and repeated rows stay, one result each. Components
without variance have a null ``whitened``; where none has any,
``explained`` and ``identity_error`` are null. ``deviation`` beyond 38 digits is null.
An empty table gives an empty result. Only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendgrade.llm.common import bounded_batches, landed, matrix

SCALE = 256
#: |x| below this is exact as a double.
LARGEST = 2**53
WIDE = np.longdouble


def entries(df: DataFrame, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """(id, x) of the rows that take part."""
    v = F.col("v")
    rows = df.select(F.col(f"`{key}`").alias("id"), F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double") * scale).alias("v"))
    # null and NaN entries fail the comparison, as infinite ones do
    sound = (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c) < F.lit(float(LARGEST)), F.lit(False)) & ~F.isnan(c))
    return rows.where(F.coalesce(sound, F.lit(False))).select("id", F.transform(v, lambda c: F.floor(c).cast("bigint")).alias("x"))


def _whole(x: np.ndarray) -> np.ndarray:
    return x.astype(object)


def gram(z: np.ndarray) -> np.ndarray:
    """The exact products z^T z as Python integers."""
    top = int(np.abs(z).max(initial=0))
    if top * top * len(z) < 2**53:  # every partial sum is exact as a double
        f = z.astype(np.float64)
        return _whole((f.T @ f).astype(np.int64))
    w = _whole(z)
    return w.T @ w


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of every dimension, exact."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, dtype=object)
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                n += len(x)
                total += _whole(x.sum(axis=0)) if int(np.abs(x).max()) * len(x) < 2**63 else _whole(x).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], names=["i", "n", "s"])

    rows = fit.mapInArrow(run, "i int, n bigint, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()  # a row per dimension
    by = {r["i"]: r for r in rows}
    return (by[0]["n"], [int(by[i]["s"]) for i in range(dim)]) if by else (0, [0] * dim)


def _products(fit: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Sums of the products of (x - centre), exact."""
    import pyarrow as pa

    dim = len(centre)
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), dtype=object)
        some = False
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                some = True
                total += gram(x - centre)
        if some:
            values = pa.array([Decimal(int(t)) for t in total[upper]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), values], names=["i", "j", "c"])

    out = np.zeros((dim, dim), dtype=object)
    for r in fit.mapInArrow(run, "i int, j int, c decimal(38,0)").groupBy("i", "j").agg(F.sum("c").alias("c")).collect():  # a row per pair of dimensions
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = int(r["c"])
    return out


def _wide(numerators: np.ndarray, denominator: int) -> np.ndarray:
    """Exact fractions in the widest float: quotient and remainder apart."""
    out = np.zeros(numerators.shape, dtype=WIDE)
    for at, v in np.ndenumerate(numerators):
        v, sign = abs(int(v)), -1 if v < 0 else 1
        shift = max(0, 70 + denominator.bit_length() - v.bit_length())
        q = (v << shift) // denominator  # 70 bits or more
        high = q >> 35
        out[at] = sign * np.ldexp(np.ldexp(WIDE(high >> 35), 35) + WIDE(high & (2**35 - 1)) + np.ldexp(WIDE(q & (2**35 - 1)), -35), 35 - shift)
    return out


def refine(a: np.ndarray, x: np.ndarray, iterations: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of the symmetric ``a`` from approximate
    eigenvectors ``x``, by Ogita-Aishima iterations in the precision of ``a``;
    close eigenvalues by sub-solves."""
    x = x.astype(a.dtype)
    eye = np.eye(len(a), dtype=a.dtype)
    eps = np.finfo(a.dtype).eps
    size = np.sqrt((a * a).sum())
    value = np.diag(a).copy()
    for _ in range(iterations):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        # no gap below the rounding of s can be divided by
        close = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum())) + 2 * len(a) * eps * size
        gap = value[None, :] - value[:, None]
        far = np.abs(gap) > close
        e = np.where(far, (s + value[None, :] * r) / np.where(far, gap, 1), r / 2)
        x = x + x @ e
        order = np.argsort(-value, kind="stable")
        x, value = x[:, order], value[order]
        turned = False
        for i, j in _clusters(value, close):
            own = x[:, i:j]
            mid = value[i:j].mean()
            b = own.T @ (a @ own - mid * own)
            b = (b + b.T) / 2
            if np.abs(b - np.diag(np.diag(b))).max() > 8 * eps * size:  # else as good as diagonal
                b = b / np.abs(b).max()
                x[:, i:j] = own @ np.linalg.eigh(b.astype(np.float64))[1][:, ::-1].astype(a.dtype)
                turned = True
        if not turned and np.abs(e).max() < 64 * eps:
            break
    for _ in range(3):  # gaps near the rounding leave vectors a little askew
        x = x + x @ (eye - x.T @ x) / 2
    value = ((a @ x) * x).sum(axis=0) / (x * x).sum(axis=0)
    order = np.argsort(-value, kind="stable")
    x = x[:, order] / np.sqrt((x * x).sum(axis=0))[order]
    return value[order], x


def _clusters(value: np.ndarray, close) -> list[tuple[int, int]]:
    """Runs [i, j) of falling values whose neighbours are within ``close``."""
    ends = np.flatnonzero(np.abs(np.diff(value)) > close) + 1
    bounds = [0, *ends.tolist(), len(value)]
    return [(i, j) for i, j in zip(bounds, bounds[1:]) if j - i > 1]


def eigen(numerators: np.ndarray, denominator: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling), eigenvectors (columns, their greatest entry
    positive) and trace of a covariance in exact fractions."""
    top = max((abs(int(v)) for v in numerators.flat), default=0)
    if not top:
        return np.zeros(len(numerators)), np.eye(len(numerators)), 0.0
    power = top.bit_length() - denominator.bit_length()  # brings the entries near 1
    a = _wide(numerators, denominator << power if power >= 0 else denominator)
    if power < 0:
        a = np.ldexp(a, -power)
    first = np.linalg.eigh(a.astype(np.float32))[1]
    value, vectors = refine(a, first)
    vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None, :], 0)[0] < 0, -1, 1)
    grow = lambda v: np.ldexp(np.asarray(v, dtype=WIDE), power).astype(np.float64)
    return grow(value), vectors.astype(np.float64), float(grow(np.trace(a)))


@dataclass
class Whitening:
    """Number and sums of the fitted vectors, eigenvalues (falling),
    eigenvectors (columns), trace, and the number of components with variance
    (of those asked for)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    rank: int

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of the rows of ``x``, by component; NaN without variance."""
        k = len(self.values)
        out = np.full((len(x), k), np.nan)
        z = self.centred(x)
        z = z.astype(np.float64) / self.n
        out[:, : self.rank] = z @ self.vectors[:, : self.rank] / np.sqrt(self.values[: self.rank])
        return out

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S in whole numbers (Python integers where 64 bits do not do)."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most < 2**62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * _whole(x) - np.array(self.sums, dtype=object)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Exact sums of (n * x - S)^2 of the rows."""
        z = self.centred(x)
        if z.dtype == object or int(np.abs(z).max(initial=0)) ** 2 * z.shape[1] >= 2**63:
            z = _whole(z)
        return (z * z).sum(axis=1).tolist()


def fit(vectors: DataFrame, dim: int, components: int) -> Whitening | None:
    """The model of distinct vectors (column ``x``) of length ``dim``."""
    n, sums = _sums(vectors, dim)
    if not n:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    left = np.array([s - n * int(m) for s, m in zip(sums, centre)], dtype=object)
    # sum (x - S/n)(x - S/n)^T / n = (n * products - left left^T) / n^2
    value, vector, trace = eigen(n * _products(vectors, centre) - np.outer(left, left), n * n)
    k = min(components, dim)
    rank = int((value[:k] > dim * np.finfo(np.float64).eps * trace).sum()) if trace > 0 else 0
    return Whitening(n, sums, np.maximum(value[:k], 0), vector[:, :k], trace, rank)


def identity_error(vectors: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance (centred
    before multiplying) less the identity, over the fitted vectors."""
    import pyarrow as pa

    k = model.rank
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                w = model.project(x)
                yield pa.RecordBatch.from_arrays([pa.array(w[:, c]) for c in range(k)], names=names)

    names = [f"w{c}" for c in range(k)]
    w = landed(vectors.mapInArrow(run, ", ".join(f"{c} double" for c in names)), "whitened")
    mean = w.agg(*[F.avg(c).alias(c) for c in names]).first()
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    cov = w.agg(*[F.avg((F.col(a) - mean[a]) * (F.col(b) - mean[b])).alias(f"{a}{b}") for a, b in pairs]).first()
    return max(abs(cov[f"{a}{b}"] - (a == b)) for a, b in pairs)


def whiten(df: DataFrame, components: int = 4, scale: int = SCALE, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key``, component, n, deviation, whitened, explained, identity_error:
    a row for every row that takes part and each of the first ``components``
    components (the dimension, if less)."""
    import pyarrow as pa

    spark = df.sparkSession
    bounded_batches(spark)
    rows = entries(df, vector, key, scale)
    kind = dict(rows.dtypes)["id"]
    schema = f"`{key}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    commonest = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if commonest is None:
        return spark.createDataFrame([], schema)
    dim = commonest["dim"]
    rows = rows.where(F.size("x") == dim)
    distinct = landed(rows.select("x").distinct(), "distinct")
    model = fit(distinct, dim, components)
    error = identity_error(distinct, model)
    k = len(model.values)
    explained = [float(v / model.trace) if model.trace > 0 else None for v in model.values]
    types = [pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.float64(), pa.float64(), pa.float64()]
    names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            far = [Decimal(d) if d < 10**38 else None for d in model.deviation(x)]
            w = model.project(x)
            for c in range(k):
                some = [pa.array([v] * len(x), t) for v, t in ((c + 1, types[0]), (model.n, types[1]))]
                rest = [pa.array([v] * len(x), types[4]) for v in (explained[c], error)]
                white = pa.array(w[:, c], types[3], from_pandas=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), *some, pa.array(far, types[2]), white, *rest], names=names)

    return rows.select("id", "x").mapInArrow(run, schema)
