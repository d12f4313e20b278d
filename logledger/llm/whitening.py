"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the factor.

Entries become integers, so equal vectors are equal and sums are exact.  Spark
finds the different vectors, their sums and the scatter of their differences
from the mean; the scatter, as wide as a vector, is factored on the driver.
The columns of its triangular factor, rotated until they are orthogonal, are
the principal components: their squared norms are the eigenvalues.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the query contract: entries are floor(256 c), four components are returned.
SCALE, COMPONENTS = 256, 4
SAFE = 1 << 61  # integers up to here can be subtracted as 64-bit numbers
OUT = ("component int, n long, deviation long, whitened double, explained double, identity_error double,"
       " squared_distance double")


def integer_vectors(vectors: DataFrame, key: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """(_id, _x): the vectors with finite entries only, as integers floor(scale * c), clamped to a long."""
    v = vectors.select(F.col(key).alias("_id"), F.col(embedding).cast("array<double>").alias("_v"))
    finite = F.forall("_v", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return v.filter(F.col("_v").isNotNull() & finite).select(
        "_id", F.transform("_v", lambda c: F.floor(c * float(scale)).cast("long")).alias("_x"))


def _matrix(b: pa.RecordBatch, dims: int) -> np.ndarray:
    return b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(dims: int):
    """Rows (dim, n, high, low) of a partition: the sums of the entries' upper and lower 32 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for b in batches:
            x = _matrix(b, dims)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(np.full(dims, n)), pa.array(high), pa.array(low)],
                                         names=["dim", "n", "high", "low"])
    return run


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n as doubles, subtracted as integers."""
    whole = [s // n for s in sums]
    rest = np.array([(s % n) / n for s in sums])
    if x.size and max(abs(int(x.min())), abs(int(x.max())), *map(abs, whole)) >= SAFE:
        return (x.astype(object) - np.array(whole, object)).astype(np.float64) - rest
    return (x - np.array(whole, np.int64)).astype(np.float64) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sums over dimensions of (n x - sums)^2; null beyond a long."""
    largest = max([abs(int(x.min())), abs(int(x.max()))]) if x.size else 0
    if x.shape[1] * (n * largest + max(map(abs, sums), default=0)) ** 2 < 1 << 63:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    d = x.astype(object) * n - np.array(sums, object)
    return [int(v) if v < 1 << 63 else None for v in (d * d).sum(axis=1)]


def _scatter(dims: int, n: int, sums: list[int]):
    """Rows (i, j, value) of a partition's sum of centred products, for i <= j."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for b in batches:
            c = centred(_matrix(b, dims), n, sums)
            total += c.T @ c
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "value"])
    return run


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """B with B B' = a, for a positive semidefinite: a triangular factor with its rows in the order of ``a``.

    The largest remaining diagonal entry is taken in turn, until it is nothing
    but rounding; B has as many columns as were taken.
    """
    rest, size = a.copy(), len(a)
    order, factor = np.arange(size), np.zeros(a.shape)
    least = size * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(size):
        p = k + int(rest.diagonal()[k:].argmax())
        if rest[p, p] <= least:
            size = k
            break
        for m in (rest, rest.T, factor):
            m[[k, p]] = m[[p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1:, k] = rest[k + 1:, k] / factor[k, k]
        rest[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    out = np.empty((len(a), size))
    out[order] = factor[:, :size]
    return out


def jacobi(b: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``b`` times a rotation, with orthogonal columns by falling norm.

    A sweep pairs every two columns once, in rounds of disjoint pairs that are
    rotated together; sweeps go on until no pair needs a rotation.
    """
    b, size = b.copy(), b.shape[1]
    ring = np.arange(size + size % 2)
    tiny = np.finfo(float).eps * max(1, len(b)) ** 0.5
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            p, q = ring[:len(ring) // 2], ring[:len(ring) // 2 - 1:-1]
            real = (p < size) & (q < size)
            p, q = p[real], q[real]
            x, y = b[:, p], b[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            needed = np.abs(xy) > tiny * np.sqrt(xx * yy)
            if needed.any():
                turned = True
                zeta = (yy - xx)[needed] / (2 * xy[needed])
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                cos = 1 / np.hypot(1, t)
                sin = cos * t
                x, y = x[:, needed], y[:, needed]
                b[:, p[needed]], b[:, q[needed]] = cos * x - sin * y, sin * x + cos * y
            ring = np.r_[ring[:1], ring[-1:], ring[1:-1]]
        if not turned:
            break
    return b[:, np.argsort(-(b * b).sum(axis=0), kind="stable")]


def principal_components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue, of those that aren't zero.

    A component's largest entry is positive, the first such if there are several.
    """
    b = jacobi(pivoted_cholesky(scatter))
    norms = np.sqrt((b * b).sum(axis=0))
    b, norms = b[:, norms > 0], norms[norms > 0]
    units = b / norms
    units *= np.sign(units[np.abs(units).argmax(axis=0), np.arange(len(norms))])
    return norms ** 2, units


def _project(dims: int, n: int, sums: list[int], by: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = centred(_matrix(b, dims), n, sums) @ by
            yield pa.RecordBatch.from_arrays([pa.array(col) for col in z.T], names=[f"z{k}" for k in range(by.shape[1])])
    return run


def _rows(dims: int, n: int, sums: list[int], by: np.ndarray, explained: list[float | None], error: float | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b, dims)
            c, count, found = centred(x, n, sums), len(x), by.shape[1]
            z, far, square = c @ by, pa.array(deviations(x, n, sums), pa.int64()), pa.array((c * c).sum(axis=1))
            for k, share in enumerate(explained):
                whitened = pa.array(z[:, k]) if k < found else pa.nulls(count, pa.float64())
                yield pa.RecordBatch.from_arrays([
                    b.column("_id"), pa.array(np.full(count, k + 1, np.int32)), pa.array(np.full(count, n)), far, whitened,
                    pa.array([share] * count, pa.float64()), pa.array([error] * count, pa.float64()), square],
                    names=["_id", *[f.split()[0] for f in OUT.split(", ")]])
    return run


def whiten(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """One row per vector and component: key, component, n, deviation, whitened, explained, identity_error, squared_distance.

    The fit list is each different integer vector once, n in number, with sums
    S; ``deviation`` is the exact sum over dimensions of (n x - S)^2, null where
    that exceeds a long (``squared_distance``, the same over n^2, is a double),
    ``whitened`` is x - S / n projected on the component over the root of its
    eigenvalue, ``explained`` the eigenvalue's share of the trace, and
    ``identity_error`` how far the fit list's whitened covariance is from the
    identity.

    Vectors that are null or hold null or non-finite entries are left out; a
    shorter vector is filled with zeros to the longest one's length; entries
    beyond a long are clamped.  Repeated rows are fitted once and each returned;
    keys can be null or repeat.  Components end with the vectors' length; those
    without variance have null ``whitened``, and without any variance
    ``explained`` and ``identity_error`` are null too.  An empty table, or empty
    vectors only, give an empty result.  Other columns don't matter.

    The driver holds one matrix as wide as a vector, whatever the rows.
    """
    given = integer_vectors(vectors, key, embedding, scale)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"_id {kind}, {OUT}"
    dims = given.agg(F.max(F.size("_x"))).first()[0] or 0
    if not dims:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("_id", key)
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("_x"))
    given = given.withColumn("_x", F.concat("_x", zeros))
    fit = given.select("_x").distinct().checkpoint()

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    totals = fit.mapInArrow(_sums(dims), "dim long, n long, high long, low long").groupBy("dim").agg(
        wide("n"), wide("high"), wide("low")).orderBy("dim").collect()
    n, sums = int(totals[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in totals]

    scatter = np.zeros((dims, dims))
    for r in fit.mapInArrow(_scatter(dims, n, sums), "i long, j long, value double").groupBy("i", "j").agg(
            F.sum("value").alias("value")).collect():
        scatter[r["i"], r["j"]] = scatter[r["j"], r["i"]] = r["value"]
    values, units = principal_components(scatter)
    values, units = values[:components], units[:, :components]
    by = units / np.sqrt(values / n)

    trace, error, k = float(np.trace(scatter)), None, len(values)
    if k:
        z = fit.mapInArrow(_project(dims, n, sums, by), ", ".join(f"z{i} double" for i in range(k)))
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        cov = z.agg(*[F.covar_pop(f"z{i}", f"z{j}") for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs, strict=True))
    shares = [float(values[i]) / trace if i < k else (0.0 if trace else None) for i in range(min(components, dims))]
    out = given.mapInArrow(_rows(dims, n, sums, by, shares, error), schema)
    return out.withColumnRenamed("_id", key)
