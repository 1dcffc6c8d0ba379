"""Embedding whitening by shifted CholeskyQR.

Centred rows A are never factored as a whole. A pass adds up the Gram matrix over all partitions, takes its Cholesky factor, and the
next pass works on rows solved against all factors so far. The first factor is of the Gram matrix plus a small shift, so it
exists however close to dependent the columns are; later passes repair what the shift and rounding did, until the rows are
orthonormal. The factors multiplied give R of A = QR, and the singular values and right vectors of R are those of A: roots of n times the
eigenvalues, and the components.

Rows are centred before they are multiplied. Gram matrices are added row by row in the executors; the driver sees one matrix
of dimensions squared, which does not grow with the rows. Equal vectors are made one before the first pass, by combining aggregation.

Defined cases: rows whose vector is null, empty, or has null or non-finite entries go; vectors of different lengths are an error;
repeated rows and null ids keep a row each; no rows, or no variance, give an empty table; directions without variance are no
components; sums beyond 64 bits are an error; other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.session import pin, ship_package

PASSES = 6  # two after the shifted one are enough unless columns depend on each other
_EPS = np.finfo(float).eps
_ROWS = "i int, row array<double>"


def grid(vector: Column, step: int = 256) -> Column:
    """Entries as whole numbers, floor(step * entry); null if the vector is not to be used."""
    v = vector.cast("array<double>")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when((F.size(v) > 0) & sound, F.transform(v, lambda c: F.floor(c * step).cast("long")))


def _matrix(lists: pa.Array, kind=np.float64) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1).astype(kind)


def _as_rows(m: np.ndarray) -> pa.RecordBatch:
    offsets = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)
    return pa.record_batch([pa.array(np.arange(len(m), dtype=np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.reshape(-1)))], ["i", "row"])


def solved(y: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of each upper factor in turn, by forward substitution on the transposes."""
    for r in factors:
        q = np.empty_like(y)
        for j in range(y.shape[1]):
            q[:, j] = (y[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        y = q
    return y


def _gram(mean: np.ndarray, factors: list[np.ndarray], weights: np.ndarray | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            q = solved(_matrix(batch.column("x")) - mean, factors)
            q = q if weights is None else q @ weights
            total = q.T @ q + (0 if total is None else total)
    if total is not None:
        yield _as_rows(total)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, row in zip(batch.column("i").to_pylist(), _matrix(batch.column("row")) if batch.num_rows else (), strict=True):
            sums[i] = sums.get(i, 0) + row
    for i, row in sums.items():
        yield pa.record_batch([pa.array([i], pa.int32()), pa.array([row], pa.list_(pa.float64()))], ["i", "row"])


def gram(fit: DataFrame, mean: np.ndarray, factors: list[np.ndarray], weights: np.ndarray | None = None) -> np.ndarray:
    """Gram matrix of the centred rows solved against the factors (and multiplied by weights): dimensions squared, whatever the rows."""
    parts = fit.select("x").mapInArrow(partial(_gram, mean, factors, weights), _ROWS)
    rows = parts.repartition("i").mapInArrow(_added, _ROWS).collect()
    return np.array([r.row for r in sorted(rows, key=lambda r: r.i)])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total, least, most = 0, None, None, None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("x"), np.int64)
            n += len(x)
            total = x.sum(0) + (0 if total is None else total)
    if n:
        yield pa.record_batch([pa.array([n], pa.int64()), pa.array([total], pa.list_(pa.int64()))], ["n", "s"])


@dataclass
class Whitener:
    n: int
    sums: list[int]  # per dimension, exact
    components: np.ndarray  # one per row, unit length, by falling eigenvalue
    values: np.ndarray
    trace: float
    passes: int  # Gram passes taken
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # whole numbers are divided with one rounding


def shifted_qr(fit: DataFrame, mean: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """R of the centred rows, and the number of passes."""
    d, factors, r = len(mean), [], np.eye(len(mean))
    for taken in range(1, PASSES + 1):
        g = gram(fit, mean, factors)
        if not g.any():  # nothing varies
            return g, taken
        if factors and np.abs(g - np.eye(d)).max() < 8 * d * _EPS:
            break
        shift = 11 * (n * d + d * (d + 1)) * _EPS * np.linalg.norm(g, 2) if not factors else 0.0
        while True:
            try:
                factor = np.linalg.cholesky(g + shift * np.eye(d)).T
                break
            except np.linalg.LinAlgError:  # dependent columns: a later pass needs a shift as well
                if not np.isfinite(g).all():
                    raise
                shift = max(shift * 16, 4 * d * _EPS * np.linalg.norm(g, 2))
        factors.append(factor)
        r = factor @ r
    return r, taken


def fit_whitener(fit: DataFrame, components: int) -> Whitener | None:
    """From a table of distinct vectors x; None if there are no rows or none that vary."""
    totals = fit.select("x").mapInArrow(_sum, "n long, s array<bigint>")
    lengths = totals.agg(F.count_distinct(F.size("s")), F.sum("n")).first()
    if not lengths[1]:
        return None
    n = lengths[1]
    place = totals.select(F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect()
    sums = [r.s for r in sorted(place, key=lambda r: r.i)]
    mean = np.array([s / n for s in sums])
    r, passes = shifted_qr(fit, mean, n)
    _, sigma, w = np.linalg.svd(r)
    values = sigma**2 / n
    real = int((sigma > len(sums) * np.sqrt(n) * _EPS * sigma[0]).sum()) if sigma[0] > 0 else 0
    if not real:
        return None
    k = min(components, real)
    found = Whitener(n, sums, w[:k], values[:k], float(values.sum()), passes, 0.0)
    spread = gram(fit, mean, [], found.components.T / np.sqrt(found.values)) / n
    found.identity_error = float(np.abs(spread - np.eye(k)).max())
    return found


def _project(w: Whitener, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scale = w.components.T / np.sqrt(w.values)
    sums, mean, k = np.array(w.sums, np.int64), w.mean, len(w.values)
    explained = w.values / w.trace
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column("x"), np.int64)
        z = (x - mean) @ scale
        if (np.abs(w.n * x.astype(float) - sums) ** 2).sum(1).max() >= 2.0**63:
            raise OverflowError("the deviation does not fit 64 bits")
        away = w.n * x - sums
        deviation = (away * away).sum(1)
        rows = len(x)
        yield pa.record_batch(
            [batch.column("key").take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
             pa.array(np.full(rows * k, w.n)), pa.array(np.repeat(deviation, k)), pa.array(z.reshape(-1)), pa.array(np.tile(explained, rows)),
             pa.array(np.full(rows * k, w.identity_error))],
            ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """key, component, n, deviation, whitened, explained and identity_error for each usable row and component."""
    spark = rows.sparkSession
    ship_package(spark)
    usable = pin(rows.select(F.col(f"`{key}`").cast("long").alias("key"), grid(F.col(f"`{vector}`")).alias("x")).where("x IS NOT NULL"))
    ragged = usable.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if ragged[0] != ragged[1]:
        raise ValueError(f"vectors of {ragged[0]} to {ragged[1]} entries")
    whitener = fit_whitener(pin(usable.select("x").distinct()), components)
    schema = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = spark.createDataFrame([], schema) if whitener is None else usable.mapInArrow(partial(_project, whitener), schema)
    return found.withColumnRenamed("key", key)
