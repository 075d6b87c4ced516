"""Whitening of embeddings on components refined from float32 to double precision."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgewatch.llm.common import saved

#: Entries become floor(SCALE * c).
SCALE = 256
#: Entries beyond this, either sign, count as this, so that numbers stay exact.
LARGEST = float(1 << 22)
#: Longest vector: the driver holds some matrices of this size squared.
MAX_DIM = 2048
#: Components that are returned.
COMPONENTS = 4
#: Eigenvalues closer than this share of the largest are left to their cluster's own
#: eigenproblem: a correction would be larger than the rounding it squares to.
CLOSE = float(np.sqrt(np.finfo(float).eps))
#: Rounds of refinement at most; four or five are usual.
ROUNDS = 20

OUT = """vec_id bigint, component int, n bigint, deviation bigint, whitened double,
    explained double, identity_error double"""
PARTS = "i int, part binary"


@dataclass
class Components:
    """What a row needs to be whitened: ``vectors`` has a component per column."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def scales(self) -> np.ndarray:
        """One over the square roots of the eigenvalues; NaN where there is no variance."""
        least = len(self.sums) * np.finfo(float).eps * self.trace
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(self.values > least, 1 / np.sqrt(self.values), np.nan)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.sums / self.n) @ self.vectors * self.scales


def integers(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """``vec_id, x`` of usable rows: no null or non-finite entry; ``x`` has ``dim`` integers.

    Shorter vectors are filled up with zeros.
    """
    entries = F.col("embedding").cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    top = F.lit(LARGEST)
    x = F.transform(
        entries, lambda c: F.floor(SCALE * F.greatest(F.least(c, top), -top)).cast("int")
    )
    rows = vectors.where(F.col("embedding").isNotNull() & ~bad)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x"))
    if dim is None:
        return rows
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0), dim - F.size("x"))))


def matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The batch's ``x`` as rows of a matrix."""
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, dim)


def summed(
    fit: DataFrame, dim: int, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray], dtype: type
) -> np.ndarray:
    """Sum over the fit list of ``part`` of its rows, a matrix of ``shape``.

    Each task adds up its own rows and sends the matrix row by row; the rows
    of all tasks are added by Spark, not by the driver.
    """

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, dtype)
        for batch in batches:
            total += part(matrix(batch, dim))
        yield packed(range(shape[0]), total)

    def packed(numbers, rows) -> pa.RecordBatch:
        values = [np.asarray(row).tobytes() for row in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(values, pa.binary())], names=["i", "part"]
        )

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = np.frombuffer(raw, dtype)
                rows[i] = rows[i] + row if i in rows else row
        yield packed(list(rows), rows.values())

    parts = fit.mapInArrow(in_task, PARTS).repartition("i").mapInArrow(across, PARTS)
    total = np.zeros(shape, dtype)
    for row in parts.collect():  # as many rows as the matrix has
        total[row.i] = np.frombuffer(row.part, dtype)
    return total


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Groups of at least two eigenvalues whose neighbours lie within ``gap``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def bound(m: np.ndarray) -> float:
    """Of a matrix's 2-norm, from its largest row and column sums."""
    sums = np.abs(m)
    return float(np.sqrt(sums.sum(0).max() * sums.sum(1).max()))


def refined(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Approximate eigenvectors ``x`` of symmetric ``a``, refined by the iteration of Ogita and Aishima.

    Each round takes ``R = I - X'X`` and ``S = X'AX`` in the precision of
    ``a`` and corrects ``X`` by ``XE``, whose entries come from both. Pairs of
    eigenvalues closer than the round can tell apart are only made orthogonal;
    their cluster is then solved as a small eigenproblem of its own, about its
    mean, which tells them apart in the next round. Errors square each round,
    until nothing but rounding is left.
    """
    one, size = np.eye(len(a)), bound(a)
    rounding = len(a) * np.finfo(float).eps
    for _ in range(ROUNDS):
        r, s = one - x.T @ x, x.T @ a @ x
        r, s = (r + r.T) / 2, (s + s.T) / 2  # rounding is not: it would leave vectors askew
        values = np.diag(s) / (1 - np.diag(r))
        near = max(2 * (bound(s - np.diag(values)) + size * bound(r)), CLOSE * size)
        gaps = values[None, :] - values[:, None]
        left = s + values * r
        np.fill_diagonal(left, 0)
        if np.abs(left).max() <= rounding * size and np.abs(r).max() <= rounding:
            break
        apart = np.abs(gaps) > near
        e = np.where(apart, (s + values * r) / np.where(apart, gaps, 1), r / 2)
        x = x + x @ e
        for group in clusters(values, near):
            part = x[:, group]
            mean = values[group].mean()
            inner = part.T @ (a @ part - mean * part)
            x[:, group] = part @ np.linalg.eigh((inner + inner.T) / 2)[1]
    return x


def eigen(a: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` largest eigenvalues of symmetric ``a`` and their unit eigenvectors.

    A float32 solution, refined in double precision; the wanted vectors take a
    last correction in the longest floats of the machine.
    """
    scale = bound(a)
    if scale == 0:
        return np.zeros(top), np.eye(len(a))[:, :top]
    a = a / scale
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    x = refined(a, start)
    order = np.argsort(-np.einsum("ij,ij->j", x, a @ x), kind="stable")
    x = x[:, order].astype(np.longdouble)
    wanted = x[:, :top]
    moved = a.astype(np.longdouble) @ wanted
    r, s = np.eye(len(a))[:, :top] - x.T @ wanted, x.T @ moved
    for m in (r, s):
        m[:top] = (m[:top] + m[:top].T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    others = np.einsum("ij,ij->j", x, a @ x.astype(float)).astype(np.longdouble)
    others[:top] = values
    gaps = values[None, :] - others[:, None]
    apart = np.abs(gaps) > CLOSE
    wanted = wanted + x @ np.where(apart, (s + values * r) / np.where(apart, gaps, 1), r / 2)
    wanted /= np.sqrt((wanted * wanted).sum(0))
    values = (wanted * (a @ wanted)).sum(0)
    return np.maximum(values.astype(float), 0) * scale, wanted.astype(float)


def fit_components(fit: DataFrame, dim: int, top: int = COMPONENTS) -> Components | None:
    """Components of the distinct vectors ``x``; None if there are none."""
    n = fit.count()
    if not n or not dim:
        return None
    sums = summed(fit, dim, (1, dim), lambda x: x.sum(0, dtype=np.int64)[None], np.int64)[0]
    mean = sums / n

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ centred

    covariance = summed(fit, dim, (dim, dim), products, np.longdouble) / n
    covariance = ((covariance + covariance.T) / 2).astype(float)
    values, vectors = eigen(covariance, min(top, dim))
    return Components(n, sums, vectors, values, float(np.trace(covariance)))


def identity_error(fit: DataFrame, dim: int, found: Components) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity.

    Components without variance are left out.
    """
    use = ~np.isnan(found.scales)
    k = int(use.sum())
    if not k:
        return 0.0
    mean = summed(fit, dim, (1, k), lambda x: found.whitened(x)[:, use].sum(0)[None], np.longdouble)
    mean = (mean[0] / found.n).astype(float)

    def products(x: np.ndarray) -> np.ndarray:
        centred = found.whitened(x)[:, use] - mean
        return centred.T @ centred

    covariance = summed(fit, dim, (k, k), products, np.longdouble) / found.n
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of ``(n x - S)^2`` per row, exact; None beyond 64 bits."""
    about = ((x.astype(float) * n - sums) ** 2).sum(1)
    with np.errstate(over="ignore"):
        exact = ((x.astype(np.int64) * n - sums) ** 2).sum(1).tolist()
    for i in np.flatnonzero(about > 2.0**62):
        # Near or beyond the limit of 64 bits.
        value = sum((int(c) * n - int(s)) ** 2 for c, s in zip(x[i], sums, strict=True))
        exact[i] = value if value < 1 << 63 else None
    return exact


def whiten(vectors: DataFrame, top: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    One row per usable vector and component, the components numbered by
    falling variance. Rows of ``vectors`` (``vec_id, embedding``; other columns
    are not read) whose embedding is null or has null, NaN or infinite entries
    are dropped. Entries become integers ``floor(256 c)``; beyond 2^22, either
    sign, they count as that. Shorter vectors are filled up with zeros to the
    longest, of at most ``MAX_DIM`` entries; a longer one is an error. Repeated
    rows, and rows with null ids, each have their own result but count once in
    the fit. A component without variance has ``whitened`` null and
    ``explained`` 0. No usable row, or only empty vectors, give no rows.

    The fit list is made by one shuffle that combines copies first. Sums and
    covariance are added up in tasks, and only matrices of the dimension's size
    reach the driver, where the float32 eigenvectors are refined.
    """
    spark = vectors.sparkSession
    sizes = integers(vectors)
    dim = sizes.agg(F.max(F.size("x"))).first()[0] or 0
    if dim > MAX_DIM:
        raise ValueError(f"vectors may have {MAX_DIM} entries, not {dim}")
    rows = integers(vectors, dim)
    fit = saved(rows.select("x").distinct(), "fit") if dim else None
    found = fit_components(fit, dim, top) if dim else None
    if found is None:
        return spark.createDataFrame([], OUT)
    error = identity_error(fit, dim, found)
    k = found.vectors.shape[1]
    explained = found.values / found.trace if found.trace else np.zeros(k)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids, size = matrix(batch, dim), batch.column("vec_id"), batch.num_rows
            values = found.whitened(x).ravel()
            each = pa.array(np.repeat(np.arange(size), k))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * k, found.n)),
                    pa.array(deviations(x, found.n, found.sums), pa.int64()).take(each),
                    pa.array(values, mask=np.isnan(values)),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, OUT)
