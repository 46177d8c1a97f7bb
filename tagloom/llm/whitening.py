"""Embedding whitening. The components of the covariance come from QDWH spectral divide and
conquer: polar decompositions of the shifted matrix give spectral projectors, which split it
into ever smaller invariant subspaces. Rows are whitened by a broadcast matrix."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, sent, small_batches
from tagloom.session import materialise

# Entries are counted in steps of 1 / STEPS.
STEPS = 256
COMPONENTS = 4

# Longest vector: the driver holds a few square matrices of this size.
MOST_DIMENSIONS = 4_096

EPS = np.finfo(np.float64).eps


def polar_unitary(a: np.ndarray) -> np.ndarray:
    """The unitary factor of the polar decomposition of the symmetric ``a`` (its matrix sign) by
    QDWH: Halley steps with dynamical weights, by QR of the stacked matrix. A lower bound of
    the least singular value, which may be crude, decides the weights; six steps or so suffice."""
    size = len(a)
    x = a / np.linalg.norm(a)
    # |x| >= 1 / |x^-1|; a singular matrix has a least singular value of nothing.
    r = np.abs(np.diag(np.linalg.qr(x, "r")))
    low = max(float(r.min()) / (2 * size), EPS / size)
    for _ in range(60):
        d = (4 * (1 - low**2) / low**4) ** (1 / 3) if low < 1 else 0.0
        root = math.sqrt(1 + d)
        weight = root + math.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * root)) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(c) * x, np.eye(size)]))
        following = b / c * x + (weight - b / c) / math.sqrt(c) * q[:size] @ q[size:].T
        following = (following + following.T) / 2
        low = min(low * (weight + b * low**2) / (1 + c * low**2), 1.0)
        moved = np.linalg.norm(following - x)
        x = following
        if moved < 1e-13 * size and 1 - low < 1e-13:
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first ``k`` columns span the eigenvectors of ``a`` above
    ``shift``; None if ``shift`` parts nothing or runs into an eigenvalue."""
    size = len(a)
    projector = (polar_unitary(a - shift * np.eye(size)) + np.eye(size)) / 2
    k = round(float(np.trace(projector)))
    if not 0 < k < size:
        return None
    # The projector's longest columns, one by one, span its range; a second QR cleans them.
    rest, chosen = projector.copy(), []
    for _ in range(k):
        best = int(np.argmax((rest**2).sum(axis=0)))
        v = rest[:, best] / np.linalg.norm(rest[:, best])
        chosen.append(v)
        rest -= np.outer(v, v @ rest)
    first, _ = np.linalg.qr(projector @ np.array(chosen).T)
    basis, _ = np.linalg.qr(np.hstack([first, (np.eye(size) - projector) @ _complement(first)]))
    off = basis[:, :k].T @ a @ basis[:, k:]
    return (basis, k) if np.linalg.norm(off) <= 1e-10 * np.linalg.norm(a) else None


def _complement(first: np.ndarray) -> np.ndarray:
    """Orthonormal columns that complete those of ``first``."""
    whole, _ = np.linalg.qr(first, "complete")
    return whole[:, first.shape[1] :]


def spectral_components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the symmetric ``a``, the largest first.

    A block is split at the median of its diagonal, or at other points of the spectrum where that
    parts nothing, until its parts are one component each or a multiple of the identity, in
    which any basis will do. A last refinement makes up for rounding in the splits.
    """
    size = len(a)
    if not size:
        return np.zeros(0), np.zeros((0, 0))
    scale = float(np.linalg.norm(a)) or 1.0

    def divide(block: np.ndarray) -> np.ndarray:
        n = len(block)
        centre = float(np.trace(block)) / n
        radius = float(np.linalg.norm(block - centre * np.eye(n)))
        if n == 1 or radius <= 4 * EPS * scale * math.sqrt(n):
            return np.eye(n)
        median = float(np.median(np.diag(block)))
        # The mean of the spectrum lies within it, and eigenvalues on both sides of it.
        for shift in (median, centre, *(centre + radius / n * t for t in (-0.37, 0.41, -0.83, 0.89, 1e-3, -1e-3))):
            found = _split(block, shift)
            if found:
                break
        else:
            # No gap is wider than rounding: the block is a multiple of the identity.
            return np.eye(n)
        basis, k = found
        turned = basis.T @ block @ basis
        turned = (turned + turned.T) / 2
        out = np.zeros((n, n))
        out[:, :k] = basis[:, :k] @ divide(turned[:k, :k])
        out[:, k:] = basis[:, k:] @ divide(turned[k:, k:])
        return out

    vectors = _refined(a, divide((a + a.T) / 2), scale)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _refined(a: np.ndarray, vectors: np.ndarray, scale: float) -> np.ndarray:
    """First-order correction of almost exact eigenvectors, twice."""
    for _ in range(2):
        inner = vectors.T @ a @ vectors
        values = np.diag(inner)
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > 1e-9 * scale
        turn = np.where(apart, inner / np.where(apart, gap, 1.0), 0.0)
        vectors, r = np.linalg.qr(vectors @ (np.eye(len(a)) + turn))
        vectors = vectors * np.sign(np.where(np.diag(r) == 0, 1.0, np.diag(r)))
    return vectors


@dataclass
class Whitening:
    """What :func:`fit` learns: ``n`` distinct vectors, their ``sums`` per dimension, all
    ``eigenvalues`` of their covariance, its ``trace``, and the ``components`` kept, as rows of unit length."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer vectors, one row each."""
        # The sums are split at whole numbers, so a large mean costs no digits.
        whole = [s // self.n for s in self.sums]
        part = np.array([s % self.n / self.n for s in self.sums])
        centred = (x - np.array(whole, x.dtype)).astype(np.float64) - part
        kept = self.eigenvalues[: len(self.components)]
        return centred @ self.components.T / np.sqrt(kept)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of ``(n * x - sums) ** 2``, exact; None where it is no long."""
        most = max(map(abs, self.sums), default=0) + self.n * int(np.abs(x).max(initial=0))
        if most and most**2 * max(len(self.sums), 1) < 2**63:
            apart = x.astype(np.int64) * self.n - np.array(self.sums, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        exact = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x]
        return [e if e < 2**63 else None for e in exact]


def counted(embedding: Column, steps: int = STEPS) -> Column:
    """The vector in whole steps, rounded down, as longs; null where the vector is null or has a null or
    non-finite entry. Entries beyond the range of a long become its ends."""
    end = F.lit(2.0**63 - 1024)  # the largest double below 2 ** 63
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(math.inf))
    step = lambda c: F.floor(F.least(F.greatest(c.cast("double") * steps, -end), end))
    return F.when(~F.exists(embedding, odd), F.transform(embedding, step))


def _arrow(df: DataFrame, function: Callable[[np.ndarray, pa.RecordBatch], Iterator], schema: str) -> DataFrame:
    """Applies ``function`` to the matrix of the first column of each batch; vectors have one length."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                columns = function(flat.reshape(batch.num_rows, -1), batch)
                types = arrow_schema(schema)
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, types)]
                yield pa.RecordBatch.from_arrays(arrays, schema=types)

    return df.mapInArrow(run, schema)


def _moments(df: DataFrame, function: Callable[[], Callable[[np.ndarray], np.ndarray]], width: int) -> np.ndarray:
    """Sum over all vectors of ``function``'s result, ``width`` doubles, per batch: summed up
    in each task, then cell by cell, and collected, as the width is bounded by the dimensions."""
    small_batches(df.sparkSession)
    schema = "cell int, value double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call, total = function(), np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
                total += call(flat.reshape(batch.num_rows, -1))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used])], schema=arrow_schema(schema)
        )

    summed = df.mapInArrow(run, schema).groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(width)
    out[summed.column("cell").to_numpy()] = summed.column("value").to_numpy()
    return out


def _sums(df: DataFrame, size: int) -> list[int]:
    """Exact sum of each dimension, from the sums of the upper and lower halves of the numbers."""

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, lower = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            upper += (x >> 32).sum(axis=0)
            lower += (x & 0xFFFFFFFF).sum(axis=0)
        columns = [pa.array(np.arange(size), pa.int64()), pa.array(upper), pa.array(lower)]
        yield pa.RecordBatch.from_arrays(columns, ["at", "upper", "lower"])

    parts = df.select("x").mapInArrow(halves, "at long, upper long, lower long").groupBy("at")
    exact = parts.agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("upper", "lower")])
    found = {r["at"]: int(r["upper"]) * 2**32 + int(r["lower"]) for r in exact.collect()}
    return [found[i] for i in range(size)]


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a written table of distinct vectors (x array<long>) of one length; None without rows.

    Vectors are centred by the nearest whole numbers to their mean before they are multiplied,
    which keeps products small and, up to 2^53, exact in any order; the rest of the mean, below one,
    is taken off the sum. Components without variance are left out.
    """
    first = distinct.first()
    if first is None:
        return None
    size, n = len(first.x), distinct.count()
    if size > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {size} dimensions, more than {MOST_DIMENSIONS}")
    sums = _sums(distinct, size)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    send = sent(distinct.sparkSession, np.array(centre, np.int64))

    def products() -> Callable[[np.ndarray], np.ndarray]:
        middle = send()

        def add(x: np.ndarray) -> np.ndarray:
            y = (x - middle).astype(np.float64)
            return (y.T @ y).ravel()

        return add

    total = _moments(distinct.select("x"), products, size * size).reshape(size, size)
    rest = np.array([(s - n * c) / n for s, c in zip(sums, centre)])
    covariance = total / n - np.outer(rest, rest)
    covariance = (covariance + covariance.T) / 2
    values, vectors = spectral_components(covariance)
    trace = float(np.trace(covariance))
    kept = int((values[:components] > size * EPS * trace).sum()) if trace > 0 else 0
    return Whitening(n, sums, values, vectors[:, :kept].T.copy(), trace)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    k = len(model.components)
    send = sent(distinct.sparkSession, model)

    def products() -> Callable[[np.ndarray], np.ndarray]:
        whiten = send()

        def add(x: np.ndarray) -> np.ndarray:
            z = whiten.project(x)
            return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

        return add

    total = _moments(distinct.select("x"), products, k + k * k)
    mean = total[:k] / model.n
    return float(np.abs(total[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    components: int = COMPONENTS,
    steps: int = STEPS,
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) for each row and component.

    Rows whose vector is null or has a null or non-finite entry are left out; entries are counted in
    whole ``steps``. Vectors are whitened by the covariance of the distinct ones. All must have
    the length that most rows have (the longest of these at a tie); others, and empty ones, have
    no components and are left out too. A component without variance, as when all vectors are equal,
    is left out for all rows, and a table without rows gives none. Repeated rows and equal or null keys
    stay rows of their own. ``deviation`` is null where it is no long. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(counted(vectors[f"`{embedding}`"], steps).alias("x"), vectors[f"`{key}`"].alias("key"))
    kind = vectors.schema[key].dataType.simpleString().replace("bigint", "long")
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = materialise(rows.filter("size(x) > 0"), "counted")
    lengths = rows.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("length")).first()
    if usual is None:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    rows = rows.filter(F.size("x") == usual["length"])
    distinct = materialise(rows.select("x").distinct(), "distinct")
    model = fit(distinct, components)
    error = identity_error(distinct, model)
    send = sent(spark, model)

    def spell(x: np.ndarray, batch: pa.RecordBatch) -> list:
        whitening = send()
        k, size = len(whitening.components), len(x)
        explained = whitening.eigenvalues[:k] / whitening.trace if k else np.zeros(0)
        at = np.repeat(np.arange(size), k)
        return [
            batch.column(1).take(pa.array(at)),
            np.tile(np.arange(1, k + 1, dtype=np.int32), size),
            np.full(size * k, whitening.n),
            pa.array(whitening.deviations(x), pa.int64()).take(pa.array(at)),
            whitening.project(x).ravel(),
            np.tile(explained, size),
            np.full(size * k, error),
        ]

    return _arrow(rows, spell, schema).withColumnRenamed("key", key)
