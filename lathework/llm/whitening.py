"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors become whole numbers, x = floor(256 * c), and every distinct vector is fitted once. The leading
eigenvectors of their covariance V = X'X / n (X centred) come from a block Q of vectors: a
pass over the distributed rows gives X'(X Q) for the block, and V itself is never built. A
Chebyshev polynomial in V, one pass for each degree of its recurrence, damps the unwanted part of the spectrum and lets the rest
grow; then the block is made orthogonal by QR and turned by Rayleigh-Ritz, which also takes one pass and
gives the residuals. That is repeated until the residuals of the wanted vectors are certified
to be within rounding.

The unwanted interval is learnt from the Ritz values: its upper end is the least of them that lies inside, and
a Ritz value below its lower end moves that end down (V is never negative). A block that is not certified after
``PATIENCE`` rounds is widened twofold, up to all dimensions, where Rayleigh-Ritz is exact.

A pass sends one matrix of dimensions x block per task, added up in groups of the square root
of their number until ``MOST_PARTS`` at most reach the driver. Sums of the fitted vectors are exact whole numbers.

Defined cases: null vectors and those with null or non-finite entries are dropped, and so are empty
ones and those whose length isn't the table's most frequent one (the shorter, of two as
frequent); repeated rows and vectors are fitted once and answered each; a null vec_id is kept; entries beyond 64 bits saturate; a deviation beyond 64 bits is null;
components without variance (one distinct vector, fewer vectors than components) have no rows; tied
eigenvalues give some basis of their space; empty tables give no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.session import scratch_folder

SCALE = 256
COMPONENTS = 4
GUARD = 20  # vectors of the block beyond the wanted ones
DEGREE = 8
PATIENCE = 8
RESIDUAL = 5e-14  # of the largest eigenvalue
NO_VARIANCE = 1e-13  # of the trace
MOST_PARTS = 256

SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _written(df: DataFrame) -> DataFrame:
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(``vec_id``, ``x``): the usable vectors as whole numbers."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    return embeddings.where(F.col("embedding").isNotNull()).where(finite).where(F.size("embedding") > 0).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("bigint")).alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


@dataclass
class Rows:
    """Distinct vectors ``x`` with what centring needs."""

    fit: DataFrame
    dims: int
    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        self.mean = np.array([s / self.n for s in self.sums])
        self.parts = max(self.fit.rdd.getNumPartitions(), 1)

    def total(self, height: int, width: int, of_centred) -> np.ndarray:
        """The sum over all rows of ``of_centred(block)``, ``height`` x ``width``, for blocks of centred rows."""
        dims, mean = self.dims, self.mean

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((height, width))
            for batch in batches:
                if batch.num_rows:
                    out += of_centred(matrix(batch.column(0), dims) - mean)
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["part"])

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(height * width)
            for batch in batches:
                for part in batch.column(0):
                    out += np.frombuffer(part.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["part"])

        parts, count = self.fit.select("x").mapInArrow(partial, "part binary"), self.parts
        while count > MOST_PARTS:
            count = math.isqrt(count)
            parts = parts.repartition(count).mapInArrow(merged, "part binary")
        return sum((np.frombuffer(r.part) for r in parts.collect()), np.zeros(height * width)).reshape(height, width)

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q in one pass."""
        return self.total(self.dims, q.shape[1], lambda x: x.T @ (x @ q)) / self.n

    def trace(self) -> float:
        return float(self.total(1, self.dims, lambda x: (x * x).sum(axis=0, keepdims=True)).sum()) / self.n


def exact_sums(fit: DataFrame, dims: int) -> list[int]:
    """Sums per dimension as Python integers; halves of 32 bits are added up apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0), dims)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dims, dtype=np.int32)), pa.array((x >> 32).sum(axis=0)), pa.array((x & 0xFFFFFFFF).sum(axis=0))], ["dim", "high", "low"])

    exact = lambda c: F.sum(F.col(c).cast("decimal(28,0)")).alias(c)
    sums = fit.select("x").mapInArrow(run, "dim int, high bigint, low bigint").groupBy("dim").agg(exact("high"), exact("low")).collect()
    return [(int(r.high) << 32) + int(r.low) for r in sorted(sums, key=lambda r: r.dim)]


def filtered(rows: Rows, q: np.ndarray, low: float, high: float, top: float, degree: int = DEGREE) -> np.ndarray:
    """p(V) q for the Chebyshev polynomial that is small on [low, high], scaled to 1 at ``top``; a pass for each degree."""
    half, middle = max((high - low) / 2, 1e-9 * top), (high + low) / 2
    first = half / max(top - middle, half)
    sigma, before = first, q
    now = (rows.times(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (rows.times(now) - middle * now) * (2 * following / half) - sigma * following * before
        sigma = following
    return now


def leading_eigenpairs(rows: Rows, k: int, guard: int = GUARD, degree: int = DEGREE, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of the covariance, falling, and unit eigenvectors as columns, certified by their residuals."""
    dims, random = rows.dims, np.random.default_rng(seed)
    k, width, low, rounds = min(k, dims), min(k + guard, dims), None, 0
    q = np.linalg.qr(random.standard_normal((dims, width)))[0]
    while True:
        image = rows.times(q)
        form = q.T @ image
        values, turn = np.linalg.eigh((form + form.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        residual = np.linalg.norm(image - q * values, axis=0)[:k].max()
        if residual <= RESIDUAL * max(values[0], 0.0) or width == dims:
            break
        rounds += 1
        if rounds % PATIENCE == 0:
            width = min(2 * width, dims)
            q = np.linalg.qr(np.hstack([q, random.standard_normal((dims, width - q.shape[1]))]))[0]
            continue
        low = max(2 * values[-1] - values[0], 0.0) if low is None else min(low, max(0.999 * values[-1], 0.0))
        inside = values[k:][values[k:] > low]
        high = inside[-1] if len(inside) else values[-1]
        q = np.linalg.qr(filtered(rows, q, min(low, high), high, values[0], degree))[0]
    vectors = q[:, :k]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    return np.maximum(values[:k], 0.0), vectors * signs


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums over the dimensions of (n x - S)^2, in 64 bits where they surely suffice."""
    most = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums), default=0)
    kind = np.int64 if len(sums) * most**2 < 2**63 else object
    away = n * x.astype(kind) - np.array(sums, dtype=kind)
    return [v if v < 2**63 else None for v in (away * away).sum(axis=1).tolist()]


def whitened(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error`` for every usable row and component with variance."""
    spark = embeddings.sparkSession
    every = _written(whole_vectors(embeddings, scale))
    size = F.size("x").alias("size")
    common = every.groupBy(size).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], SCHEMA)
    dims = common["size"]
    used = every.where(F.size("x") == dims)
    fit = _written(used.select("x").distinct())
    n = fit.count()
    rows = Rows(fit, dims, n, exact_sums(fit, dims))
    trace = rows.trace()
    values, vectors = leading_eigenpairs(rows, components)
    there = values > NO_VARIANCE * trace
    values, axes = values[there], vectors[:, there] / np.sqrt(values[there])
    k = len(values)
    if not k:
        return spark.createDataFrame([], SCHEMA)

    def moments(x: np.ndarray) -> np.ndarray:
        """Second moments of the whitened rows, and their sums below."""
        z = x @ axes
        return np.vstack([z.T @ z, z.sum(axis=0)])

    held = rows.total(k + 1, k, moments) / n
    error = float(np.abs(held[:k] - np.outer(held[k], held[k]) - np.eye(k)).max())
    mean, sums, explained = rows.mean, rows.sums, (values / trace).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), dims)
            z = (x - mean) @ axes
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, dtype=np.int64)),
                pa.array([d for d in deviations(x, n, sums) for _ in range(k)], pa.int64()), pa.array(z.ravel()),
                pa.array(explained * m, pa.float64()), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return used.select("vec_id", "x").mapInArrow(run, SCHEMA)
