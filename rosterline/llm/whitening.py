"""Embedding whitening by a block Jacobi-Davidson method on distributed products.

Entries become whole numbers, ``floor(SCALE * c) + SHIFT``; the distinct vectors are the fit list. Its covariance matrix is
never formed: Spark gives the product of the matrix with a narrow block of vectors, as sums over the list of a centred
vector times its inner products. On these:

* Rayleigh-Ritz: the largest eigenpairs of the matrix within a search space, with their residuals.
* Correction: for the leading pairs whose residual is too large, MINRES on the correction equation, projected to be
  orthogonal to the pair and to the locked ones. All pairs take their steps together, so a step is one distributed product.
* The corrections widen the search space; when it is full, it starts again from its leading Ritz vectors.
* Locking: a pair whose residual is at most ``TOLERANCE`` of the largest eigenvalue, and before which all are locked, leaves
  the search. The search ends when all are locked.

The driver holds blocks of (dimensions x search space) and sums of that size, whatever the number of vectors. Sums of
partitions are folded in a second stage before it reads them, in a fixed order.

Rows: a NULL vector and one that holds NULL or a non-finite entry is dropped, an empty one as well; vectors have the length
that most of the others have (of equal counts the longest), those of another length are dropped; rows without vec_id and
repeated rows stay, the fit list has each vector once; entries beyond +-2^40 after scaling read as that bound; a ``deviation``
that no long can hold is NULL; components without variance (beyond the rank of the list) give no rows, so a single
vector or equal vectors give none; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import prepare, staged

SCALE = 64
SHIFT = 1_000_000
BOUND = 1 << 40
COMPONENTS = 16
BLOCK_BYTES = 1 << 20
FOLDS = 16
TOLERANCE = 2.0**-46
INNER_STEPS = 6
SPACE = 6  # the search space holds so many times the wanted vectors
ROUNDS = 200

WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x: array of long) of the rows whose vector takes part."""
    entry = lambda c: (F.least(F.greatest(F.floor(c.cast("double") * SCALE), F.lit(-BOUND)), F.lit(BOUND)) + SHIFT).cast("long")
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    rows = embeddings.select("vec_id", F.col(vector).alias("c")).where(F.col("c").isNotNull() & (F.size("c") > 0)).where(F.forall("c", usable))
    rows = rows.withColumn("x", F.transform("c", entry))
    lengths = rows.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("width")).first()
    return rows.where(F.size("x") == (usual["width"] if usual else 0)).select("vec_id", "x")


def _matrix(lists: pa.Array) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    at = np.asarray(lists.offsets)
    return lists.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]].reshape(len(lists), -1) if len(lists) else np.empty((0, 0), np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(0))
        step = max(1, BLOCK_BYTES // max(8 * x.shape[1], 1))
        for first in range(0, len(x), step):
            part = np.ascontiguousarray(x[first : first + step], "<i8")
            yield pa.RecordBatch.from_arrays([pa.array([len(part)]), pa.array([part.tobytes()])], ["rows", "data"])


class FitList:
    """The distinct vectors, in blocks, with their number, sums and centre."""

    def __init__(self, vectors: DataFrame):
        distinct = vectors.select("x").distinct().mapInArrow(_blocks, "rows long, data binary")
        self.blocks = staged(distinct, "whitening-fit")
        # Halves of 32 bits are summed apart, so the sums are exact whole numbers whatever the entries.
        total = self._summed(lambda x: np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]), np.int64)
        if total is None:
            self.n, self.sums = 0, []
            return
        self.n = int(total[0])
        half = (len(total) - 1) // 2
        self.sums = [(int(high) << 32) + int(low) for high, low in zip(total[1 : half + 1], total[half + 1 :])]
        self.base = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.float64) / self.n

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``; the whole part of the mean is taken off exactly."""
        return (x - self.base).astype(np.float64) - self.rest

    def _summed(self, of_block, kind) -> np.ndarray | None:
        """The sum over all blocks of a vector of fixed size for each block."""

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for rows, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    found = of_block(np.frombuffer(data.as_buffer(), "<i8").reshape(rows, -1))
                    total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.astype(kind).tobytes()])], ["sums"])

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for data in batch.column(1):
                    found = np.frombuffer(data.as_buffer(), kind)
                    total = found.copy() if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

        parts = self.blocks.mapInArrow(part, "sums binary").select(F.spark_partition_id().alias("part"), "sums")
        folded = parts.repartition(FOLDS, F.col("part") % FOLDS).sortWithinPartitions("part").mapInArrow(fold, "sums binary")
        found = folded.sortWithinPartitions("sums").collect()  # one row per fold
        return sum(np.frombuffer(r["sums"], kind) for r in sorted(found, key=lambda r: r["sums"])) if found else None

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance matrix (divisor n) times the columns of ``block``."""
        shared = self.blocks.sparkSession.sparkContext.broadcast(np.ascontiguousarray(block))
        base, rest = self.base, self.rest

        def times(x: np.ndarray) -> np.ndarray:
            centred = (x - base).astype(np.float64) - rest
            return (centred.T @ (centred @ shared.value)).ravel()

        found = self._summed(times, np.float64).reshape(block.shape) / self.n
        shared.destroy()
        return found

    def trace(self) -> float:
        """The sum of all variances."""
        base, rest = self.base, self.rest
        return float(self._summed(lambda x: np.array([(((x - base).astype(np.float64) - rest) ** 2).sum()]), np.float64)[0] / self.n)

    def covariance_of(self, projection: np.ndarray) -> np.ndarray:
        """The covariance matrix of the centred vectors times a narrow projection."""
        shared = self.blocks.sparkSession.sparkContext.broadcast(projection)
        base, rest, width = self.base, self.rest, projection.shape[1]

        def squares(x: np.ndarray) -> np.ndarray:
            z = ((x - base).astype(np.float64) - rest) @ shared.value
            return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

        found = self._summed(squares, np.float64) / self.n
        shared.destroy()
        return found[width:].reshape(width, width) - np.outer(found[:width], found[:width])


def _orthogonal(new: np.ndarray, bases: list[np.ndarray]) -> np.ndarray:
    """An orthonormal basis of what the columns of ``new`` add to the given orthonormal ones."""
    size = np.linalg.norm(new, axis=0)
    new = new[:, size > 0] / size[size > 0]
    for _ in range(2):
        for base in bases:
            new = new - base @ (base.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > 1e-8] / size[size > 1e-8]
    if new.shape[1] == 0:
        return new
    left, values, _ = np.linalg.svd(new, full_matrices=False)
    left = left[:, values > 1e-8]
    for base in bases:
        left = left - base @ (base.T @ left)
    return np.linalg.qr(left)[0]


def _corrections(product, theta: np.ndarray, ritz: np.ndarray, residual: np.ndarray, locked: np.ndarray, steps: int) -> np.ndarray:
    """MINRES, in step for every column, on (I - Q Q')(V - theta)(I - Q Q') t = -r, Q being the locked vectors and the column's own."""

    def project(x: np.ndarray) -> np.ndarray:
        x = x - locked @ (locked.T @ x)
        return x - ritz * (ritz * x).sum(axis=0)

    tiny = np.finfo(float).tiny
    v = project(-residual)
    beta = np.linalg.norm(v, axis=0)
    v = v / np.maximum(beta, tiny)
    before = np.zeros_like(v)
    x, d, d_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    eta, beta_v = beta.copy(), np.zeros_like(beta)
    c, c_before, s, s_before = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        moved = project(product(v) - theta * v)
        alpha = (v * moved).sum(axis=0)
        after = moved - alpha * v - beta_v * before
        beta_next = np.linalg.norm(after, axis=0)
        # The new column of the tridiagonal matrix, turned by the last two rotations and then by its own.
        rho_3 = s_before * beta_v
        part = c_before * beta_v
        rho_2 = c * part + s * alpha
        delta = c * alpha - s * part
        rho_1 = np.maximum(np.hypot(delta, beta_next), tiny)
        c_before, s_before = c, s
        c, s = delta / rho_1, beta_next / rho_1
        d, d_before = (v - rho_3 * d_before - rho_2 * d) / rho_1, d
        x = x + c * eta * d
        eta = -s * eta
        before, v, beta_v = v, after / np.maximum(beta_next, tiny), beta_next
        live = beta_next > 1e-14 * np.maximum(np.abs(theta), tiny)
        eta = np.where(live, eta, 0.0)
        if not live.any():
            break
    return project(x)


@dataclass
class Eigenpairs:
    values: np.ndarray
    vectors: np.ndarray  # one column per value
    residuals: np.ndarray
    products: int


def largest_eigenpairs(product, size: int, wanted: int, steps: int = INNER_STEPS, seed: int = 13) -> Eigenpairs:
    """The ``wanted`` largest eigenpairs of a symmetric matrix given by its products with narrow blocks, largest first."""
    made = 0

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal made
        made += 1
        return product(block)

    wanted = min(wanted, size)
    most = min(size, SPACE * wanted)
    locked, locked_values, residuals = np.zeros((size, 0)), np.zeros(0), np.zeros(0)
    space = _orthogonal(np.random.default_rng(seed).normal(size=(size, min(size, 2 * wanted))), [])
    image = times(space)
    scale, least, stalled = 0.0, np.inf, 0
    for _ in range(ROUNDS):
        inner = space.T @ image
        theta, turn = np.linalg.eigh((inner + inner.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        scale = max(scale, float(theta[0]) if len(theta) else 0.0)
        missing = wanted - len(locked_values)
        residual = image[:, :missing] - theta[:missing] * space[:, :missing]
        residual = residual - locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        # Rounding of long sums may leave residuals just above the bound: three rounds without progress end the search there.
        worst = float(norms.max(initial=0.0))
        stalled, least = (0, worst) if worst < least / 2 else (stalled + 1, least)
        bound = TOLERANCE * scale * (64 if stalled > 3 else 1)
        done = int(np.argmin(np.append(norms <= bound, False)))
        if done:
            locked = np.concatenate([locked, space[:, :done]], axis=1)
            locked_values, residuals = np.append(locked_values, theta[:done]), np.append(residuals, norms[:done])
            space, image, theta, residual = space[:, done:], image[:, done:], theta[done:], residual[:, done:]
            stalled, least = 0, np.inf
        if len(locked_values) == wanted:
            break
        if space.shape[1] + residual.shape[1] > most - locked.shape[1] and space.shape[1] > 2 * wanted:
            space, image = space[:, : 2 * wanted], image[:, : 2 * wanted]
        count = residual.shape[1]
        fresh = _corrections(times, theta[:count], space[:, :count], residual, locked, steps)
        fresh = _orthogonal(np.concatenate([fresh, residual], axis=1)[:, : max(size - locked.shape[1] - space.shape[1], 0)], [locked, space])
        if fresh.shape[1] == 0:  # the space is whole: fresh products of its own basis take off what rounding has gathered
            space = _orthogonal(space, [locked])
            image = times(space)
            continue
        space, image = np.concatenate([space, fresh], axis=1), np.concatenate([image, times(fresh)], axis=1)
    else:
        raise ArithmeticError(f"only {len(locked_values)} of {wanted} eigenpairs reached double precision")
    order = np.argsort(-locked_values, kind="stable")
    return Eigenpairs(locked_values[order], locked[:, order], residuals[order], made)


@dataclass
class Whitening:
    """Centre and scaled components: ``project`` gives whitened coordinates."""

    fit: FitList
    eigen: Eigenpairs
    explained: np.ndarray
    identity_error: float

    @property
    def projection(self) -> np.ndarray:
        return self.eigen.vectors / np.sqrt(self.eigen.values)


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """A whitening of (vec_id, x) rows; None without any variance."""
    fit = FitList(vectors)
    if fit.n < 2:
        return None
    trace = fit.trace()
    if trace <= 0:
        return None
    found = largest_eigenpairs(fit.product, len(fit.sums), components)
    real = found.values > len(fit.sums) * np.finfo(float).eps * 4 * found.values[0]
    found = Eigenpairs(found.values[real], found.vectors[:, real], found.residuals[real], found.products)
    whitening = Whitening(fit, found, found.values / trace, 0.0)
    cov = fit.covariance_of(whitening.projection)
    whitening.identity_error = float(np.abs(cov - np.eye(len(cov))).max())
    return whitening


def _deviations(x: np.ndarray, n: int, sums: list[int], base: np.ndarray) -> pa.Array:
    """The sum over dimensions of (n x - S)^2, exactly; NULL beyond a long."""
    offset = np.array([n * int(b) - s for b, s in zip(base, sums)], object)  # n * base - S, between -n and 0
    far = int(np.abs(x - base).max(initial=0)) + 1
    if far * n < 1 << 31 and (far * n) ** 2 * x.shape[1] < 1 << 63:
        return pa.array((((x - base) * n + offset.astype(np.int64)) ** 2).sum(axis=1))
    exact = [(((row - base).astype(object) * n + offset) ** 2).sum() for row in x]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(vectors: DataFrame, whitening: Whitening | None) -> DataFrame:
    """One row for each vector and component."""
    spark = vectors.sparkSession
    if whitening is None:
        return spark.createDataFrame([], WHITENED)
    fit, width = whitening.fit, len(whitening.eigen.values)
    shared = spark.sparkContext.broadcast((fit.n, fit.sums, fit.base, fit.rest, whitening.projection, whitening.explained, whitening.identity_error))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, base, rest, projection, explained, error = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _matrix(batch.column(1))
            z = ((x - base).astype(np.float64) - rest) @ projection
            each = pa.array(np.repeat(np.arange(len(x)), width))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * width, n)),
                    _deviations(x, n, sums, base).take(each),
                    pa.array(z.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * width, error)),
                ],
                [c.split()[0] for c in WHITENED.split(", ")],
            )

    return vectors.mapInArrow(rows, WHITENED)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = staged(whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "whole-vectors")
    return whiten(vectors, fit_whitening(vectors))
