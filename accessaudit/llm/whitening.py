"""Whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance come from products of the centred data with a few vectors,
XᵀXQ, each one pass over blocks of rows that every task adds up on its own. A polynomial that stays
small over the unwanted part of the spectrum and grows fast above it is applied by its
three-term recurrence, one product a degree; then QR, and Rayleigh-Ritz on the subspace. It ends
when residuals are at rounding level and new random vectors, filtered beside the
vectors found, show no further one of that size. No covariance matrix is formed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accessaudit.session import fresh_folder, written

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
GUARD = 16  # vectors beyond the components
DEGREE = 10
ROUNDS = 100
TOLERANCE = 1e-13  # of the largest eigenvalue, for residuals
BLOCK_BYTES = 1 << 20
SLOTS = 32  # sums that the driver adds up, at most
LARGEST = 2.0**40  # of an entry; rows with a larger one take no part


# Rows ------------------------------------------------------------------------------------


def vectors(table: DataFrame) -> DataFrame:
    """vec_id, scaled entries `x` and their number, of rows whose vector is there and finite throughout."""
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.where(F.col("e").isNotNull() & F.forall("e", fits))
    whole = F.transform("e", lambda c: F.floor(F.lit(SCALE) * c).cast("long") + F.lit(SHIFT))
    return rows.select("vec_id", whole.alias("x"), F.size("e").alias("dimensions"))


PACKED = "dimensions int, ids binary, missing binary, rows binary"


def packed(rows: DataFrame) -> DataFrame:
    """`vectors` as blocks of rows: ids, which of them are missing, and entries row by row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dimensions").to_numpy()
            missing = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").fill_null(0).to_numpy()
            x = batch.column("x")
            offsets, values = np.asarray(x.offsets), x.values.to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == d)
                step = max(1, BLOCK_BYTES // max(1, 8 * d))
                for at in (mine[i : i + step] for i in range(0, len(mine), step)):
                    block = values[offsets[at][:, None] + np.arange(d)].astype("<i8")
                    row = (d, ids[at].astype("<i8").tobytes(), missing[at].tobytes(), block.tobytes())
                    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=["dimensions", "ids", "missing", "rows"])

    return rows.mapInArrow(scan, PACKED)


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(batch.num_rows):
        d, ids, missing, rows = (batch.column(c)[i].as_py() for c in ("dimensions", "ids", "missing", "rows"))
        ids = np.frombuffer(ids, "<i8")
        yield ids, np.frombuffer(missing, bool), np.frombuffer(rows, "<i8").reshape(len(ids), d)


@dataclass
class Center:
    """n vectors with exact sums S of each dimension. The mean is `base` + `rest` / n, in whole numbers."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.base = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = [s % self.n for s in self.sums]
        self.share = np.array([r / self.n for r in self.rest])

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """rows - S / n, with no error but the last rounding."""
        return (rows - self.base).astype(float) - self.share

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """For each row the sum of (n x - S)^2, exact; None where a long cannot hold it."""
        near = rows - self.base
        peak = int(np.abs(near).max(initial=0)) + 1
        if rows.shape[1] * (peak * self.n) ** 2 < 1 << 63:
            return ((near * self.n - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        found = [sum((x * self.n - r) ** 2 for x, r in zip(row, self.rest, strict=True)) for row in near.tolist()]
        return [x if x < 1 << 63 else None for x in found]


# Passes ----------------------------------------------------------------------------------


class Passes:
    """Sums over all blocks of one number of dimensions. Each task adds up its own blocks, SLOTS tasks those sums."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks
        self.slots = max(1, min(SLOTS, math.isqrt(blocks.count())))

    def total(self, of, shape: tuple[int, ...], kind: str = "float64") -> np.ndarray:
        """The sum of `of(rows)` over blocks, arrays of that shape."""

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(shape, kind)
            for batch in batches:
                for _, _, rows in _opened(batch):
                    found += of(rows)
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(shape, kind)
            for batch in batches:
                for data in batch.column("sums").to_pylist():
                    found += np.frombuffer(data, kind).reshape(shape)
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["sums"])

        parts = self.blocks.mapInArrow(scan, "sums binary").repartition(self.slots).mapInArrow(add, "sums binary")
        found = np.zeros(shape, kind)
        for row in parts.collect():  # one of a fixed size per slot
            found += np.frombuffer(row["sums"], kind).reshape(shape)
        return found

    def center(self, d: int) -> Center:
        """Sums as two halves of 31 bits and more, so that none overflows."""

        def halves(rows: np.ndarray) -> np.ndarray:
            count = np.zeros(d, np.int64)
            count[:1] = len(rows)
            return np.stack([(rows >> 31).sum(axis=0), (rows & ((1 << 31) - 1)).sum(axis=0), count])

        high, low, count = self.total(halves, (3, d), "int64").tolist()
        return Center(count[0], [(h << 31) + x for h, x in zip(high, low, strict=True)])


class Covariance:
    """V q = Xᵀ(X q) / n over centred rows, by a pass; and the trace of V."""

    def __init__(self, passes: Passes, center: Center):
        self.passes, self.center, self.d, self.trace, self.count = passes, center, len(center.sums), None, 0

    def __call__(self, q: np.ndarray) -> np.ndarray:
        center, width = self.center, q.shape[1]

        def product(rows: np.ndarray) -> np.ndarray:
            x = center.centred(rows)
            found = np.zeros((len(q), width + 1))
            found[:, :width] = x.T @ (x @ q)
            found[:, width] = (x * x).sum(axis=0)
            return found

        found = self.passes.total(product, (self.d, width + 1)) / center.n
        self.trace, self.count = float(found[:, width].sum()), self.count + 1
        return found[:, :width]


# Eigenvectors ----------------------------------------------------------------------------


def filtered(product, q: np.ndarray, v: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """A polynomial of V on q, small over [low, high] and 1 at `top`; `v` is the product with q already known."""
    center, half = (high + low) / 2, (high - low) / 2
    sigma = half / (top - center)
    ratio = sigma
    last, now = q, (v - center * q) * (sigma / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / sigma - ratio)
        last, now = now, (product(now) - center * now) * (2 * following / half) - last * (ratio * following)
        ratio = following
    return now


def _ritz(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values falling, vectors, their products, and residuals."""
    inner = q.T @ v
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    q, v = q @ turn, v @ turn
    return values, q, v, np.linalg.norm(v - q * values, axis=0)


def leading(product, d: int, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric V >= 0 and unit eigenvectors, given products with V.

    Ends with residuals at rounding level, or as small as they get, after fresh random vectors have found nothing that was missed.
    """
    rng = np.random.default_rng(seed)
    m = min(d, k + GUARD)
    q = np.linalg.qr(rng.standard_normal((d, m)))[0]
    values, q, v, residual = _ritz(q, product(q))
    low, best, fresh = max(0.0, values[-1] - residual[-1]), math.inf, False
    for _ in range(ROUNDS):
        worst = residual[:k].max(initial=0.0)
        small = worst <= TOLERANCE * values[0] * math.sqrt(d)
        stuck = worst <= 1e-10 * values[0] and worst > best / 2
        if m == d or values[0] <= 0:
            break
        if small or stuck:
            if fresh:
                break
            # certify: the guard gives way to new random vectors, and what they find is judged with the rest
            probe = rng.standard_normal((d, m - k))
            q = np.linalg.qr(np.hstack([q[:, :k], probe - q[:, :k] @ (q[:, :k].T @ probe)]))[0]
            cut, top = values[min(k, m - 1)], values[0]
            v = product(q)
            fresh, best = True, math.inf
        else:
            cut, top = values[-1], values[0]
            best = min(best, worst)
        low = min(low, max(0.0, values[-1] - residual[-1]))
        if cut <= low:
            low = max(0.0, cut / 2)
        if top - cut <= 1e-12 * top:  # the whole block shares one value
            cut = low + (top - low) / 2
        q = np.linalg.qr(filtered(product, q, v, low, cut, top))[0]
        known = values[k - 1]
        values, q, v, residual = _ritz(q, product(q))
        if fresh and values[k - 1] > known * (1 + 1e-9) + TOLERANCE * values[0]:
            fresh = False  # something was missed: go on with it
    else:
        raise ArithmeticError(f"residuals stay at {residual[:k].max():.3g} after {ROUNDS} rounds")
    return values[:k], q[:, :k]


# Whitening -------------------------------------------------------------------------------


@dataclass
class Fit:
    """Mean, components (columns, unit length) and eigenvalues of all vectors of one number of dimensions."""

    center: Center
    components: np.ndarray
    values: np.ndarray
    trace: float
    passes: int

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        return self.center.centred(rows) @ self.components / np.sqrt(self.values)


def fit(passes: Passes, d: int, k: int = COMPONENTS) -> Fit:
    """Components whose eigenvalue is above rounding level; there may be fewer than k, or none."""
    center = passes.center(d)
    covariance = Covariance(passes, center)
    values, found = leading(covariance, d, min(k, d))
    kept = values > max(1e-12 * values[0], 0.0)
    return Fit(center, found[:, kept], values[kept], covariance.trace, covariance.count)


WHITE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(table: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """A row for each vector of `table` and component: see WHITE.

    All vectors are the fit list and all are projected. Defined cases: null vectors, those with null
    or non-finite entries and those with an entry of 2^40 or more take no part; rows
    without an id or sharing one are rows of their own; vectors of another number of dimensions
    have a fit of their own; there are as many components as the vectors span, at most `k`, so vectors that
    are all equal, empty, or one alone give no rows; a deviation beyond a long is null; other columns are not
    read; an empty table gives no rows.
    """
    spark = table.sparkSession
    blocks = written(packed(vectors(table)), fresh_folder(spark, "vectors"))
    found = spark.createDataFrame([], WHITE)
    sizes = [r[0] for r in blocks.where("dimensions > 0").select("dimensions").distinct().orderBy("dimensions").toLocalIterator()]
    for d in sizes:
        mine = blocks.where(F.col("dimensions") == d)
        passes = Passes(mine)
        own = fit(passes, d, k)
        if len(own.values):
            found = found.unionByName(_projected(mine, own, identity_error(passes, own)))
    return found


def identity_error(passes: Passes, own: Fit) -> float:
    """The largest entry of the whitened vectors' covariance, centred, minus the identity: measured, in two passes."""
    k, n = len(own.values), own.center.n
    mean = passes.total(lambda rows: own(rows).sum(axis=0), (k,)) / n

    def product(rows: np.ndarray) -> np.ndarray:
        white = own(rows) - mean
        return white.T @ white

    return float(np.abs(passes.total(product, (k, k)) / n - np.eye(k)).max())


def _projected(blocks: DataFrame, own: Fit, error: float) -> DataFrame:
    k, n, explained = len(own.values), own.center.n, own.values / own.trace

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, missing, rows in _opened(batch):
                size = len(ids)
                columns = (
                    pa.array(np.repeat(ids, k), pa.int64(), mask=np.repeat(missing, k)),
                    pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                    pa.array(np.full(size * k, n), pa.int64()),
                    pa.array([x for x in own.center.deviations(rows) for _ in range(k)], pa.int64()),
                    pa.array(own(rows).ravel()),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * k, error)),
                )
                yield pa.RecordBatch.from_arrays(list(columns), names=[f.split()[0] for f in WHITE.split(", ")])

    return blocks.mapInArrow(scan, WHITE)
