"""Whitening of vectors by a Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V come from products V Q with a few columns Q. Each product is
one distributed pass: the sum of z (z' Q) over the centred vectors z, of which only a (dimension x columns)
matrix comes back. A polynomial recurrence over such passes damps the unwanted part of the spectrum; QR and
a Rayleigh-Ritz step then give eigenpairs, until the residuals certify them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship_code, written

# Vectors in one row of the packed table.
PACKED = 4096
# Columns beyond those asked for: they carry the spectrum's next part, so that the wanted part stands out.
GUARD = 16
MOST_DEGREE = 24
# How much more the filter may lift the largest pair than the last wanted one. Rounding leaves some of the largest in
# every column; lifted by 1 / EPSILON it would hide the wanted ones.
MOST_LIFT = 1e12
EPSILON = float(np.finfo(np.float64).eps)
BLOCKS = "vec_ids binary, missing binary, x binary"


def whole_numbers(c: np.ndarray) -> np.ndarray:
    """The integer vectors that everything is computed from."""
    x = np.floor(1024 * c)
    if x.size and np.abs(x).max() >= 2.0 ** 62:
        raise OverflowError("an entry does not fit a long")
    return x.astype(np.int64) + 100_000


def pack(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors as bytes: ids, which of them are null, and the integer vectors."""
    for batch in batches:
        for at in range(0, batch.num_rows, PACKED):
            part = batch.slice(at, PACKED)
            ids, vectors = part.column("vec_id"), part.column("embedding").flatten()
            x = whole_numbers(vectors.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids.fill_null(0).to_numpy().tobytes()]),
                 pa.array([ids.is_null().to_numpy(zero_copy_only=False).tobytes()]), pa.array([x.tobytes()])],
                names=["vec_ids", "missing", "x"])


def sums_of(blocks: DataFrame, shape: tuple[int, ...], of: Callable[[np.ndarray], np.ndarray], dimension: int) -> np.ndarray:
    """The sum over all blocks of an array of one shape: each task sums up its blocks, Spark the tasks' entries."""
    whole = of(np.zeros((0, dimension), np.int64)).dtype.kind == "i"
    kind = "bigint" if whole else "double"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column("x"):
                own = of(np.frombuffer(x.as_buffer(), np.int64).reshape(-1, dimension))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "v"])

    rows = blocks.select("x").mapInArrow(partial, f"at bigint, v {kind}").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(math.prod(shape), np.int64 if whole else np.float64)
    out[rows.column("at").to_numpy()] = rows.column("v").to_numpy()
    return out.reshape(shape)


@dataclass(frozen=True)
class Eigenpairs:
    """vectors has a column per value; residuals are the lengths of V q - e q."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[Eigenpairs, np.ndarray]:
    """The best eigenpairs within the columns of q, and V times their vectors."""
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors, products = q @ turn, vq @ turn
    return Eigenpairs(values, vectors, np.linalg.norm(products - vectors * values, axis=0)), products


def leading(product: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int, tolerance: float = 32 * EPSILON,
            seed: int = 1) -> Eigenpairs:
    """The ``wanted`` leading eigenpairs of a positive semidefinite matrix given by its products.

    Certified: each residual is at most ``tolerance`` times the largest eigenvalue, or rounding keeps it from getting
    any smaller over three rounds. The filter's degree follows the gap between the wanted values and the
    block's last one; if the gap asks for too many passes, the block is widened instead. A largest value far above the
    wanted ones bounds the degree, as QR can't part columns that are all but copies of its vector.
    """
    columns, draw = min(dimension, wanted + GUARD), np.random.default_rng(seed)
    q = np.linalg.qr(draw.standard_normal((dimension, columns)))[0]
    pairs, products = _ritz(q, product(q))
    best, stalled = pairs, 0
    while True:
        top = max(float(pairs.values[0]), 0.0)
        worst = float(pairs.residuals[:wanted].max())
        if worst < 0.5 * float(best.residuals[:wanted].max()):
            stalled = 0
        else:
            stalled += 1
        if worst <= float(best.residuals[:wanted].max()):
            best = pairs
        if worst <= tolerance * top or stalled > 3 and worst <= 1e-10 * top:
            return best
        # The unwanted part: from 0 up to the block's last value.
        cut = max(float(pairs.values[-1]), EPSILON * top)
        spread = 2 * max(float(pairs.values[wanted - 1]), cut * (1 + 1e-9)) / cut - 1
        need = math.acosh(1e6) / math.acosh(max(spread, 1 + 1e-12))
        lift = math.acosh(max(2 * top / cut - 1, 1)) - math.acosh(max(spread, 1))
        stable = math.log(MOST_LIFT) / max(lift, 1e-12)
        degree = int(min(MOST_DEGREE, max(2, min(math.ceil(need), stable))))
        if need > MOST_DEGREE and columns < dimension:
            columns = min(dimension, 2 * columns)
            y = np.hstack([pairs.vectors, draw.standard_normal((dimension, columns - pairs.vectors.shape[1]))])
        else:
            y = chebyshev(product, pairs.vectors, products, degree, cut, top)
        q = np.linalg.qr(y)[0]
        pairs, products = _ritz(q, product(q))


def chebyshev(product: Callable, y: np.ndarray, vy: np.ndarray, degree: int, cut: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of V times y that stays within 1 on [0, cut], scaled to 1 at top. ``vy`` is V y, known
    from the step before."""
    centre = half = cut / 2
    sigma = first = half / (top - centre)
    before, now = y, (vy - centre * y) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (product(now) - centre * now) * (2 * following / half) - before * (sigma * following)
        sigma = following
    return now


def _commonest_length(vectors: DataFrame) -> int:
    """One row per length comes to the driver's side of the order, one is taken."""
    row = vectors.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return row["d"] if row else 0


def whiten(embeddings: DataFrame, components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, residual: for every vector its
    coordinates along the leading eigenvectors of the covariance, each scaled to variance 1.

    Vectors that are null or hold null or non-finite entries are left out, and so are those that don't have the
    commonest length (the least of several); the fit is over all others. Components number as many as asked
    for, or as many as have a variance beyond rounding: no rows at all for a single vector or for copies of one.
    Repeated rows and null ids count and come out each. ``residual`` certifies the component: the length
    of V q - e q over the largest e. Raises OverflowError if an entry or a deviation would not fit a long. Columns other than
    vec_id and embedding are ignored; an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    ship_code(spark)
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = embeddings.select(
        embeddings["vec_id"].cast("bigint").alias("vec_id"), embeddings["embedding"].cast("array<double>").alias("embedding"),
    ).where(F.col("embedding").isNotNull() & finite)
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double, residual double")
    d = _commonest_length(good)
    if not d:
        return spark.createDataFrame([], schema)
    blocks = written(good.where(F.size("embedding") == d).mapInArrow(lambda b: pack(b, d), BLOCKS), "whitening-blocks")
    sums = sums_of(blocks, (d + 1,), lambda x: np.append(x.sum(0), len(x)), d)
    n, sums = int(sums[d]), sums[:d]

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - sums) / n

    def deviations(x: np.ndarray) -> np.ndarray:
        z = n * x - sums
        if len(z) and float((z.astype(np.float64) ** 2).sum(1).max()) >= 2.0 ** 63 * (1 - 1e-9):
            raise OverflowError("a vector's deviation does not fit a long")
        return (z * z).sum(1)

    trace = float(sums_of(blocks, (1,), lambda x: np.array([(centred(x) ** 2).sum()]), d)[0]) / n

    def product(q: np.ndarray) -> np.ndarray:
        return sums_of(blocks, q.shape, lambda x: (z := centred(x)).T @ (z @ q), d) / n

    if not trace:
        return spark.createDataFrame([], schema)
    found = leading(product, d, min(components, d))
    real = found.values > 1e-12 * found.values[0]
    real[min(components, d):] = False
    values, vectors = found.values[real], found.vectors[:, real]
    k, scaled = len(values), vectors / np.sqrt(values)
    mean = sums_of(blocks, (k,), lambda x: (centred(x) @ scaled).sum(0), d) / n
    spread = sums_of(blocks, (k, k), lambda x: (w := centred(x) @ scaled - mean).T @ w, d) / n
    error = float(np.abs(spread - np.eye(k)).max())
    explained, residuals = values / trace, found.residuals[real] / found.values[0]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column("x")[i].as_buffer(), np.int64).reshape(-1, d)
                ids = np.frombuffer(batch.column("vec_ids")[i].as_buffer(), np.int64)
                missing = np.frombuffer(batch.column("missing")[i].as_buffer(), bool)
                m = len(x) * k
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, k), mask=np.repeat(missing, k)),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(m, n)),
                     pa.array(np.repeat(deviations(x), k)), pa.array((centred(x) @ scaled).ravel()),
                     pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error)),
                     pa.array(np.tile(residuals, len(x)))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"])

    return blocks.mapInArrow(rows, schema)
