"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers, and each distinct one counts once in the fit. The covariance is never formed: every
product with a block of directions is a pass over the written fit list that centres the vectors and sums
``X'(XQ)``. A Chebyshev polynomial of the covariance, built by its recurrence, damps the spectrum below the block; QR
and Rayleigh-Ritz turn the block to eigenvectors, again and again until their residuals certify them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airq.session import scratch_path

# Directions carried besides the wanted ones; they set how far below the unwanted spectrum begins.
GUARD = 24
# Steps of the recurrence that bounds the spectrum from below.
FLOOR_STEPS = 10
# Residuals, as a share of the largest eigenvalue: aimed at, and the largest of a certified component.
AIM, CERTIFIED = 1e-14, 1e-10
# Below this share of the largest eigenvalue a direction counts as empty.
EMPTY = 1e-12
# One filter may lift the first direction this much more than the last wanted one, lest rounding hides that one.
SPREAD = 1e6
MOST_DEGREE, MOST_ROUNDS = 16, 200
# Entries that a step of a Python task holds at a time.
STEP = 4_000_000
# Numbers from here on do not fit into 64 bits with room to add to them.
LIMIT = 2.0**62


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with the sums ``sums`` per dimension; falling ``values`` of the covariance, their unit
    eigenvectors as columns of ``axes``, the covariance's trace ``total``, and how far the whitened fit list's covariance
    is from the identity (largest entry)."""

    scale: float
    n: int
    sums: tuple[int, ...]
    total: float
    values: np.ndarray
    axes: np.ndarray
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.total) for v in self.values]


def row_steps(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    step = max(1, STEP // max(1, size))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def whole_numbers(vectors: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``floor(scale * c)`` of all usable vectors: for each size the rows and their numbers, one row each.

    Not usable are null and empty vectors and those with an entry that is null, NaN, infinite or too large for a long.
    """
    starts = vectors.offsets.to_numpy()
    entries = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
    with np.errstate(invalid="ignore", over="ignore"):
        numbers = np.floor(scale * entries)
        bad = np.concatenate(([0], np.cumsum(~(np.abs(numbers) < LIMIT))))  # the comparison is false for NaN
    sizes = np.diff(starts)
    usable = vectors.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0) & (bad[starts[1:]] == bad[starts[:-1]])
    for size in np.unique(sizes[usable]):
        rows = np.flatnonzero(usable & (sizes == size))
        yield rows, numbers[starts[rows][:, None] + np.arange(size)].astype(np.int64)


def pack(numbers: np.ndarray) -> list[bytes]:
    """Each row in the narrowest width that holds it, so that equal vectors have equal bytes."""
    top = np.maximum(numbers.max(axis=1), -1 - numbers.min(axis=1))
    out = np.empty(len(numbers), dtype=object)
    below = -1
    for width in (1, 2, 4, 8):
        most = (1 << (8 * width - 1)) - 1
        rows = np.flatnonzero((top > below) & (top <= most))
        block = np.ascontiguousarray(numbers[rows].astype(f"<i{width}"))
        for row, line in zip(rows, block):
            out[row] = line.tobytes()
        below = most
    return out.tolist()


def unpack(keys: list[bytes], size: int) -> np.ndarray:
    """The numbers behind ``pack``, one row each."""
    out = np.empty((len(keys), size), dtype=np.int64)
    widths = np.fromiter(map(len, keys), dtype=np.int64, count=len(keys)) // size
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        out[rows] = np.frombuffer(b"".join(keys[i] for i in rows), dtype=f"<i{width}").reshape(-1, size)
    return out


def exact_sums(numbers: np.ndarray) -> list[int]:
    """Column sums in halves of 32 bits, which do not overflow."""
    high, low = (numbers >> 32).sum(axis=0), (numbers & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(s) for h, s in zip(high, low)]


class FitList:
    """The distinct vectors of a table as a written table, and sums over all of them.

    All have the size that most distinct vectors have (of equally frequent sizes the largest).
    """

    def __init__(self, df: DataFrame, vector: str, scale: float):
        spark = df.sparkSession

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in row_steps(batch, 1024):
                    for _, numbers in whole_numbers(part.column(0), scale):
                        sizes = pa.array(np.full(len(numbers), numbers.shape[1], dtype=np.int32))
                        yield pa.RecordBatch.from_arrays([pa.array(pack(numbers), pa.binary()), sizes], ["_key", "_size"])

        path = scratch_path(spark, "fit-list")
        vectors = df.select(F.col(vector).cast("array<double>").alias("_vector"))
        vectors.mapInArrow(keys, "_key binary, _size int").distinct().write.parquet(path)
        stored = spark.read.parquet(path)
        sizes = [(r["n"], r["_size"]) for r in stored.groupBy("_size").agg(F.count(F.lit(1)).alias("n")).collect()]
        self.n, self.size = max(sizes, default=(0, 0))
        self.rows = stored.where(F.col("_size") == self.size).select("_key")
        self.sums = self._sums() if self.n else ()
        # centre = pivot + part: a number less the pivot is exact, the part is below one
        self.pivot = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.part = np.array([(s % self.n) / self.n for s in self.sums], dtype=np.float64)

    def _sums(self) -> tuple[int, ...]:
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [0] * size
            for batch in batches:
                for part in row_steps(batch, size):
                    total = [a + b for a, b in zip(total, exact_sums(unpack(part.column(0).to_pylist(), size)))]
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(map(str, total))], ["i", "s"])

        partial = self.rows.mapInArrow(run, "i int, s string")
        found = partial.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
        return tuple(int(r["s"]) for r in sorted(found))

    def total(self, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of the matrices ``work(y)`` over blocks ``y`` of centred vectors, one pass.

        Partitions add up their blocks, Spark adds up the partitions; only the sum reaches the driver.
        """
        size, pivot, part = self.size, self.pivot, self.part

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            added = None
            for batch in batches:
                for rows in row_steps(batch, size):
                    one = work((unpack(rows.column(0).to_pylist(), size) - pivot).astype(np.float64) - part)
                    added = one if added is None else added + one
            if added is not None:
                lines = pa.array(added.tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(range(len(added)), pa.int32()), lines], ["i", "line"])

        cells = self.rows.mapInArrow(run, "i int, line array<double>").select("i", F.posexplode("line").alias("j", "c"))
        found = cells.groupBy("i", "j").agg(F.sum("c").alias("c")).collect()
        out = np.zeros((1 + max(r["i"] for r in found), 1 + max(r["j"] for r in found)))
        for r in found:
            out[r["i"], r["j"]] = r["c"]
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times ``q``: one pass that centres the vectors and sums ``X'(XQ)``."""
        return self.total(lambda y: y.T @ (y @ q)) / self.n


def spectrum_floor(times: Callable[[np.ndarray], np.ndarray], size: int, dice: np.random.Generator) -> float:
    """About the least eigenvalue, not above it but for chance: a short Lanczos recurrence less its last residual."""
    basis = np.zeros((size, 0))
    q, diagonal, beside = dice.standard_normal(size), [], []
    for _ in range(min(size, FLOOR_STEPS)):
        q = q / np.linalg.norm(q)
        basis = np.column_stack((basis, q))
        w = times(q[:, None])[:, 0]
        diagonal.append(float(q @ w))
        for _ in range(2):
            w = w - basis @ (basis.T @ w)
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-12 * abs(diagonal[0]):
            break
        q = w
    ritz, turn = np.linalg.eigh(np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1))
    return max(0.0, float(ritz[0] - beside[-1] * abs(turn[-1, 0])))


def ritz_pairs(x: np.ndarray, vx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), their vectors in the span of orthonormal ``x``, and the covariance times these."""
    small = x.T @ vx
    values, turn = np.linalg.eigh((small + small.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], x @ turn, vx @ turn


def filter_degree(values: np.ndarray, wanted: int, low: float, high: float, fall: float) -> int:
    """Degree that lifts the last wanted direction by ``fall`` over the damped interval, as far as ``SPREAD`` allows."""
    centre, half = (high + low) / 2, (high - low) / 2
    first, last = (float(np.arccosh(max(1.0, (values[i] - centre) / half))) for i in (0, wanted - 1))
    need = np.log(2 * max(fall, 2.0)) / max(last, 1e-3)
    most = np.log(SPREAD) / max(first - last, 1e-3)
    return int(np.clip(np.ceil(min(need, most)), 2, MOST_DEGREE))


def chebyshev(
    times: Callable[[np.ndarray], np.ndarray], x: np.ndarray, vx: np.ndarray, degree: int, low: float, high: float, top: float
) -> np.ndarray:
    """The polynomial of the covariance that is small between ``low`` and ``high`` and one at ``top``, times ``x``.

    ``vx`` is the covariance times ``x``, so that the first step of the recurrence needs no pass.
    """
    centre, half = (high + low) / 2, (high - low) / 2
    sigma = half / (top - centre)
    tau = 2 / sigma
    y = (vx - centre * x) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (tau - sigma)
        x, y = y, (times(y) - centre * y) * (2 * following / half) - (sigma * following) * x
        sigma = following
    return y


def leading(times: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a covariance of ``size`` rows, given by its products, and their unit vectors.

    Ends when the residuals no longer fall and all certify, an error if they never do. Equal starts, so that equal
    products give equal results.
    """
    dice = np.random.default_rng(seed)
    low = spectrum_floor(times, size, dice)
    x = np.linalg.qr(dice.standard_normal((size, min(size, wanted + GUARD))))[0]
    values, x, vx = ritz_pairs(x, times(x))
    best = np.inf
    for _ in range(MOST_ROUNDS):
        top = max(values[0], np.finfo(float).tiny)
        worst = float(np.linalg.norm(vx - x * values, axis=0)[:wanted].max()) / top
        if worst <= AIM or worst <= CERTIFIED and worst > best / 4 or len(values) == size and worst <= CERTIFIED:
            return values[:wanted], x[:, :wanted]
        best = min(best, worst)
        high = max(values[-1], 1e-9 * top)
        under = min(low, high / 2) if low >= high else low
        degree = filter_degree(values, wanted, under, high, worst / AIM)
        x = np.linalg.qr(chebyshev(times, x, vx, degree, under, high, top))[0]
        values, x, vx = ritz_pairs(x, times(x))
    raise RuntimeError(f"residual {best:.1e} of the largest eigenvalue after {MOST_ROUNDS} rounds")


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = 16, scale: float = 64.0) -> Whitening | None:
    """Whitening of ``floor(scale * c)`` by the distinct vectors of ``df``; None without a usable vector.

    Fewer components if the vectors are shorter or vary in fewer directions. Not usable are null and empty vectors,
    those with a null, NaN or infinite entry or one too large for a long, and those of another size than most.
    Passes over the distinct vectors: about ten to bound the spectrum, then a few dozen; what reaches the
    driver is a matrix of the vectors' size by ``components`` and ``GUARD``.
    """
    fit = FitList(df, vector, scale)
    if not fit.n:
        return None
    total = float(fit.total(lambda y: (y * y).sum(axis=0, keepdims=True)).sum()) / fit.n
    values, axes, error = np.zeros(0), np.zeros((fit.size, 0)), 0.0
    if total > 0:
        values, axes = leading(fit.times, fit.size, min(components, fit.size))
        full = values > EMPTY * values[0]
        values, axes = values[full], axes[:, full]
        turn = axes / np.sqrt(values)

        def moments(y: np.ndarray) -> np.ndarray:
            w = y @ turn
            return np.vstack((w.T @ w, w.sum(axis=0)))

        sums = fit.total(moments) / fit.n
        error = float(np.abs(sums[:-1] - np.outer(sums[-1], sums[-1]) - np.eye(len(values))).max())
    return Whitening(scale, fit.n, fit.sums, total, values, axes, error)


def deviations(numbers: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over the dimensions of ``(n * x - sum) ** 2``, exact; None where it is no long.

    Sums of 64-bit words are exact modulo 2**64, so a sum that is a long comes out right whatever overflows before;
    doubles tell which sums are, and those near the limit are added up again without one.
    """
    words = np.array([s % (1 << 64) for s in sums], dtype=np.uint64)
    off = numbers.astype(np.uint64) * np.uint64(n % (1 << 64)) - words
    exact = (off * off).sum(axis=1, dtype=np.uint64)
    rough = ((numbers.astype(np.float64) * n - np.array(sums, dtype=np.float64)) ** 2).sum(axis=1)
    out: list[int | None] = []
    for row, (value, about) in enumerate(zip(exact.tolist(), rough.tolist())):
        if about > 2.0**62:
            value = sum((n * x - s) ** 2 for x, s in zip(numbers[row].tolist(), sums))
        out.append(value if value < 1 << 63 else None)
    return out


def whiten(df: DataFrame, model: Whitening | None, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, deviation, whitened)`` of every row of ``df`` whose vector is usable and has the model's size.

    ``whitened`` is an array with a value for each component; ``deviation`` the exact sum of ``(n * x - sum) ** 2``, null
    where it is too large for a long. Null and repeated ids are kept. Without a model there are no rows.
    """
    kind = df.schema[id_column].dataType.simpleString()
    schema = f"_id {kind}, deviation long, whitened array<double>"
    rows = df.select(F.col(id_column).alias("_id"), F.col(vector).cast("array<double>").alias("_vector"))
    if model is None:
        empty = rows.where(F.lit(False)).select("_id", F.lit(None).cast("long").alias("deviation"), F.col("_vector").alias("whitened"))
        return empty.withColumnRenamed("_id", id_column)
    n, sums, size = model.n, model.sums, len(model.sums)
    turn = model.axes / np.sqrt(model.values)
    pivot = np.array([s // n for s in sums], dtype=np.int64)
    part = np.array([(s % n) / n for s in sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_steps(batch, size):
                for at, numbers in whole_numbers(piece.column(1), model.scale):
                    if numbers.shape[1] != size:
                        continue
                    y = ((numbers - pivot).astype(np.float64) - part) @ turn
                    ids = piece.column(0).take(pa.array(at, pa.int64()))
                    off = pa.array(deviations(numbers, n, sums), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [ids, off, pa.array(y.tolist(), pa.list_(pa.float64()))], ["_id", "deviation", "whitened"]
                    )

    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_column)
