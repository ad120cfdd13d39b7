"""Whitening of embeddings with the leading components of their covariance.

Spark does all that grows with the rows: exact sums, the covariance about the mean, the
projections, and the covariance of what comes out. Each task reduces its rows to one
matrix of the vectors' dimensions; these are added by their lines. The driver holds the
covariance alone, whose size is the square of the dimensions whatever the rows.

Its leading eigenvectors come from contour integration (FEAST). Inertia counts place the
ends of intervals in gaps between eigenvalues. For each interval, the solutions of shifted
complex systems at quadrature points of a circle through its ends add up to a projection
of some trial vectors onto the interval's eigenvectors. Rayleigh-Ritz in the projected
space gives better trial vectors, until the residuals are at rounding level. As many
eigenvalues have to be found in an interval as the inertia counts say that it holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halfspace.llm.common import shared_table

COMPONENTS = 8
# An entry c becomes floor(STEPS * c) + OFFSET.
STEPS = 1024
OFFSET = 100_000
# Eigenvalues of less than this share of the largest one count as zero.
RANK = 1e-10
# Quadrature points on the upper half of a circle, rounds, and eigenvalues of an interval.
POINTS = 12
ROUNDS = 40
# Rounds after which the trial vectors are doubled.
PATIENCE = 6
MOST_INSIDE = 8
# Largest ratio of an interval's eigenvalues.
LONGEST = 8
# Bytes of vectors that a task turns into numbers at a time.
SLICE_BYTES = 16 * 1024 * 1024

LINES = "line int, task int, numbers array<double>"
SUMS = "n bigint, sums array<decimal(38,0)>"
WHITE = "vec_id bigint, deviation decimal(38,0), white array<double>"
RESULT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
    "identity_error double, deviation_exact decimal(38,0)"
)


class MissedEigenvaluesError(Exception):
    """Raised when an interval did not give the eigenvalues that its inertia counts."""


class Inertia:
    """How many eigenvalues of a symmetric matrix lie above a number.

    The matrix is brought to tridiagonal form once, by reflections, which keeps inertia.
    A count is then the signs of the pivots of the shifted tridiagonal matrix.
    """

    def __init__(self, matrix: np.ndarray):
        work = matrix.copy()
        size = len(work)
        for k in range(size - 2):
            column = work[k + 1 :, k].copy()
            length = np.linalg.norm(column)
            if not length:
                continue
            column[0] += length if column[0] >= 0 else -length
            column /= np.linalg.norm(column)
            work[k + 1 :] -= 2 * np.outer(column, column @ work[k + 1 :])
            work[:, k + 1 :] -= 2 * np.outer(work[:, k + 1 :] @ column, column)
        self.diagonal = np.diag(work).tolist()
        beside = np.diag(work, -1)
        self.squares = [0.0, *(beside * beside).tolist()]
        self.bound = float(np.abs(matrix).sum(axis=1).max())
        self.tiny = max(np.finfo(float).tiny, np.finfo(float).eps ** 2 * self.bound)

    def above(self, number: float) -> int:
        count, pivot = 0, 1.0
        for value, square in zip(self.diagonal, self.squares, strict=True):
            pivot = value - number - square / pivot
            if abs(pivot) < self.tiny:
                pivot = -self.tiny
            count += pivot > 0
        return count

    def nth(self, n: int) -> float:
        """The n-th largest eigenvalue, by halving, as far as counts can tell."""
        low, high = -self.bound, self.bound
        while True:
            middle = (low + high) / 2
            if not low < middle < high:
                return middle
            low, high = (middle, high) if self.above(middle) >= n else (low, middle)


def intervals(inertia: Inertia, wanted: int, most: int = MOST_INSIDE) -> list[tuple[float, float, int]]:
    """(low, high, count) that hold the ``wanted`` largest eigenvalues, and few others.

    Ends lie in the middle of gaps. An interval is cut at its widest gap as long as it
    holds more than ``most`` eigenvalues, or some that are far apart; equal ones can't be cut.
    """
    size = len(inertia.diagonal)
    least = 64 * np.finfo(float).eps * size * inertia.bound
    far = min(size, wanted + most)
    values = [inertia.nth(n + 1) for n in range(far)]
    gap, end = max(((values[n - 1] - values[n], n) for n in range(wanted, far)), default=(0.0, far))
    if far == size or gap <= least:
        # No gap near by: all that are as good as equal to the last one belong to it.
        end, low = wanted, values[wanted - 1]
        while (more := inertia.above(low - least)) > end:
            values += [inertia.nth(n + 1) for n in range(len(values), more)]
            end, low = more, values[more - 1]
    under = inertia.nth(end + 1) if end < size else values[end - 1] - max(least, values[0] - values[end - 1])
    bottom = (values[end - 1] + under) / 2
    top = values[0] + max(least, values[0] - values[end - 1])
    found = []

    def split(first: int, last: int, low: float, high: float) -> None:
        gaps = [(values[n - 1] - values[n], n) for n in range(first + 1, last)]
        widest, at = max(gaps, default=(0.0, 0))
        # A long interval resolves little at its lower end, so it is cut as well.
        short = values[first] <= LONGEST * values[last - 1]
        if (last - first <= most and short) or widest <= least:
            found.append((low, high, inertia.above(low) - inertia.above(high)))
            return
        middle = (values[at - 1] + values[at]) / 2
        split(first, at, middle, high)
        split(at, last, low, middle)

    split(0, end, bottom, top)
    return found


def _rayleigh_ritz(matrix: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The matrix's eigenvalues and eigenvectors as seen in the space of some columns."""
    basis, _ = np.linalg.qr(columns)
    small = basis.T @ matrix @ basis
    values, mixes = np.linalg.eigh((small + small.T) / 2)
    return values, basis @ mixes


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix between two numbers, and their eigenvectors."""
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max())
    center, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    turns = np.exp(0.5j * np.pi * (1 + nodes))
    one = np.eye(size)
    dice = np.random.default_rng(0)
    trial = dice.standard_normal((size, min(size, 2 * count + 4)))
    enough = 16 * np.finfo(float).eps * size * scale
    best = np.inf
    for done in range(ROUNDS):
        if done % PATIENCE == PATIENCE - 1:
            # Too many values just outside: more trial vectors hold them as well.
            more = min(size - trial.shape[1], trial.shape[1])
            trial = np.concatenate([trial, dice.standard_normal((size, more))], axis=1)
        projected = np.zeros_like(trial)
        for turn, weight in zip(turns, weights, strict=True):
            solved = np.linalg.solve((center + radius * turn) * one - matrix, trial.astype(complex))
            projected += (0.5 * weight * radius * turn * solved).real
        values, trial = _rayleigh_ritz(matrix, projected)
        # A space larger than the count also shows values that are none: their residuals stay.
        residual = np.linalg.norm(matrix @ trial - trial * values, axis=0)
        good = (low < values) & (values < high) & (residual <= enough)
        if good.sum() != count:
            continue
        # Rounds go on for as long as they help.
        if residual[good].max() >= best / 2:
            return values[good], trial[:, good]
        best = residual[good].max()
    raise MissedEigenvaluesError(f"{count} eigenvalues expected between {low} and {high}, {good.sum()} found")


def leading_components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns.

    Eigenvalues that count as zero are left out. Each vector's largest entry is positive.
    """
    size = len(covariance)
    scale = float(np.abs(covariance).max()) if size else 0.0
    if not scale:
        return np.zeros(0), np.zeros((size, 0))
    # In units of the largest entry, no number is near the ends of a double's range.
    inertia = Inertia(covariance / scale)
    wanted = min(most, inertia.above(RANK * inertia.nth(1)))
    found = [feast(covariance / scale, *interval)[1] for interval in intervals(inertia, wanted)]
    # Vectors of neighbouring intervals are made orthogonal, however near their values are.
    values, vectors = _rayleigh_ritz(covariance / scale, np.concatenate(found, axis=1))
    order = np.argsort(-values, kind="stable")[:wanted]
    values, vectors = values[order] * scale, vectors[:, order]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)]
    return values, vectors * np.sign(largest)


@dataclass(frozen=True)
class Center:
    """The exact mean of whole-number vectors: ``whole`` + ``rest`` / ``n``."""

    n: int
    whole: list[int]
    rest: list[int]

    @staticmethod
    def of(n: int, sums: list[int]) -> Center:
        return Center(n, [s // n for s in sums], [s % n for s in sums])

    def apart(self, numbers: np.ndarray) -> np.ndarray:
        """Whole-number distances from ``whole``, exact."""
        return numbers - np.array(self.whole, np.int64)

    def centred(self, numbers: np.ndarray) -> np.ndarray:
        return self.apart(numbers).astype(float) - np.array(self.rest, float) / self.n

    def deviations(self, numbers: np.ndarray) -> list[int]:
        """The exact sum over dimensions of (n * x - sum) squared, for each row."""
        apart = self.apart(numbers)
        largest = (int(np.abs(apart).max(initial=0)) + 1) * self.n
        if largest * largest * numbers.shape[1] < 2**62:
            scaled = apart * self.n - np.array(self.rest, np.int64)
            return (scaled * scaled).sum(axis=1).tolist()
        scaled = apart.astype(object) * self.n - np.array(self.rest, object)
        return (scaled * scaled).sum(axis=1).tolist()


def _numbers(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Bounded slices of rows, with their vectors as whole numbers."""
    rows = max(1, SLICE_BYTES // (8 * max(1, size)))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            entries = part.column("embedding").flatten().to_numpy().astype(float) * STEPS
            if not (np.abs(entries) < 2.0**61).all():
                raise OverflowError(f"an entry is beyond a long in steps of 1/{STEPS}")
            yield part, np.floor(entries).astype(np.int64).reshape(-1, size) + OFFSET


def _usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Rows with a whole vector, and its length."""
    entry = vectors.schema["embedding"].dataType.elementType.typeName()
    finite = "x -> x IS NOT NULL"
    if entry in ("float", "double"):
        finite += " AND NOT isnan(x) AND abs(x) < double('infinity')"
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    rows = rows.where(F.col("embedding").isNotNull() & F.expr(f"forall(embedding, {finite})"))
    size = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    return rows.where(F.size("embedding") == size), size


def _exact_sums(rows: DataFrame, size: int) -> tuple[int, list[int]]:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for _, numbers in _numbers(batches, size):
            n += len(numbers)
            # Halves of 31 bits, so that no sum of a slice leaves a long.
            upper, lower = (numbers >> 31).sum(axis=0).tolist(), (numbers & (2**31 - 1)).sum(axis=0).tolist()
            total = [t + (u << 31) + v for t, u, v in zip(total, upper, lower, strict=True)]
        if n:
            exact = pa.array([[Decimal(t) for t in total]], pa.list_(pa.decimal128(38, 0)))
            yield pa.record_batch([pa.array([n], pa.int64()), exact], ["n", "sums"])

    # Written once, so the counts and the sums are of the same pass.
    partial = shared_table(rows.select("embedding").mapInArrow(sums, SUMS), "vector-sums")
    n = partial.agg(F.sum("n")).first()[0] or 0
    by_place = partial.select(F.posexplode("sums").alias("place", "part")).groupBy("place")
    found = by_place.agg(F.sum("part").alias("whole")).orderBy("place").collect()
    return n, [int(row.whole) for row in found]


def _cross_products(
    rows: DataFrame, size: int, centred: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]
) -> np.ndarray:
    """The sum of the outer products of centred vectors: a matrix for each task, then
    its lines added in the order of the tasks."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in centred(batches):
            total = part.T @ part if total is None else total + part.T @ part
        if total is None:
            return
        task = np.full(size, TaskContext.get().partitionId(), np.int32)
        lines = pa.ListArray.from_arrays(np.arange(0, size * size + 1, size, dtype=np.int32), total.ravel())
        yield pa.record_batch([pa.array(np.arange(size, dtype=np.int32)), pa.array(task), lines], ["line", "task", "numbers"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            numbers = batch.column("numbers").flatten().to_numpy().reshape(-1, size)
            for line, values in zip(batch.column("line").to_pylist(), numbers, strict=True):
                totals[line] = totals[line] + values if line in totals else values.copy()
        if totals:
            lists = pa.array([v.tolist() for v in totals.values()], pa.list_(pa.float64()))
            lines = pa.array(list(totals), pa.int32())
            yield pa.record_batch([lines, pa.array([0] * len(totals), pa.int32()), lists], ["line", "task", "numbers"])

    partial = rows.mapInArrow(products, LINES).repartition("line").sortWithinPartitions("line", "task")
    found = partial.mapInArrow(add, LINES).collect()
    matrix = np.array([row.numbers for row in sorted(found, key=lambda row: row.line)])
    return (matrix + matrix.T) / 2


@dataclass(frozen=True)
class Whitened:
    """``rows`` has vec_id, deviation and white, an entry for each component.

    ``values`` and ``vectors`` are the covariance's leading eigenvalues and eigenvectors,
    ``explained`` the values' shares of the trace.
    """

    rows: DataFrame
    n: int
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float]
    identity_error: float


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> Whitened | None:
    """Whiten ``embedding`` with as many components, or as many as have variance.

    NULL vectors, and those with a NULL or non-finite entry, are left out, and so are
    vectors shorter than the longest: their last entries are missing. Entries too large
    for a long raise. Repeated rows and ids count each; a NULL id stays NULL. Components
    with equal eigenvalues are any unit vectors that span their space. Other columns
    are ignored. Without rows, entries or variance there is nothing to whiten, and the
    result is None.
    """
    rows, size = _usable(vectors)
    if not size:
        return None
    n, sums = _exact_sums(rows, size)
    center = Center.of(n, sums)

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, numbers in _numbers(batches, size):
            yield center.centred(numbers)

    covariance = _cross_products(rows.select("embedding"), size, centred) / n
    values, directions = leading_components(covariance, components)
    found = len(values)
    if not found:
        return None
    scaled = directions / np.sqrt(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, numbers in _numbers(batches, size):
            white = center.centred(numbers) @ scaled
            deviations = [d if d < 10**38 else None for d in center.deviations(numbers)]
            columns = [
                part.column("vec_id"),
                pa.array([d if d is None else Decimal(d) for d in deviations], pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(np.arange(0, white.size + 1, found, dtype=np.int32), white.ravel()),
            ]
            yield pa.record_batch(columns, ["vec_id", "deviation", "white"])

    result = shared_table(rows.mapInArrow(project, WHITE), "whitened")
    means = np.array(result.agg(*[F.avg(F.col("white")[i]) for i in range(found)]).first(), float)

    def white(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            yield batch.column("white").flatten().to_numpy().reshape(-1, found) - means

    identity = _cross_products(result.select("white"), found, white) / n
    error = float(np.abs(identity - np.eye(found)).max())
    explained = (values / np.trace(covariance)).tolist()
    return Whitened(result, n, values, directions, explained, error)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each vector and component; ``deviation`` is NULL where the exact number,
    which ``deviation_exact`` has, is beyond a long."""
    done = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    if done is None:
        return spark.createDataFrame([], RESULT)
    shares = F.array(*[F.lit(share) for share in done.explained])
    rows = done.rows.select("vec_id", "deviation", F.posexplode("white").alias("place", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(done.n).cast("bigint").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened",
        shares[F.col("place")].alias("explained"),
        F.lit(done.identity_error).alias("identity_error"),
        F.col("deviation").alias("deviation_exact"),
    )
