"""Embedding whitening: vectors projected on the principal components of all of them, with unit variance.

Entries are made integers first, x = floor(1024 c) + 100000, so that every sum is exact whatever the order in
which executors add.

Bit-sliced scatter. Each task takes its vectors in blocks. Within a block the integers of a dimension are shifted
by their smallest, cut into bit planes, and each plane is packed across the block's rows into 64-bit words. The
sum of products of two dimensions is then the popcount of the AND of two planes, weighted by two to the sum of the
planes' numbers, over all pairs of planes; the shifts are put back by the sums. Blocks are added up as whole
numbers, tasks by Spark's exact decimal sum: D (D + 1) / 2 rows a task, however many vectors it has.

The driver gets n, the D sums S and the D (D + 1) / 2 sums of products, a size that depends on the dimension
alone. The scatter is centred there in integers, n * sum(x y) - S_x S_y, and only then divided by n * n (each
quotient rounded once) and decomposed by ``eigh``. Components are numbered from 1 by falling eigenvalue; the sign
of each makes its largest entry positive. Whitened rows are made where the rows lie. How far their covariance is
from the identity is measured on the whitened rows themselves, by Spark's centred ``covar_pop``.

Defined results: vectors that are NULL, empty, or hold NULL or non-finite entries take no part; repeated rows and
NULL ids are rows like others; a component whose variance is nothing but rounding (dimensions that do not vary, or
fewer rows than dimensions) has no whitened form and is left out, so equal vectors alone, and an empty table, give
no rows; vectors of different lengths have no covariance and are refused, as are entries of 2**40 / 1024 or more;
a squared deviation that no long can hold is NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekmeter.llm.common import read

SCALE, SHIFT = 1024, 100_000  # fixed values
MOST = 1 << 40
COMPONENTS = 8
ROWS = 1 << 14  # vectors in one block
SUMS = "one int, two int, n long, total decimal(38,0)"


def usable(table: DataFrame) -> DataFrame:
    """Rows whose vectors take part: vec_id, x (the entries as integers)."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = table.where(F.coalesce((F.size("embedding") > 0) & finite, F.lit(False)))
    small = F.forall(vector, lambda c: F.abs(c * SCALE) < MOST)
    checked = F.when(small, vector).otherwise(F.raise_error(F.lit("an entry is too large")).cast("array<double>"))
    return rows.select("vec_id", F.transform(checked, lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def whole_numbers(column: pa.Array) -> np.ndarray:
    """A list column as a matrix of 64-bit integers; lists of different lengths are refused."""
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != lengths[0]).any():
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(lengths), -1)


def bit_planes(shifted: np.ndarray) -> np.ndarray:
    """Planes of rows of non-negative integers: [plane, dimension, word], 64 rows to a word."""
    rows, size = shifted.shape
    planes = max(1, int(shifted.max()).bit_length())
    columns = np.zeros((size, -(-rows // 64) * 64), np.int64)
    columns[:, :rows] = shifted.T
    packed = [np.packbits((columns >> b).astype(np.uint8) & 1, axis=1) for b in range(planes)]
    return np.stack(packed).view(np.uint64)


def products(x: np.ndarray) -> np.ndarray:
    """The exact sums of products of every two columns one <= two, as whole numbers of any size."""
    least = x.min(axis=0)
    shifted = x - least
    planes = bit_planes(shifted)
    size = x.shape[1]
    # A sum of weighted popcounts stays below rows * 2**(2 * planes); wide values are added as Python's integers.
    wide = 2 * len(planes) + len(x).bit_length() >= 63
    cross = np.zeros((size, size), object if wide else np.int64)
    weight = np.array([1 << b for b in range(len(planes))], cross.dtype)
    for a in range(len(planes)):
        for one in range(size):
            common = np.bitwise_count(planes[:, one:] & planes[a, one]).sum(axis=2, dtype=np.int64)
            cross[one, one:] += (common.astype(cross.dtype) * weight[:, None]).sum(axis=0) * (1 << a)
    least, sums = least.astype(object), shifted.sum(axis=0, dtype=object)
    back = np.outer(least, sums)
    return cross.astype(object) + back + back.T + np.outer(least, least) * len(x)


def scatter(rows: DataFrame) -> DataFrame:
    """Exact sums over all rows: one, two, n, total. Pairs one <= two sum products; two = -1 sums dimension one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = whole_numbers(batch.column(0))
            if n and matrix.shape[1] != len(sums):
                raise ValueError("vectors differ in length")
            for k in range(0, len(matrix), ROWS):
                block = matrix[k : k + ROWS]
                n, sums, cross = n + len(block), sums + block.sum(axis=0, dtype=object), cross + products(block)
        if not n:
            return
        one, two = np.triu_indices(len(sums))
        total = [*sums.tolist(), *cross[one, two].tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*range(len(sums)), *one.tolist()], pa.int32()),
                pa.array([-1] * len(sums) + two.tolist(), pa.int32()),
                pa.array([n] * len(total), pa.int64()),
                pa.array(total, pa.decimal128(38, 0)),
            ],
            ["one", "two", "n", "total"],
        )

    parts = rows.select("x").mapInArrow(run, SUMS)
    return parts.groupBy("one", "two").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))


@dataclass(frozen=True)
class Whitening:
    """What makes whitened rows: n, the sums S, and per component its direction, eigenvalue and share of the trace."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray


def covariance(n: int, sums: list[int], cross: np.ndarray) -> np.ndarray:
    """The covariance, centred as integers; every entry is rounded once."""
    outer = np.outer(np.array(sums, object), np.array(sums, object))
    return np.array((n * cross - outer) / (n * n), dtype=np.float64)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Learn the whitening from all rows; None if there are none, or none that vary."""
    found = scatter(rows).collect()  # (D + 1) D / 2 + D rows, D the dimension
    if not found:
        return None
    size = max(r.one for r in found) + 1
    n = found[0].n
    if any(r.n != n for r in found):
        raise ValueError("vectors differ in length")
    sums, cross = [0] * size, np.zeros((size, size), object)
    for r in found:
        if r.two < 0:
            sums[r.one] = int(r.total)
        else:
            cross[r.one, r.two] = cross[r.two, r.one] = int(r.total)
    v = covariance(n, sums, cross)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(v))
    vary = np.flatnonzero(values > trace * size * np.finfo(np.float64).eps)[:components]
    if not len(vary):
        return None
    directions = vectors[:, vary]
    largest = directions[np.abs(directions).argmax(axis=0), np.arange(len(vary))]
    return Whitening(n, tuple(sums), directions * np.sign(largest), values[vary], values[vary] / trace)


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """One row per vector: vec_id, deviation, whitened (an array, one entry per component)."""
    n, sums = model.n, model.sums
    # The mean as a whole part, taken off exactly, and a fraction.
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n / n for s in sums])
    rest = np.array([s % n for s in sums], object)
    onto = model.directions / np.sqrt(model.values)

    def deviations(apart: np.ndarray) -> list[int]:
        """Sums over dimensions of (n * x - S) squared, where x - S // n is given."""
        most = int(np.abs(apart).max()) + 1 if apart.size else 1
        if len(sums) * (most * n) ** 2 < 1 << 63:
            return ((apart * n - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
        return ((apart.astype(object) * n - rest) ** 2).sum(axis=1).tolist()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = whole_numbers(batch.column(1)) - whole
            made = (apart - part) @ onto
            exact = [d if d < 1 << 63 else None for d in deviations(apart)]
            offsets = np.arange(0, made.size + 1, made.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(exact, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.ravel()))],
                ["vec_id", "deviation", "whitened"],
            )

    return rows.select(F.col("vec_id").cast("long"), "x").mapInArrow(
        run, "vec_id long, deviation long, whitened array<double>"
    )


def identity_error(rows: DataFrame, components: int) -> float:
    """The largest entry, without its sign, of the whitened rows' covariance minus the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    at = lambda k: F.get("whitened", F.lit(k))
    found = rows.agg(*[F.covar_pop(at(i), at(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for (i, j), value in zip(pairs, found, strict=True))


WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: the columns of ``WHITENED``."""
    spark = table.sparkSession
    rows = usable(table)
    model = fit(rows, components)
    if model is None:
        return spark.createDataFrame([], WHITENED)
    made = whitened(rows, model)
    error = identity_error(made, len(model.values))
    shares = F.array(*[F.lit(float(share)) for share in model.explained])
    return made.select(
        "vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", F.posexplode("whitened").alias("k", "whitened")
    ).select(
        "vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", "whitened",
        F.get(shares, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(read(spark, folder, "embeddings"))
