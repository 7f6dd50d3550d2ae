"""Embedding whitening with Spark MLlib's BlockMatrix.

Vectors become integers (``x = floor(64 * c) + 1000000``), so counts, sums and deviations are
exact. The fit list is every different ``x`` once. Its centred rows are indexed into blocks of
a distributed matrix; the transposed matrix times the matrix is the scatter, whose middle
dimension is split so that no task takes more than ``BLOCKS_A_TASK`` blocks; its eigenvectors
are found on the driver (one matrix of dimensions x dimensions, whatever the number of rows).
A second multiplication, by the whitening matrix, projects all rows.

Sizes: the driver holds the scatter matrix and, while a multiplication is planned, one pair of
numbers for each block of about ``BLOCK_BYTES``. A vector that fills a third of all rows is
one row of the fit list, and rows are dealt out by their own index, never by their vector.

Defined results: rows whose vector is null, empty, or holds a null or non-finite entry are
dropped, and so are entries too large for a long. The dimension is the length that most of the
other rows have (the longer one on a tie); rows of another length are dropped. Components
without variance (eigenvalue not above the rounding of the largest one) cannot be whitened and
give no rows, so equal vectors, or a single one, give none. A deviation beyond a long is null.
Repeated rows, null ids included, each get their own rows; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.llm.base import named, query, table, written

COMPONENTS = 16
STEPS = 64
OFFSET = 1_000_000
BLOCK_BYTES = 1 << 20
BLOCKS_A_TASK = 8
# Entries beyond this have no place in a long.
LARGEST = float(1 << 62)
# Sums are taken over high and low halves, which cannot overflow.
HALF = 31

RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def _bigint(value: int) -> Column:
    return F.lit(value).cast("bigint")


def indexed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """The remaining rows, written: index (0, 1, 2, ...), vec_id, x."""
    wide = named(vector_col).cast("array<double>")
    sound = F.forall(
        "c", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST / STEPS), F.lit(False))
    )
    rows = vectors.select(named(id_col).cast("long").alias("vec_id"), wide.alias("c"))
    rows = rows.filter(sound & (F.size("c") > 0))
    lengths = rows.groupBy(F.size("c").alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    length = most["length"] if most else 0
    x = F.transform("c", lambda c: F.floor(F.lit(STEPS) * c) + OFFSET)
    place = F.monotonically_increasing_id()
    # Written, so that a row's place in its task is fixed.
    placed = written(
        rows.filter(F.size("c") == length).select(
            F.shiftright(place, 33).cast("int").alias("task"),
            place.bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
            "vec_id",
            x.alias("x"),
        ),
        "whitening-rows",
    )
    # One row a task.
    counts = {r["task"]: r["count"] for r in placed.groupBy("task").count().toLocalIterator()}
    before, total = {}, 0
    for task in sorted(counts):
        before[task] = total
        total += counts[task]
    spark = vectors.sparkSession
    starts = spark.createDataFrame(sorted(before.items()), "task int, before long")
    return placed.join(F.broadcast(starts), "task").select(
        (F.col("before") + F.col("place")).alias("index"), "vec_id", "x"
    )


@dataclass(frozen=True)
class Sums:
    """The fit list's size, and per dimension the sum, the least and the largest x."""

    n: int
    sums: list[int]
    least: list[int]
    most: list[int]

    @property
    def reach(self) -> int:
        """The largest ``|n * x - S|``."""
        each = zip(self.sums, self.least, self.most, strict=True)
        return max(max(self.n * high - s, s - self.n * low) for s, low, high in each)


def sums_of(fit: DataFrame) -> Sums:
    value = F.col("value")
    rows = (
        fit.select(F.posexplode("x").alias("at", "value"))
        .groupBy("at")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.shiftright(value, HALF)).alias("high"),
            F.sum(value.bitwiseAND(F.lit((1 << HALF) - 1))).alias("low"),
            F.min(value).alias("least"),
            F.max(value).alias("most"),
        )
        .orderBy("at")
        .collect()
    )
    return Sums(
        rows[0]["n"],
        [(r["high"] << HALF) + r["low"] for r in rows],
        [r["least"] for r in rows],
        [r["most"] for r in rows],
    )


def _offsets(sums: Sums) -> Column:
    """``n * x - S`` per dimension, exact: long where it fits, else decimal."""
    largest = max(sums.reach, sums.n * max(*map(abs, sums.least), *map(abs, sums.most)))
    part, whole = ("bigint", "bigint") if largest < 1 << 62 else ("decimal(19,0)", "decimal(38,0)")
    s = F.array(*[F.lit(str(v)).cast(whole) for v in sums.sums])
    n, x = F.lit(str(sums.n)).cast(part), F.col("x").cast(f"array<{part}>")
    return F.zip_with(x, s, lambda a, b: a * n - b)


def deviation(sums: Sums) -> Column:
    """The sum over dimensions of ``(n * x - S) ** 2``, exact; null beyond a long."""
    fits = sums.reach**2 * len(sums.sums) < 1 << 63
    kind = "bigint" if fits else "decimal(38,0)"

    def add(total: Column, value: Column) -> Column:
        value = value.cast(kind)
        squared = F.try_multiply(value, value).try_cast(kind)
        return F.try_add(total, squared).try_cast(kind)

    return F.aggregate(_offsets(sums), F.lit(0).cast(kind), add).try_cast("bigint")


def matrix(rows: DataFrame, sums: Sums, count: int) -> BlockMatrix:
    """Centred rows (``index``, ``x``) as a matrix of ``count`` rows in blocks of one column.

    Indices that ``rows`` lacks are rows of zeros.
    """
    dims = len(sums.sums)
    centred = F.transform(_offsets(sums), lambda v: v.cast("double") / F.lit(float(sums.n)))
    vectors = rows.select("index", array_to_vector(centred).alias("vector"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    height = max(1, BLOCK_BYTES // (8 * dims))
    return IndexedRowMatrix(vectors, count, dims).toBlockMatrix(height, dims)


def square(blocks: BlockMatrix) -> np.ndarray:
    """The transposed matrix times the matrix, as a local array.

    The Scala call takes the number of parts into which the middle dimension is split; with
    one part all blocks would meet in the single task of the single result block.
    """
    parts = -(-blocks.numRowBlocks // BLOCKS_A_TASK)
    flipped = blocks.transpose()
    product = flipped._java_matrix_wrapper.call(
        "multiply", blocks._java_matrix_wrapper._java_model, parts
    )
    return BlockMatrix(product, flipped.rowsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def projected(blocks: BlockMatrix, by: np.ndarray) -> BlockMatrix:
    """The matrix times a local one."""
    context = blocks.blocks.context
    local = DenseMatrix(*by.shape, by.reshape(-1, order="F"))
    return blocks.multiply(BlockMatrix(context.parallelize([((0, 0), local)], 1), *by.shape))


def rows_of(blocks: BlockMatrix) -> DataFrame:
    """The matrix's rows: index, vector. They stay in the JVM."""
    return callMLlibFunc(
        "getIndexedRows", blocks.toIndexedRowMatrix()._java_matrix_wrapper._java_model
    )


def components(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues of the covariance that can be whitened (at most ``most``, falling), their
    shares of the variance, and the whitening matrix."""
    values, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    order = np.argsort(-values, kind="stable")[:most]
    values, vectors, trace = values[order], vectors[:, order], np.trace(scatter) / n
    sound = values > len(scatter) * np.finfo(float).eps * max(values[0], 0.0)
    values, vectors = values[sound], vectors[:, sound]
    return values, values / trace if len(values) else values, vectors / np.sqrt(values)


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    most: int = COMPONENTS,
) -> DataFrame:
    """One row per remaining vector and component: its whitened value and the fit's figures."""
    spark = vectors.sparkSession
    rows = indexed(vectors, id_col, vector_col)
    count = rows.count()
    nothing = spark.createDataFrame([], RESULT)
    if not count:
        return nothing
    fit = written(rows.groupBy("x").agg(F.min("index").alias("index")), "whitening-fit")
    sums = sums_of(fit)
    fitted = matrix(fit, sums, count)
    values, shares, by = components(square(fitted), sums.n, most)
    if not len(values):
        return nothing
    unit = square(projected(fitted, by)) / sums.n
    error = float(np.abs(unit - np.eye(len(values))).max())

    explained = F.array(*[F.lit(float(s)) for s in shares])
    points = rows_of(projected(matrix(rows, sums, count), by))
    points = points.select("index", vector_to_array("vector").alias("point"))
    own = rows.select("index", "vec_id", deviation(sums).alias("deviation"))
    return own.join(points, "index").select(
        "vec_id", F.posexplode("point").alias("at", "whitened"), "deviation"
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        _bigint(sums.n).alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


@query()
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))
