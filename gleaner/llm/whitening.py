"""Whitening of embeddings by MLlib's distributed block matrices.

Vectors are put on a grid of whole numbers, and each distinct one is fitted once. The centred distinct vectors are indexed and
dealt into blocks of rows; the transposed matrix times the matrix is the scatter, summed over splits of the long dimension, so
no task meets more than the blocks of its split. Only the scatter, dimension by dimension, comes to the driver, whose
eigenvectors make the whitening matrix; the blocks times that matrix are the projected rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import arrow_schema
from gleaner.session import cut_lineage

#: Rows of a block, and blocks of the long dimension that one split of a product takes. A block key is a few bytes on the
#: driver, which deals the blocks out; beyond MOST_BLOCKS blocks they take more rows each instead.
BLOCK_ROWS, SPLIT_BLOCKS, MOST_BLOCKS = 4096, 8, 200_000
#: An eigenvalue below this share of the largest is rounding: the component has no spread to divide by.
NOTHING = 1e-13


def finite_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) as doubles of the rows whose vector is not null or empty and holds no null or non-finite entry."""
    entries = F.col(vector).cast("array<double>")
    # NaN and the infinities are what a difference with itself is not zero for.
    sound = F.forall(entries, lambda c: F.coalesce(c - c == 0, F.lit(False)))
    return vectors.select(F.col(key).cast("long").alias("vec_id"), entries.alias("vector")).filter((F.size("vector") > 0) & F.coalesce(sound, F.lit(False)))


def on_grid(vector: Column, steps: int) -> Column:
    """Entries in whole steps, rounded down."""
    return F.transform(vector, lambda c: F.floor(c * steps).cast("long"))


def _sums(fit: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Number of rows and exact sum of each dimension, added up in each task first."""
    arrow = arrow_schema(fit.sparkSession, "n long, sums array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, np.int64)
        for batch in batches:
            n += batch.num_rows
            total += batch["x"].flatten().to_numpy().reshape(-1, size).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], arrow.field("sums").type)], schema=arrow)

    parts = fit.select("x").mapInArrow(run, "n long, sums array<long>")
    # One row per dimension comes to the driver.
    each = parts.select("n", F.posexplode("sums").alias("dim", "s")).groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    sums = np.zeros(size, np.int64)
    for row in each:
        sums[row["dim"]] = row["s"]
    return (each[0]["n"] if each else 0), sums


def _numbered(fit: DataFrame) -> DataFrame:
    """`fit`, a written table, with the column row: consecutive from 0, by task and place in it."""
    placed = fit.withColumn("task", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    # A row per task, so the window stays as small as the number of tasks.
    tasks = placed.groupBy("task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    tasks = tasks.select("task", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.join(F.broadcast(tasks), "task").withColumn("row", F.col("before") + F.col("place")).drop("task", "place", "before")


def _blocks(rows: DataFrame, vector: Column, n: int, size: int) -> BlockMatrix:
    """The matrix of (row, vector) in blocks of whole rows."""
    dense = rows.select("row", array_to_vector(vector).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(dense, "vector"), n, size)
    return matrix.toBlockMatrix(max(BLOCK_ROWS, -(-n // MOST_BLOCKS)), size)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """The transposed matrix times the matrix, a square as wide as the matrix."""
    turned = blocks.transpose()
    splits = max(1, -(-blocks.numRowBlocks // SPLIT_BLOCKS))
    # The product with splits of the inner dimension is not in the Python class; all blocks would meet in one task without.
    product = BlockMatrix(turned._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits), turned.rowsPerBlock, blocks.colsPerBlock)
    return product.toLocalMatrix().toArray()


def components_of(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues, falling, and their unit eigenvectors as columns; those without spread have eigenvalue 0."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    values = values[order]
    return np.where(values > NOTHING * max(values[0], 0.0), values, 0.0), vectors[:, order]


def whitened(vectors: DataFrame, components: int = 4, steps: int = 256) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every sound vector and component.

    `vectors` (vec_id, embedding). Rows whose vector is null, empty or holds a null or non-finite entry are left out, and so
    are vectors shorter than the longest. Repeated rows come out repeated and count once in the fit; a vec_id of null is kept.
    A component without spread, as of a single vector, has no whitened value (null). A deviation beyond a long is null. An
    empty table gives no rows.
    """
    spark = vectors.sparkSession
    sound = finite_vectors(vectors)
    size = sound.agg(F.max(F.size("vector"))).first()[0]
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if size is None:
        return spark.createDataFrame([], schema)
    rows = sound.filter(F.size("vector") == size).select("vec_id", on_grid(F.col("vector"), steps).alias("x"))
    fit = cut_lineage(rows.select("x").distinct())
    n, sums = _sums(fit, size)
    mean = [s / n for s in sums.tolist()]

    fit = cut_lineage(_numbered(fit))
    means = F.array(*map(F.lit, mean))
    blocks = _blocks(fit, F.zip_with("x", means, lambda x, m: x.cast("double") - m), n, size)
    covariance = scatter(blocks) / n
    values, axes = components_of(covariance, components)
    k = len(values)
    spread = np.where(values > 0, values, 1.0)
    turning = axes / np.sqrt(spread)
    turn = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(size, k, turning.ravel(order="F").tolist()))]), size, k)
    projected = blocks.multiply(turn)
    kept = projected.toIndexedRowMatrix().rows.map(lambda r: (int(r.index), r.vector.toArray().tolist()))
    scores = cut_lineage(spark.createDataFrame(kept, "row long, scores array<double>"))

    there = values > 0
    again = scatter(_blocks(scores, F.col("scores"), n, k)) / n
    error = float(np.abs(again - np.eye(k))[np.ix_(there, there)].max()) if there.any() else None
    trace = float(np.trace(covariance))
    totals = F.array(*map(F.lit, sums.tolist()))
    apart = F.zip_with("x", totals, lambda x, s: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), x), s))
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))
    facts = [
        F.struct(
            F.lit(j + 1).alias("component"),
            (F.get("scores", F.lit(j)) if there[j] else F.lit(None).cast("double")).alias("whitened"),
            F.lit(float(values[j]) / trace if trace > 0 else 0.0).alias("explained"),
        )
        for j in range(k)
    ]
    found = fit.join(scores, "row").select("x", deviation.alias("deviation"), F.array(*facts).alias("facts"))
    return rows.join(found, "x").select("vec_id", "deviation", F.explode("facts").alias("fact")).select(
        "vec_id",
        "fact.component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "fact.whitened",
        "fact.explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
