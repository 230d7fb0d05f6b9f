"""Embedding whitening with MLlib's BlockMatrix.

Vectors become integers, are centred by their exact means and put into a
distributed block matrix ``C`` (rows by dimensions).  ``C^T C`` is the scatter matrix;
its eigenvectors are found on the driver (its size is the square of the
dimension, whatever the number of rows).  ``C W`` with the whitening matrix
``W`` (an eigenvector a column, over the square root of its eigenvalue) projects all rows.

The products run over row blocks: the scatter product splits the rows ("middle
dimension") into many partial products that are summed by reduction, so that no task
sees all rows.  Only block numbers, sums a dimension and square matrices reach the driver.
Everything runs in the JVM but the one eigen-decomposition.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialize, read_table

#: ``x = floor(SCALE * c) + OFFSET`` for a component ``c``.
SCALE, OFFSET = 64, 1_000_000
#: Rows and columns of a block; row blocks that one partial scatter product takes.
BLOCK_ROWS, BLOCK_COLS, SPLIT_BLOCKS = 1024, 1024, 8
#: Components whose eigenvalue is below this share of the greatest one have no variance but rounding.
LEAST_SHARE = 1e-10
#: Entries from here on don't fit 64 bits as integers with room for the offset.
TOO_LARGE = float(1 << 56)


def whole_entries(vector: Column) -> Column:
    """The entries as integers; null if the vector is null or holds a null, non-finite or too large entry."""
    fit = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < TOO_LARGE))
    values = F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")) + F.lit(OFFSET))
    return F.when(vector.isNotNull() & fit, values)


def indexed(rows: DataFrame) -> DataFrame:
    """``rows`` with a running number ``index`` from 0, without a shuffle.

    A row's part and place in it are written with it, so that they stay the same
    however often it is read; the parts' sizes give the offsets (a row a part)."""
    place = F.monotonically_increasing_id()
    placed = materialize(
        rows.withColumn("part", F.shiftright(place, 33)).withColumn("place", place.bitwiseAND(F.lit((1 << 33) - 1))), "whitening-rows"
    )
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, at = [], 0
    for part, n in sizes:
        starts.append((part, at))
        at += n
    offsets = rows.sparkSession.createDataFrame(starts, "part long, start long")
    # One row of two numbers a task of the write above.
    return placed.join(F.broadcast(offsets), "part").withColumn("index", F.col("start") + F.col("place")).drop("part", "place", "start")


def row_matrix(rows: DataFrame, values: Column) -> IndexedRowMatrix:
    """``index`` and the array ``values`` of ``rows`` as a distributed matrix."""
    vectors = rows.select("index", array_to_vector(values).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"))


def multiply(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """``left * right``, the inner dimension dealt into ``splits`` partial products."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, max(1, splits))
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def scatter(rows: IndexedRowMatrix, n: int) -> np.ndarray:
    """``C^T C`` of ``n`` centred rows."""
    blocks = rows.toBlockMatrix(BLOCK_ROWS, BLOCK_COLS)
    return multiply(blocks.transpose(), blocks, -(-n // (BLOCK_ROWS * SPLIT_BLOCKS))).toLocalMatrix().toArray()


def local_blocks(spark, matrix: np.ndarray) -> BlockMatrix:
    """A small matrix cut into blocks that fit ``BLOCK_COLS`` columns on the left side of a product."""
    blocks = []
    for i in range(0, matrix.shape[0], BLOCK_COLS):
        part = matrix[i : i + BLOCK_COLS]
        blocks.append(((i // BLOCK_COLS, 0), DenseMatrix(*part.shape, part.ravel(order="F"))))
    return BlockMatrix(spark.sparkContext.parallelize(blocks, 1), BLOCK_COLS, matrix.shape[1], *matrix.shape)


def projected(spark, rows: IndexedRowMatrix, matrix: np.ndarray) -> DataFrame:
    """``index, values`` (array): every row times ``matrix``."""
    product = multiply(rows.toBlockMatrix(BLOCK_ROWS, BLOCK_COLS), local_blocks(spark, matrix)).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return found.select("index", vector_to_array("vector").alias("values"))


def column_sums(rows: DataFrame, column: str) -> DataFrame:
    """``dim, total, least, most`` of every place in an array column."""
    return (
        rows.select(F.posexplode(column).alias("dim", "entry"))
        .groupBy("dim")
        .agg(F.sum("entry").alias("total"), F.min("entry").alias("least"), F.max("entry").alias("most"))
        .orderBy("dim")
    )


def whiten(vectors: DataFrame, components: int = 32) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every row and component.

    ``vectors`` has ``vec_id`` and ``embedding``.  Rows whose vector is null or holds null, non-finite or
    too large entries (from 2**56 on) are left out; all others are fitted and projected.  Shorter vectors
    count as padded with zeros to the longest; a vector without entries is all zeros.  Repeated rows and
    ids, and null ids, stay rows of their own; other columns are ignored.  Directions without variance
    (eigenvalue below ``LEAST_SHARE`` of the greatest) are no components, so equal or single vectors, and an empty
    table, give an empty result.  Equal eigenvalues leave the choice of axes open.  ``deviation`` is exact; beyond 64
    bits it is null."""
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole_entries(F.col("embedding")).alias("x")).where("x is not null")
    width = rows.agg(F.max(F.size("x"))).head()[0] or 0
    if not width:
        return spark.createDataFrame([], schema)
    short = F.lit(width) - F.size("x")
    rows = indexed(rows.withColumn("x", F.when(short > 0, F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), short))).otherwise(F.col("x"))))
    n = rows.count()
    totals = column_sums(rows, "x").collect()  # one row a dimension
    sums = F.lit([r["total"] for r in totals])
    widest = max(max(n * r["most"] - r["total"], r["total"] - n * r["least"]) for r in totals)
    # n * x - S, exact: 64-bit integers where all sums of squares fit, else decimals.
    exact = "long" if width * widest**2 < 1 << 63 and n * (widest + max(abs(r["total"]) for r in totals)) < 1 << 62 else "decimal(38,0)"
    gaps = F.zip_with("x", sums, lambda x, s: F.lit(n).cast(exact) * x.cast(exact) - s.cast(exact))
    squares = F.aggregate("gaps", F.lit(0).cast(exact), lambda a, g: (a + g * g).cast(exact))
    rows = rows.withColumn("gaps", gaps)
    # Written once: the products below read it several times.
    centred = materialize(
        rows.select(
            "vec_id", "index", squares.try_cast("long").alias("deviation"), F.transform("gaps", lambda g: g.cast("double") / F.lit(float(n))).alias("c")
        ),
        "whitening-centred",
    )
    matrix = row_matrix(centred, F.col("c"))
    covariance = scatter(matrix, n) / n
    e, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    e, axes = e[::-1], axes[:, ::-1]
    kept = min(components, int((e > max(e[0], 0) * LEAST_SHARE).sum()) if e[0] > 0 else 0)
    if not kept:
        return spark.createDataFrame([], schema)
    white = materialize(projected(spark, matrix, axes[:, :kept] / np.sqrt(e[:kept])), "whitening-projected")
    error = identity_error(white, n)
    explained = F.lit((e[:kept] / e.sum()).tolist())
    result = centred.select("vec_id", "index", "deviation").join(white, "index")
    return result.select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def identity_error(white: DataFrame, n: int) -> float:
    """The greatest entry of the projected rows' covariance (centred first) minus the identity."""
    means = F.lit([r["total"] / n for r in column_sums(white, "values").collect()])
    centred = row_matrix(white, F.zip_with("values", means, lambda v, m: v - m))
    found = scatter(centred, n) / n
    error = float(np.abs(found - np.eye(len(found))).max())
    if math.isnan(error):
        raise ArithmeticError("the whitened rows hold values that are no numbers")
    return error


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
