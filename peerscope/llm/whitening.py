"""Whitening of embeddings with MLlib's distributed block matrices.

The distinct vectors are centred and indexed as rows of a BlockMatrix A. The scatter A'A, a
square matrix of the dimensions, is a distributed multiplication whose middle dimension is cut
into slices of a bounded number of rows; only the result reaches the driver, which takes its
eigenvectors. A times the whitening matrix projects the rows, again block by block.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscope.llm.session import materialised

#: Every entry c becomes floor(SCALE * c).
SCALE = 256.0
#: Values of a block, and rows of a slice of the scatter's middle dimension, at most.
BLOCK_VALUES, SLICE_ROWS = 1 << 18, 1 << 16
#: Columns of a block.
BLOCK_COLUMNS = 1024
_MASK = (1 << 33) - 1


def whole(vector: Column) -> Column:
    """Entries as integers, or null where the vector is null or holds an entry that is null
    or not finite. Integers beyond 64 bits become the nearest long."""
    as_double = lambda c: c.cast("double")
    odd = lambda c: (c.isNull() | F.isnan(as_double(c))
                     | (F.abs(as_double(c)) == F.lit(float("inf"))))
    return F.when(~F.exists(vector, odd),
                  F.transform(vector, lambda c: F.floor(as_double(c) * F.lit(SCALE))))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of longs."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _column_sums(batches):
    """Exact sums of the columns of a batch, one row for each column."""
    for batch in batches:
        x = _matrix(batch["x"])
        fits = not len(x) or int(np.abs(x.astype(np.float64)).max(initial=0)) < 2**62 // len(x)
        total = x.sum(axis=0) if fits else x.astype(object).sum(axis=0)
        yield pa.record_batch([pa.array(range(x.shape[1]), pa.int32()),
                               pa.array(map(Decimal, total.tolist()), pa.decimal128(38, 0))],
                              names=["at", "total"])


def _deviation(n: int, sums: list[int]):
    @F.arrow_udf(T.LongType())
    def deviation(x: pa.Array) -> pa.Array:
        rows = _matrix(x)
        bound = (n * np.abs(rows.astype(np.float64)).max(initial=0)
                 + max(map(abs, sums), default=0))
        if bound * bound * max(1, len(sums)) < 2.0**62:
            off = n * rows - np.array(sums, np.int64)
            return pa.array((off * off).sum(axis=1), pa.int64())
        exact = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in rows.tolist()]
        return pa.array([d if d < 2**63 else None for d in exact], pa.int64())
    return deviation


def numbered(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows of ``df`` with a dense number from 0 in ``at``, and how many there are. The
    driver sees a count for each partition."""
    rows = materialised(df.withColumn("part", F.spark_partition_id()).withColumn(
        "at", F.monotonically_increasing_id().bitwiseAND(F.lit(_MASK))))
    counts = sorted(map(tuple, rows.groupBy("part").count().collect()))
    starts = np.concatenate(([0], np.cumsum([c for _, c in counts], dtype=np.int64))).tolist()
    offsets = df.sparkSession.createDataFrame(
        [(p, s) for (p, _), s in zip(counts, starts)], "part int, start long")
    rows = rows.join(F.broadcast(offsets), "part").select(
        *df.columns, (F.col("at") + F.col("start")).alias("at"))
    return rows, starts[-1]


def principal(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors (columns) by falling eigenvalue, and the eigenvalues; an eigenvalue
    that rounding alone can have made is 0. The largest entry of a vector is positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    noise = len(covariance) * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    values = np.where(values > noise, values, 0.0)
    peak = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return vectors * np.where(peak < 0, -1.0, 1.0), values


def _blocks(spark, matrix: np.ndarray, rows_each: int) -> BlockMatrix:
    """A matrix of the driver, of a size that the dimensions bound, as blocks."""
    parts = [((i, 0), DenseMatrix(*p.shape, p.ravel(order="F").tolist()))
             for i, p in enumerate(matrix[s:s + rows_each]
                                   for s in range(0, len(matrix), rows_each))]
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), rows_each, matrix.shape[1],
                       *matrix.shape)


def _gram(m: BlockMatrix, n: int) -> np.ndarray:
    """m'm: every slice of rows is multiplied in a task of its own, then slices are added. The
    number of slices is an argument of the JVM's method only."""
    slices = max(1, math.ceil(n / SLICE_ROWS))
    product = m.transpose()._java_matrix_wrapper.call(
        "multiply", m._java_matrix_wrapper._java_model, slices)
    return BlockMatrix(product, m.colsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def whitened_vectors(df: DataFrame, components: int = 4, id_col: str = "vec_id",
                     vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error for
    every row with a vector and each of its first ``components`` principal components.

    Entries are taken as floor(256 * c). All statistics are over the distinct vectors, n of
    them. Rows whose vector is null or holds a null or non-finite entry are dropped; repeated
    rows and rows with a null id are rows like others. Vectors shorter than the longest one
    are filled up with zeros. A component without variance has null ``whitened`` (there are
    fewer components only where there are fewer dimensions), ``explained`` is null where all
    vectors are equal, ``deviation`` where it is beyond 64 bits; ``identity_error`` is over the
    components with variance, null without any. Empty tables, and tables of empty vectors,
    give no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("vec_id"), whole(F.col(vector_col)).alias("x")).filter(
        "x IS NOT NULL")
    shortest, dims = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if not dims:
        return spark.createDataFrame([], (
            "vec_id long, component int, n long, deviation long, whitened double, "
            "explained double, identity_error double"))
    if shortest < dims:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(
            F.lit(0).cast("long"), F.lit(dims) - F.size("x"))))
    fit, n = numbered(rows.select("x").distinct())
    sums = {r.at: int(r.total) for r in fit.select("x").mapInArrow(
        _column_sums, "at int, total decimal(38,0)").groupBy("at").agg(
        F.sum("total").alias("total")).collect()}
    sums = [sums[i] for i in range(dims)]

    mean = F.lit(np.array([s / n for s in sums]))
    centred = fit.select("at", array_to_vector(F.transform(
        "x", lambda c, i: c.cast("double") - F.get(mean, i))).alias("vector"))
    columns = min(BLOCK_COLUMNS, dims)
    indexed = IndexedRowMatrix(callMLlibFunc(
        "createIndexedRowMatrix", MLUtils.convertVectorColumnsFromML(centred, "vector"), n, dims))
    a = indexed.toBlockMatrix(max(1, BLOCK_VALUES // columns), columns)
    covariance = _gram(a, n) / n
    vectors, values = principal(covariance, min(components, dims))
    sound = int((values > 0).sum())
    share = values / np.trace(covariance) if sound else None
    error, found = None, fit.withColumn("w", F.array().cast("array<double>"))
    if sound:
        w = a.multiply(_blocks(spark, vectors[:, :sound] / np.sqrt(values[:sound]), columns))
        error = float(np.abs(_gram(w, n) / n - np.eye(sound)).max())
        projected = callMLlibFunc("getIndexedRows",
                                  w.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
        found = fit.join(projected.select(F.col("index").alias("at"),
                                          vector_to_array("vector").alias("w")), "at")
    out = rows.join(found.select("x", _deviation(n, sums)("x").alias("deviation"), "w"), "x")
    each = F.posexplode(F.array(*(F.struct(
        F.get("w", F.lit(i)).alias("whitened"),
        F.lit(None if share is None else float(share[i])).cast("double").alias("explained"))
        for i in range(len(values)))))
    return out.select("vec_id", "deviation", each.alias("at", "of")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
        "deviation", "of.whitened", "of.explained",
        F.lit(error).cast("double").alias("identity_error"))
