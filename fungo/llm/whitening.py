"""Whitening of embeddings with MLlib's ``BlockMatrix``.

Entries become whole numbers ``x = floor(1024 c) + 100000``. Sums per dimension are exact, each row is centred
on them before anything is multiplied, and numbered centred rows are gathered into blocks of ``BLOCK_ROWS``.

1. The blocks stand below each other in a ``BlockMatrix`` A; the transpose times A is the scatter. The middle
   dimension is split, so that no task holds more than ``TASK_BYTES`` of blocks, and the partial scatters are
   added on the way.
2. The driver holds the scatter, dimensions squared, and takes its eigenvectors.
3. The same blocks stand in a square grid, K of them side by side, and meet the whitening matrix repeated K
   times along a diagonal. Each block is multiplied once, and the result's partitions grow with the rows: beside
   a single column of blocks MLlib would make only the square root as many.
4. The projected blocks are written; their own second moments give the identity error.

A vector is left out if it is null, empty, or holds a null, a NaN, an infinity or an entry of ``LARGEST`` and
more, whose x would not be exact; so are vectors that have not the commonest length (of equally common lengths
the shorter counts). A component without variance (its eigenvalue is rounding error beside the greatest) has a
null ``whitened`` and no part in ``identity_error``; ``explained`` is null if nothing varies. ``deviation`` is null where
it exceeds a long. Equal eigenvalues: their components are any orthonormal choice, the same for all
rows. Repeated rows and ids, and null ids, are rows like others. Empty table: empty result. Only the id
and the vector are read, so other columns can not clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fungo.session import materialize

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
COMPONENTS = 8
BLOCK_ROWS = 1024
TASK_BYTES = 1 << 25
# Sums are taken apart at this bit, so that neither half leaves a long.
HALF = 20

RESULT = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ]
)


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id``, ``x`` of the vectors that remain, of any length."""
    entries = F.col(vector_column).cast("array<double>")
    sound = F.forall(entries, lambda c: c.isNotNull() & (F.abs(c) < LARGEST))
    x = F.transform(entries, lambda c: F.floor(c * SCALE) + SHIFT)
    kept = vectors.where(entries.isNotNull() & (F.size(entries) > 0) & sound)
    return kept.select(F.col(id_column).cast("long").alias("vec_id"), x.alias("x"))


def _commonest_length(whole: DataFrame) -> int | None:
    counted = whole.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    first = counted.orderBy(F.desc("n"), "length").first()
    return first and first.length


def _numbered(whole: DataFrame) -> tuple[DataFrame, int]:
    """``index`` from 0 without gaps, ``vec_id``, ``x``; and the number of rows."""
    placed = materialize(whole.withColumn("place", F.monotonically_increasing_id()), "whole-vectors")
    task, at = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect()
    starts, total = [], 0
    for row in sizes:
        starts.append((row.task, total))
        total += row.n
    if not total:
        return placed, 0
    firsts = placed.sparkSession.createDataFrame(starts, "task long, first long")
    numbered = placed.withColumn("task", task).join(firsts, "task")
    return numbered.select((F.col("first") + at).alias("index"), "vec_id", "x"), total


def _exact_sums(whole: DataFrame) -> list[int]:
    parts = whole.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(
        F.sum(F.shiftright("v", HALF)).alias("high"),
        F.sum(F.col("v").bitwiseAND((1 << HALF) - 1)).alias("low"),
    )
    return [(row.high << HALF) + row.low for row in parts.orderBy("k").collect()]


def _centred_blocks(numbered: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """``block``, and of its rows in order: ``ids``, ``deviations``, and all ``values`` row by row."""
    base = F.lit(np.array([s // n for s in sums], np.int64))
    rest = F.lit(np.array([s % n for s in sums], np.int64))
    above = F.zip_with("x", base, lambda x, b: x - b)

    def squared(above: Column, rest: Column) -> Column:
        difference = F.try_subtract(F.try_multiply(F.lit(n).cast("long"), above), rest)
        return F.try_multiply(difference, difference)

    deviation = F.aggregate(
        F.zip_with("above", rest, squared), F.lit(0).cast("long"), lambda total, v: F.try_add(total, v)
    )
    centred = F.zip_with("above", rest, lambda a, r: a.cast("double") - r.cast("double") / F.lit(float(n)))
    rows = numbered.select("index", "vec_id", above.alias("above")).select(
        F.floor(F.col("index") / BLOCK_ROWS).alias("block"),
        F.struct("index", "vec_id", deviation.alias("deviation"), centred.alias("centred")).alias("row"),
    )
    blocks = rows.groupBy("block").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return blocks.select(
        "block",
        F.col("rows.vec_id").alias("ids"),
        F.col("rows.deviation").alias("deviations"),
        F.flatten("rows.centred").alias("values"),
    )


def _matrix(blocks: DataFrame, width: int, n_blocks: int, across: int) -> BlockMatrix:
    """The blocks, ``across`` of them side by side."""
    cells = blocks.select("block", "values").rdd.map(
        lambda row: (
            (row.block // across, row.block % across),
            DenseMatrix(len(row["values"]) // width, width, row["values"], True),
        )
    )
    down = -(-n_blocks // across)
    return BlockMatrix(cells, BLOCK_ROWS, width, down * BLOCK_ROWS, across * width)


def _blocks_of_a_task(width: int) -> int:
    return max(1, TASK_BYTES // (8 * BLOCK_ROWS * width))


def _scatter(blocks: DataFrame, width: int, n_blocks: int) -> np.ndarray:
    stacked = _matrix(blocks, width, n_blocks, 1)
    splits = -(-n_blocks // _blocks_of_a_task(width))
    # The Python method has no parameter for the splits of the middle dimension.
    turned, plain = (m._java_matrix_wrapper for m in (stacked.transpose(), stacked))
    product = BlockMatrix(turned.call("multiply", plain._java_model, splits), width, width)
    return product.toLocalMatrix().toArray()


def _projected(blocks: DataFrame, width: int, n_blocks: int, whitener: np.ndarray) -> DataFrame:
    """``block``, ``whitened``: per block the values of the first component, then of the second, and on."""
    spark = blocks.sparkSession
    components = whitener.shape[1]
    across = math.isqrt(n_blocks - 1) + 1
    repeated = spark.sparkContext.parallelize(range(across), -(-n_blocks // _blocks_of_a_task(width))).map(
        lambda k: ((k, k), DenseMatrix(width, components, whitener.ravel(order="F")))
    )
    diagonal = BlockMatrix(repeated, width, components, across * width, across * components)
    product = _matrix(blocks, width, n_blocks, across).multiply(diagonal)
    rows = product.blocks.map(
        lambda cell: Row(
            block=cell[0][0] * across + cell[0][1], whitened=cell[1].toArray().ravel(order="F").tolist()
        )
    )
    return spark.createDataFrame(rows, "block long, whitened array<double>")


def _identity_error(projected: DataFrame, components: list[int], width: int, n: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened ``components`` minus the identity."""
    if not components:
        return None

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(components) + 1
        total = np.zeros((size, size))
        for batch in batches:
            for values in batch.column(0):
                rows = values.values.to_numpy().reshape(width, -1)[components]
                rows = np.vstack([rows, np.ones(rows.shape[1])])
                total += rows @ rows.T
        cells = [pa.array(np.arange(size * size)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(cells, ["cell", "total"])

    parts = projected.select("whitened").mapInArrow(moments, "cell long, total double")
    sums = parts.groupBy("cell").agg(F.sum("total").alias("total")).orderBy("cell").collect()
    size = len(components) + 1
    total = np.array([row.total for row in sums]).reshape(size, size) / n
    covariance = total[:-1, :-1] - np.outer(total[-1, :-1], total[-1, :-1])
    return float(np.abs(covariance - np.eye(size - 1)).max())


def whiten(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """A row for each vector that remains and each of the first components; columns as in ``RESULT``."""
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_column, vector_column)
    width = _commonest_length(whole)
    if width is None:
        return spark.createDataFrame([], RESULT)
    numbered, n = _numbered(whole.where(F.size("x") == width))
    sums = _exact_sums(numbered.select("x"))
    blocks = materialize(_centred_blocks(numbered, n, sums), "centred-blocks")
    n_blocks = -(-n // BLOCK_ROWS)

    covariance = _scatter(blocks, width, n_blocks) / n
    eigenvalues, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    eigenvalues, directions = eigenvalues[::-1][:components], directions[:, ::-1][:, :components]
    trace = float(np.trace(covariance))
    least = width * np.finfo(float).eps * max(float(eigenvalues[0]), 0.0)
    varying = eigenvalues > least
    whitener = np.where(varying, directions / np.sqrt(np.where(varying, eigenvalues, 1.0)), 0.0)

    projected = materialize(_projected(blocks, width, n_blocks, whitener), "whitened-blocks")
    kept = np.flatnonzero(varying).tolist()
    error = _identity_error(projected, kept, len(eigenvalues), n)

    explained = [float(e) / trace if trace > 0 else None for e in eigenvalues]
    joined = blocks.select("block", "ids", "deviations").join(projected, "block")
    cells = joined.select("ids", "deviations", F.posexplode("whitened").alias("cell", "value"))
    row = (F.col("cell") % F.size("ids")).cast("int")
    component = F.floor(F.col("cell") / F.size("ids")).cast("int")
    shares = F.array(*(F.lit(share).cast("double") for share in explained))
    varies = F.array(*(F.lit(bool(v)) for v in varying))
    return cells.select(
        F.get("ids", row).alias("vec_id"),
        (component + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        F.get("deviations", row).alias("deviation"),
        F.when(F.get(varies, component), F.col("value")).alias("whitened"),
        F.get(shares, component).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
