"""Sparse matrix x vector in coordinate form.

matrix (row, col, value) x vector (col, value): a left outer join on
``col`` where a missing vector entry counts as 0.0 (the row is still
emitted), then a sum of partial products per row.  Vector entries with no
matrix column are dropped.  Duplicate vector entries keep the last one
(``dedupe_build_side``).

Plan: the vector is de-duplicated by ``col`` (hash partitioned on col), so
the join only shuffles the matrix side; the per-row sum aggregates
partially before its shuffle.  A hot column (a third of all entries) is
split by AQE's skew-join handling of the outer side, or avoided entirely
when the vector is small enough for Spark to broadcast (statistics, or
AQE's measured size of the de-duplicated vector).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdeck.operators.joins import dedupe_build_side


def matvec(matrix: DataFrame, vector: DataFrame, order_col: str | None = None) -> DataFrame:
    """y = M v over coordinate frames; output (row, value)."""
    v = dedupe_build_side(vector.select("col", "value", *([order_col] if order_col else [])),
                          "col", "value", order_col)
    v = v.select("col", F.col("value").alias("_v"))
    j = matrix.select("row", "col", F.col("value").cast("double").alias("_m")).join(v, "col", "left")
    prod = F.col("_m") * F.coalesce(F.col("_v"), F.lit(0.0))
    return j.groupBy("row").agg(F.sum(prod).alias("value"))


def matvec_blocks(matrix: DataFrame, vector: DataFrame, row_blocks: int = 8, order_col: str | None = None) -> DataFrame:
    """y = M v where the vector is too large to broadcast and a column may hold
    a large share of the entries.

    The matrix is cut in two dimensions: an entry belongs to its column and to
    one of ``row_blocks`` blocks of rows, and the join is on both, so a column's
    entries meet its vector entry in ``row_blocks`` places.  The vector travels
    once to each block of rows.  Each task adds up its partial rows before they
    are combined by row."""
    v = dedupe_build_side(vector.select("col", "value", *([order_col] if order_col else [])), "col", "value", order_col)
    v = v.select("col", F.col("value").alias("_v"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("_block"))
    m = matrix.select("row", "col", F.col("value").cast("double").alias("_m"),
                      F.pmod(F.xxhash64("row"), F.lit(row_blocks)).cast("int").alias("_block"))
    prod = F.col("_m") * F.coalesce(F.col("_v"), F.lit(0.0))
    return m.join(v.hint("merge"), ["col", "_block"], "left").groupBy("row").agg(F.sum(prod).alias("value"))
