"""Places of rows in a total order, without one task or the driver seeing them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkdeck.session import shared_dir


def row_numbers(df: DataFrame, order: Sequence[Column], out: str = "row_number") -> DataFrame:
    """``df`` with its rows' places 1, 2, ... in ``order`` (rows that compare
    equal in an arbitrary order).

    The rows are range-partitioned and sorted, and written to the shared folder
    with their partition and their place in it; a place in the whole order is
    the place in the partition plus the rows of the partitions before.  Only
    those counts, one row a partition, are broadcast.  Rows that compare equal
    lie in one partition: end ``order`` with a column that tells them apart if
    one value may hold a large share of the rows."""
    at, part, before = (_fresh(c, [*df.columns, out]) for c in ("at", "part", "before"))
    placed = _placed(df, order, at, part)
    in_part = F.col(at).bitwiseAND((1 << 33) - 1)
    return (placed.join(F.broadcast(_offsets(placed, F.count(F.lit(1)), part, before)), part)
            .select(*df.columns, (in_part + F.col(before) + 1).alias(out)))


def running_totals(df: DataFrame, order: Sequence[Column], weight: str, out: str = "total") -> DataFrame:
    """``df`` with the sum of ``weight`` up to and including each row in
    ``order`` (which tells all rows apart), by the plan of ``row_numbers``."""
    at, part, before = (_fresh(c, [*df.columns, out]) for c in ("at", "part", "before"))
    placed = _placed(df, order, at, part)
    own = F.sum(weight).over(Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, 0))
    return (placed.join(F.broadcast(_offsets(placed, F.sum(weight), part, before)), part)
            .select(*df.columns, (own + F.col(before)).alias(out)))


def _placed(df: DataFrame, order: Sequence[Column], at: str, part: str) -> DataFrame:
    path = shared_dir(df.sparkSession, "sorted")
    df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path).withColumn(part, F.shiftright(F.col(at), 33))


def _offsets(placed: DataFrame, total: Column, part: str, before: str) -> DataFrame:
    """What lies in the partitions before each: one row a partition."""
    n = _fresh("n", placed.columns)
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return placed.groupBy(part).agg(total.alias(n)).select(part, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))


def _fresh(name: str, taken: Sequence[str]) -> str:
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name
