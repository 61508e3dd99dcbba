"""Join helpers: build-side de-duplication.

Who decides on broadcast:

* a side whose size is bounded by construction (the k winners of a top-k
  and the titles matched to them) is hinted with ``broadcast``;
* a data-derived dimension is joined plainly: Spark broadcasts it when its
  statistics are under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
  re-decides from the *measured* shuffle size at run time; otherwise it is
  a shuffle join, where AQE splits skewed partitions of the large side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def dedupe_build_side(df: DataFrame, key: str | Sequence[str], value: str | Sequence[str],
                      order_col: str | None = None) -> DataFrame:
    """One row per key, "last one seen wins".

    The reducers keep the last value they see for a duplicated key, which
    depends on arrival order.  Here "last" is the row with the greatest
    ``order_col`` (``max_by``); without an order column the greatest value
    wins, so the result is deterministic.  One aggregate: partial
    aggregation bounds each task's state by its distinct keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    vals = [value] if isinstance(value, str) else list(value)
    if order_col is None and len(vals) == 1:
        return df.groupBy(*keys).agg(F.max(vals[0]).alias(vals[0]))
    # Lexicographic max of (order, values...): rows tied on the order column
    # resolve to the greatest value, so the choice never depends on arrival.
    order = [F.col(order_col).alias("_o")] if order_col is not None else []
    packed = F.max(F.struct(*order, *[F.col(v) for v in vals])).alias("_last")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in vals])
