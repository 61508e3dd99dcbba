"""Relational operators over lines and tables.

Set operations are DISTINCT over the Java-trimmed line, as the jobs key on the
trimmed text.  Spark plans ``distinct`` and ``intersect``/``subtract`` as a
partial HashAggregate before the shuffle plus a semi/anti join, so duplicate
and hot lines are combined map-side before any exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from sparkdeck.functions.javatext import is_blank, jtrim
from sparkdeck.sources.delimited import parse_delimited

# Layout of a transaction line, user,item,amount,date.
TXN_FIELDS = [("user", "string"), ("item", "string"), ("amount", "double"), ("date", "string")]


def drop_blank_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Drop lines that are empty after a Java trim; lines unchanged."""
    return lines.filter(~is_blank(value_col))


def filter_amount(lines: DataFrame, threshold: float = 1000.0, on_bad: str = "fail",
                  value_col: str = "value") -> DataFrame:
    """Keep transaction lines with ``amount > threshold``; the emitted
    line is the original, untrimmed one.  Map-only: no shuffle.

    NaN is not greater than anything (Java), whereas Spark orders NaN above
    every number, hence the explicit ``isnan`` test."""
    parsed = parse_delimited(lines, ",", TXN_FIELDS, arity=4, exact=True, on_bad=on_bad,
                             value_col=value_col, keep_line=True)
    amt = F.col("amount")
    return parsed.filter((amt > F.lit(threshold)) & ~F.isnan(amt)).select(F.col("line").alias("value"))


def project_distinct(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(user, amount) pairs without duplicates, with the job's
    output line ``user,amount``; the amount stays text, so ``1500`` and
    ``1500.0`` are different values, as in the job."""
    parsed = parse_delimited(lines, ",", [("user", "string"), ("item", "string"), ("amount", "string")],
                             arity=4, exact=True, value_col=value_col)
    pairs = parsed.select("user", "amount").distinct()
    return pairs.select("user", "amount", F.concat_ws(",", "user", "amount").alias("value"))


def trimmed_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Non-blank lines, Java-trimmed: the key of the set jobs."""
    return lines.filter(~is_blank(value_col)).select(jtrim(value_col).alias("value"))


def union_lines(a: DataFrame, b: DataFrame, value_col: str = "value") -> DataFrame:
    """G1: UNION DISTINCT of trimmed lines."""
    return trimmed_lines(a, value_col).union(trimmed_lines(b, value_col)).distinct()


def _distinct_sides(a: DataFrame, b: DataFrame, value_col: str) -> tuple[DataFrame, DataFrame]:
    # Both sides reduced to one row per line first (partial aggregation in
    # each task), so a line repeated a billion times is one row in the join,
    # and both come out hash-partitioned on the line: the semi/anti join
    # that follows adds no exchange.
    return trimmed_lines(a, value_col).distinct(), trimmed_lines(b, value_col).distinct()


def intersect_lines(a: DataFrame, b: DataFrame, value_col: str = "value") -> DataFrame:
    """INTERSECT DISTINCT of trimmed lines (distinct sides, semi join)."""
    da, db = _distinct_sides(a, b, value_col)
    return da.join(db, "value", "left_semi")


def difference_lines(a: DataFrame, b: DataFrame, value_col: str = "value") -> DataFrame:
    """EXCEPT DISTINCT (a minus b) of trimmed lines (distinct sides,
    anti join); never ``exceptAll``."""
    da, db = _distinct_sides(a, b, value_col)
    return da.join(db, "value", "left_anti")


def cast_all(df: DataFrame, dtype: str = "float", safe: bool = False) -> DataFrame:
    """Every column cast to ``dtype`` under its own name, one projection.
    ``safe=True`` turns unparsable text into NULL instead of failing (ANSI)."""
    conv = (lambda c, t: c.try_cast(t)) if safe else (lambda c, t: c.cast(t))
    return df.select([conv(F.col(f"`{c}`"), dtype).alias(c) for c in df.columns])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns (missing names are ignored, as ``drop`` does)."""
    return df.drop(*cols)


def feature_columns(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> list[str]:
    """Every column but the label (and ``exclude``), in table order."""
    skip = {label, *exclude}
    return [c for c in df.columns if c not in skip]


def columns_by_type(df: DataFrame, kind: str) -> list[str]:
    """Names of ``kind`` = 'string' | 'numeric' | 'non_string' columns."""
    fields = df.schema.fields
    if kind == "string":
        return [f.name for f in fields if isinstance(f.dataType, StringType)]
    if kind == "numeric":
        return [f.name for f in fields if isinstance(f.dataType, NumericType)]
    if kind == "non_string":
        return [f.name for f in fields if not isinstance(f.dataType, StringType)]
    raise ValueError(kind)


def select_by_type(df: DataFrame, kind: str) -> DataFrame:
    """Only the columns of one kind."""
    return df.select(*[F.col(f"`{c}`") for c in columns_by_type(df, kind)])


def trim_string_columns(df: DataFrame) -> DataFrame:
    """Trim blanks around every string column, one projection."""
    strings = set(columns_by_type(df, "string"))
    return df.select([F.trim(F.col(f"`{c}`")).alias(c) if c in strings else F.col(f"`{c}`")
                      for c in df.columns])


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """first ``n`` rows under a total order (TakeOrderedAndProject: each
    task keeps its own top n, only n rows per task reach the final merge)."""
    return df.orderBy(*order_by).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """The schema as data, one row per column: (ordinal, column_name,
    data_type, non_null).  The non-null counts come from one aggregate pass
    (partial counts per task), unpivoted in the same projection."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"_c{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col(f"_c{i}").alias("non_null"))
                     for i, f in enumerate(fields)])
    return counts.select(F.inline(rows))
