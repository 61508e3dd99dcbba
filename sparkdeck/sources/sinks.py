"""Sinks (B1-B4, B6) and their read-back.

Outputs are sets of rows: no sort or single-file coalesce is forced (that
would funnel all data through one task).  ``sort_output=True`` asks for a
range-partitioned sort, which stays parallel.  The default ``mode`` is
``errorifexists``: an existing output directory is an error, as in the jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkdeck.functions.numeric import parse_number


def _maybe_sorted(df: DataFrame, sort_output: bool, keys: Sequence[str]) -> DataFrame:
    return df.sort(*keys) if sort_output else df


def write_text_values(df: DataFrame, path: str, value_col: str = "value", mode: str = "errorifexists",
                      sort_output: bool = False) -> None:
    """B2: value-only text output (the key is absent)."""
    out = df.select(F.col(value_col).cast("string").alias("value"))
    _maybe_sorted(out, sort_output, ["value"]).write.mode(mode).text(path)


def write_kv_text(df: DataFrame, path: str, key: str, value: str | Sequence[str],
                  mode: str = "errorifexists", value_sep: str = ",", sort_output: bool = False) -> None:
    """B1: ``key<TAB>value`` lines; several value columns are joined by
    ``value_sep`` (the composite-value strings of the jobs)."""
    vals = [value] if isinstance(value, str) else list(value)
    v = F.concat_ws(value_sep, *[F.col(c).cast("string") for c in vals])
    line = F.concat_ws("\t", F.col(key).cast("string"), v).alias("value")
    _maybe_sorted(df.select(F.col(key), line), sort_output, [key]).select("value").write.mode(mode).text(path)


def read_kv_text(spark: SparkSession, path: str, schema: StructType | str, on_bad: str = "fail") -> DataFrame:
    """A10: re-read ``key<TAB>value`` text written by a prior job, typed: two
    fields, split at the first tab; an empty key stays the empty text.  A bad
    number fails the job or drops the row."""
    fields = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields
    if len(fields) != 2:
        raise ValueError("a key and a value")
    parts = F.split(F.col("value"), "\t", 2)
    lines = spark.read.text(path).select(parts.alias("p")).where(F.size("p") == 2)
    out, ok = [], F.lit(True)
    for i, f in enumerate(fields):
        kind = f.dataType.simpleString()
        out.append((F.col("p")[i] if kind == "string" else parse_number(F.col("p")[i], kind, on_bad, f.name)).alias(f.name))
        ok = ok & F.col(f.name).isNotNull()
    records = lines.select(F.inline(F.array(F.struct(*out))))
    return records.where(ok) if on_bad == "skip" else records


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              sep: str = ",") -> None:
    """CSV with header (overwrite, as the script does)."""
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def persist_for_reuse(df: DataFrame) -> DataFrame:
    """Keep a frame that several actions scan (model loops) in memory,
    spilling to disk rather than recomputing."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def write_by_kind(df: DataFrame, path: str, kind_col: str = "kind") -> None:
    """A4, B1: one pass over mixed records into a folder per kind; a kind that is
    written again replaces its own folder only."""
    df.write.partitionBy(kind_col).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_kind(spark: SparkSession, path: str, kind: str, kind_col: str = "kind") -> DataFrame:
    """The records of one kind; the folders of the others are not listed."""
    return spark.read.parquet(path).where(F.col(kind_col) == kind)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """B6 across jobs: a table dealt by ``key`` once, so that joins and groupings
    by it need no exchange of these rows again."""
    (df.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").format("parquet").option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)
