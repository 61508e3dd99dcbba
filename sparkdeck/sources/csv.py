"""CSV sources.

Three reading styles of the scripts: header + all strings, header + inferred
types, no header + inferred types + names assigned by position.  Inference
costs an extra pass over the input, so production callers should pass an
explicit ``schema`` (accepted by all three).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv_strings(spark: SparkSession, path: str, schema: StructType | str | None = None,
                     sep: str = ",") -> DataFrame:
    """Header row, every column a string (unless ``schema`` says otherwise)."""
    r = spark.read.option("header", True).option("sep", sep)
    return (r.schema(schema) if schema is not None else r).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, schema: StructType | str | None = None,
                      sep: str = ",") -> DataFrame:
    """Header row, column types inferred (one extra pass) or given."""
    r = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def read_csv_named(spark: SparkSession, path: str, names: Sequence[str],
                   schema: StructType | str | None = None, sep: str = ",") -> DataFrame:
    """No header; types inferred; names assigned by position."""
    r = spark.read.option("header", False).option("sep", sep)
    df = r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)
    if len(df.columns) != len(names):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)
