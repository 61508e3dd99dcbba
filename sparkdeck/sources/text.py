"""Line sources (A1, A2).

Lines are read with ``spark.read.text`` (one ``value`` column, split across
tasks by file block), never through an RDD.  Several paths with one parser
are a single multi-path read; mixed records are told apart by content in one
pass (``sources.delimited.parse_by_content``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str | None = None) -> DataFrame:
    """A1/A2: lines of one or several text inputs as ``value: string``.

    ``encoding`` decodes single-byte files (e.g. Latin-1 item lists) line by
    line: the text reader keeps each line's raw bytes, which are re-read as
    binary and decoded, so files stay splittable across tasks."""
    if isinstance(paths, str):
        paths = [paths]
    df = spark.read.text(list(paths))
    if encoding and encoding.lower().replace("-", "").replace("_", "") != "utf8":
        df = df.select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))
    return df
