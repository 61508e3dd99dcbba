"""Word statistics over lines or whole texts.

Tokenising is ``explode`` of a native split (no Python), so the map side
stays in codegen.  Counting uses ``groupBy().agg``: Spark aggregates
partially in each task before the shuffle, so a word that makes up a third
of all tokens is combined locally and only one partial row per task crosses
the network for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdeck.functions.javatext import java_tokens, text_lines


def lines_of_texts(texts: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Whole texts -> one row per line (``value``), as a line reader would
    see each text as a file.  Every line of every text is kept."""
    return texts.select(*keep, F.explode(text_lines(text_col)).alias("value"))


def tokens(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row per whitespace token (``word``), JVM split rules kept."""
    return lines.select(F.explode(java_tokens(value_col)).alias("word"))


def token_lengths(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """X1 as coded: (word, length) per token occurrence, map-only.
    The empty token of an empty line is kept (length 0)."""
    return tokens(lines, value_col).select("word", F.length("word").alias("length"))


def token_length_sum(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """X1 with the declared sum reducer: total length per distinct token."""
    return (token_lengths(lines, value_col).groupBy("word")
            .agg(F.sum("length").cast("bigint").alias("total_length")))


def word_count(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """E2 (the job's title): occurrences per word; the empty token is not a word."""
    return (tokens(lines, value_col).filter(F.col("word") != "")
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))
