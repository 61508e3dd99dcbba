"""JVM text rules as native expressions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkdeck.functions.javatext import is_blank, java_tokens, jsplit, jtrim, literal_sep, text_lines


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,want", [
    ("  a b  ", "a b"), ("\ta,b\r", "a,b"), ("\x00x\x1f", "x"), ("", ""), (" \t ", ""), ("x ", "x "),
])
def test_jtrim_strips_control_and_blank(spark, raw, want):
    assert _one(spark, jtrim(F.col("v")), raw) == want


@pytest.mark.parametrize("raw,sep,want", [
    ("a,b,1500,", ",", ["a", "b", "1500"]),        # trailing empty dropped -> 3 fields
    ("a,,c", ",", ["a", "", "c"]),                 # inner empty kept
    (",a", ",", ["", "a"]),                        # leading empty kept
    ("a,b,,,", ",", ["a", "b"]),
    ("1|x|", "|", ["1", "x"]),
    ("", ",", [""]),
])
def test_jsplit_drops_trailing_empty_fields(spark, raw, sep, want):
    assert _one(spark, jsplit(F.col("v"), literal_sep(sep)), raw) == want


@pytest.mark.parametrize("raw,want", [
    ("Hello World", ["Hello", "World"]),
    ("", [""]),                # empty line: one empty token
    ("   \t ", []),            # blanks only: no token
    (" lead", ["", "lead"]),   # leading blank: one empty leading token
    ("a  b\t", ["a", "b"]),
    ("a\x0bb", ["a", "b"]),    # vertical tab is \s for the JVM
])
def test_java_tokens(spark, raw, want):
    assert _one(spark, java_tokens(F.col("v")), raw) == want


@pytest.mark.parametrize("raw,want", [
    ("a\nb", ["a", "b"]), ("a\nb\n", ["a", "b"]), ("a\r\nb\rc", ["a", "b", "c"]),
    ("a\n\n", ["a", ""]), ("", []), ("\n", [""]),
])
def test_text_lines(spark, raw, want):
    assert _one(spark, text_lines(F.col("v")), raw) == want


def test_is_blank(spark):
    df = spark.createDataFrame([("",), ("  ",), ("\t",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(is_blank("v")).collect()] == [True, True, True, False, True]
