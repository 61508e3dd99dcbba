"""Places in a total order by range partition and offsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdeck.operators.ranking import row_numbers


def test_row_numbers_equal_a_sorted_list(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 503).alias("x"), F.col("id").alias("at"))
    got = {(r["x"], r["at"]): r["n"] for r in row_numbers(df, [F.desc("x"), F.asc("at")], "n").collect()}
    want = sorted(got, key=lambda k: (-k[0], k[1]))
    assert [got[k] for k in want] == list(range(1, 5001))


def test_row_numbers_with_one_hot_value_and_no_rows(spark):
    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("part"))
    rows = row_numbers(df, [F.asc("part")]).orderBy("row_number").collect()
    assert [r["row_number"] for r in rows] == list(range(1, 3001))
    assert [r["part"] for r in rows] == sorted(r["part"] for r in rows)
    assert row_numbers(df.limit(0), [F.asc("part")]).isEmpty()
