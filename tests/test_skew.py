"""A key holding a third of all rows: results stay whole and exact, and the
shuffle join is split by AQE rather than run in one task."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkdeck.operators import linalg, ratings, words

N = 30000


@pytest.fixture
def skew_conf(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_ratings(spark):
    # user 7 holds a third of the rows
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000 + 100).alias("user_id"),
        (F.col("id") % 50).alias("item_id"), (F.col("id") % 5 + 1).cast("int").alias("rating"))


def test_join_with_hot_user_is_split_and_whole(spark, skew_conf):
    r = _hot_ratings(spark)
    users = spark.range(2000).select(F.col("id").alias("user_id"), (F.col("id") % 4).cast("string").alias("g"))
    j = ratings.join_ratings_users(r, users, ["g"])
    rows = j.collect()
    assert len(rows) == N
    assert Counter(row.user_id for row in rows)[7] == N // 3
    assert "skew=true" in j._jdf.queryExecution().executedPlan().toString()


def test_matvec_with_hot_column(spark, skew_conf):
    m = spark.range(N).select((F.col("id") % 97).alias("row"),
                              F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500).alias("col"),
                              F.lit(1.0).alias("value"))
    v = spark.range(500).select(F.col("id").alias("col"), F.lit(2.0).alias("value"))
    out = linalg.matvec(m, v)
    rows = out.collect()
    assert len(rows) == 97 and sum(r.value for r in rows) == 2.0 * N
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_hot_word_counts(lines):
    text = lines(["hot " * 200 + "cold"] * 50 + ["warm"] * 10)
    got = {r.word: r["count"] for r in words.word_count(text).collect()}
    assert got == {"hot": 10000, "cold": 50, "warm": 10}
