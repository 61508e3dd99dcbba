"""Registered relational queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdeck.operators import joins, relational
from sparkdeck.plans import bindings as B
from sparkdeck.plans import sqlparts as S
from sparkdeck.plans.registry import query

_TRIMMED_A = f"SELECT {S.jtrim('value')} AS value FROM ({S.SET_A}) a WHERE length({S.jtrim('value')}) > 0"
_TRIMMED_B = f"SELECT {S.jtrim('value')} AS value FROM ({S.SET_B}) b WHERE length({S.jtrim('value')}) > 0"


@query("filter_amount", f"""
SELECT value FROM ({S.TXN_PARSED}) p
WHERE CAST(amount_text AS DOUBLE) > 1000 AND NOT isnan(CAST(amount_text AS DOUBLE))""")
def q_filter_amount(spark, d):
    return relational.filter_amount(B.transaction_lines(spark, d), threshold=1000.0)


@query("project_distinct", f"""
SELECT "user", amount, concat_ws(',', "user", amount) AS value
FROM (SELECT DISTINCT "user", amount_text AS amount FROM ({S.TXN_PARSED}) p) d""")
def q_project_distinct(spark, d):
    return relational.project_distinct(B.transaction_lines(spark, d))


@query("union_lines", f"{_TRIMMED_A} UNION {_TRIMMED_B}")
def q_union_lines(spark, d):
    a, b = B.set_lines(spark, d)
    return relational.union_lines(a, b)


@query("intersect_lines", f"{_TRIMMED_A} INTERSECT {_TRIMMED_B}")
def q_intersect_lines(spark, d):
    a, b = B.set_lines(spark, d)
    return relational.intersect_lines(a, b)


@query("difference_lines", f"{_TRIMMED_A} EXCEPT {_TRIMMED_B}")
def q_difference_lines(spark, d):
    a, b = B.set_lines(spark, d)
    return relational.difference_lines(a, b)


_NUM_TEXT_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("cast_all_numeric", "SELECT " + ", ".join(
    f"CAST(CAST({c} AS VARCHAR) AS FLOAT) AS {c}" for c in _NUM_TEXT_COLS) + " FROM lineitem")
def q_cast_all_numeric(spark, d):
    li = B.table(spark, d, "lineitem")
    as_text = li.select([F.col(c).cast("string").alias(c) for c in _NUM_TEXT_COLS])
    return relational.cast_all(as_text, "float")


@query("drop_columns", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem""")
def q_drop_columns(spark, d):
    li = B.table(spark, d, "lineitem")
    return relational.drop_columns(li, ["l_returnflag", "l_linestatus", "l_shipdate"])


@query("select_by_type", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem""")
def q_select_by_type(spark, d):
    return relational.select_by_type(B.table(spark, d, "lineitem"), "numeric")


@query("trim_string_columns", f"""
SELECT id, trim(segment) AS segment, trim(status) AS status, trim(priority) AS priority,
       price, balance, label FROM ({S.ADULT}) a""")
def q_trim_string_columns(spark, d):
    return relational.trim_string_columns(B.adult_table(spark, d))


@query("dedupe_build_side", """
SELECT l_orderkey, l_partkey FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC) = 1""")
def q_dedupe_build_side(spark, d):
    li = B.table(spark, d, "lineitem")
    return joins.dedupe_build_side(li, "l_orderkey", "l_partkey", order_col="l_linenumber")


@query("first_rows", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20""")
def q_first_rows(spark, d):
    o = B.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return relational.first_rows(o, ["o_orderkey"], 20)
