"""Registered source/sink round trips.

Each query writes through a sink into a fresh folder under the shared
checkpoint directory and returns what the matching source reads back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdeck.operators import ratings, relational
from sparkdeck.plans import bindings as B
from sparkdeck.plans import sqlparts as S
from sparkdeck.plans.registry import query
from sparkdeck.session import shared_dir
from sparkdeck.sources.csv import read_csv_inferred, read_csv_named, read_csv_strings
from sparkdeck.sources.delimited import parse_delimited
from sparkdeck.sources.sinks import read_kv_text, write_csv, write_kv_text, write_text_values
from sparkdeck.sources.text import read_lines


@query("kv_text_roundtrip", f"""
WITH r AS ({S.RATINGS})
SELECT item_id, printf('%.1f,%d', ROUND(AVG(rating), 1), COUNT(*)) AS stats FROM r GROUP BY item_id""")
def q_kv_text_roundtrip(spark, d):
    from sparkdeck.plans.ratings_q import RATING_TEXT_FIELDS
    r = parse_delimited(B.rating_lines_csv(spark, d), ",", RATING_TEXT_FIELDS, arity=3, exact=True)
    path = shared_dir(spark, "kv")
    write_kv_text(ratings.item_rating_stats(r), path, "item_id", "stats")
    return read_kv_text(spark, path, "item_id bigint, stats string")


@query("text_value_sink", f"""
SELECT value FROM ({S.TXN_PARSED}) p
WHERE CAST(amount_text AS DOUBLE) > 1000 AND NOT isnan(CAST(amount_text AS DOUBLE))""")
def q_text_value_sink(spark, d):
    path = shared_dir(spark, "values")
    write_text_values(relational.filter_amount(B.transaction_lines(spark, d)), path)
    return read_lines(spark, path)


@query("csv_header_roundtrip", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""")
def q_csv_header_roundtrip(spark, d):
    path = shared_dir(spark, "csv-header")
    write_csv(B.table(spark, d, "customer"), path, header=True)
    return read_csv_strings(spark, path)


@query("csv_infer_schema", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""")
def q_csv_infer_schema(spark, d):
    o = B.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                            F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
    path = shared_dir(spark, "csv-infer")
    write_csv(o, path, header=True)
    return read_csv_inferred(spark, path)


_CUSTOMER_NAMES = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("csv_headerless_named", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def q_csv_headerless_named(spark, d):
    path = shared_dir(spark, "csv-named")
    write_csv(B.table(spark, d, "customer").select(*_CUSTOMER_NAMES), path, header=False)
    return read_csv_named(spark, path, _CUSTOMER_NAMES)


@query("schema_report", """
SELECT CAST(ordinal AS INTEGER) AS ordinal, column_name, data_type, non_null FROM (VALUES
  (1, 'o_orderkey', 'bigint', (SELECT COUNT(o_orderkey) FROM orders)),
  (2, 'o_custkey', 'bigint', (SELECT COUNT(o_custkey) FROM orders)),
  (3, 'o_orderstatus', 'string', (SELECT COUNT(o_orderstatus) FROM orders)),
  (4, 'o_totalprice', 'double', (SELECT COUNT(o_totalprice) FROM orders)),
  (5, 'o_orderdate', 'timestamp_ntz', (SELECT COUNT(o_orderdate) FROM orders)),
  (6, 'o_orderpriority', 'string', (SELECT COUNT(o_orderpriority) FROM orders))
) t(ordinal, column_name, data_type, non_null)""")
def q_schema_report(spark, d):
    return relational.schema_report(B.table(spark, d, "orders"))
