"""Registered text-layer and word queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdeck.operators import relational, words
from sparkdeck.plans import bindings as B
from sparkdeck.plans import sqlparts as S
from sparkdeck.plans.registry import query
from sparkdeck.session import shared_dir
from sparkdeck.sources.delimited import (
    RATING_USER_LAYOUTS,
    parse_by_content,
    parse_delimited,
    parse_pipe_users,
    parse_tab_ratings,
)
from sparkdeck.sources.sinks import write_text_values
from sparkdeck.sources.text import read_lines

NON_BLANK = f"length({S.jtrim('value')}) > 0"


@query("text_line_scan", S.TXN_LINES)
def q_text_line_scan(spark, d):
    path = shared_dir(spark, "lines")
    write_text_values(B.transaction_lines(spark, d), path)
    return read_lines(spark, path)


@query("multi_path_scan", f"{S.SET_A} UNION ALL {S.SET_B}")
def q_multi_path_scan(spark, d):
    a, b = B.set_lines(spark, d)
    pa, pb = shared_dir(spark, "set-a"), shared_dir(spark, "set-b")
    write_text_values(a, pa)
    write_text_values(b, pb)
    return read_lines(spark, [pa, pb])


@query("drop_blank_lines", f"SELECT value FROM ({S.TXN_LINES}) t WHERE {NON_BLANK}")
def q_drop_blank_lines(spark, d):
    return relational.drop_blank_lines(B.transaction_lines(spark, d))


@query("parse_delimited", f"""
SELECT "user", item, CAST(amount_text AS DOUBLE) AS amount, date FROM ({S.TXN_PARSED}) p""")
def q_parse_delimited(spark, d):
    return parse_delimited(B.transaction_lines(spark, d), ",", relational.TXN_FIELDS, arity=4,
                           exact=True, on_bad="fail")


_TAB_RATINGS_SQL = f"""
SELECT user_id, item_id, CAST(rating + CASE WHEN l_linenumber % 2 = 0 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS rating FROM ({S.RATINGS}) r
WHERE NOT (l_orderkey % 17 = 0 AND l_linenumber = 1)"""


@query("parse_tab_ratings", _TAB_RATINGS_SQL)
def q_parse_tab_ratings(spark, d):
    return parse_tab_ratings(B.rating_lines_tab(spark, d), on_bad="skip")


_USERS_PARSED_SQL = """
SELECT c.c_custkey AS user_id, c.c_nationkey AS age, c.c_mktsegment AS gender,
       n.n_name AS occupation, right(c.c_name, 5) AS zip
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_custkey % 23 <> 0"""


@query("parse_pipe_users", _USERS_PARSED_SQL)
def q_parse_pipe_users(spark, d):
    return parse_pipe_users(B.user_lines(spark, d), on_bad="skip")


@query("dispatch_mixed_records", f"""
SELECT 'R' AS kind, user_id, item_id, rating, CAST(NULL AS VARCHAR) AS gender FROM ({_TAB_RATINGS_SQL}) r
UNION ALL
SELECT 'U' AS kind, user_id, CAST(NULL AS BIGINT) AS item_id, CAST(NULL AS DOUBLE) AS rating, gender
FROM ({_USERS_PARSED_SQL}) u""")
def q_dispatch_mixed_records(spark, d):
    mixed = B.rating_lines_tab(spark, d).unionByName(B.user_lines(spark, d))
    tagged = parse_by_content(mixed, RATING_USER_LAYOUTS)
    return tagged.select("kind", "user_id", "item_id", "rating", "gender")


# ------------------------------------------------------------------ words --

_WS = r"[ \t\n\x0B\f\r]"
_LINES_SQL = r"""
SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                   ELSE string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') END) AS value
FROM documents"""
_TOKENS_SQL = f"""
SELECT unnest(CASE WHEN value = '' THEN ['']
                   WHEN regexp_replace(value, '{_WS}+$', '') = '' THEN []::VARCHAR[]
                   ELSE string_split_regex(regexp_replace(value, '{_WS}+$', ''), '{_WS}+') END) AS word
FROM ({_LINES_SQL}) l"""


def _doc_lines(spark, d):
    return words.lines_of_texts(B.document_texts(spark, d))


@query("token_lengths", f"SELECT word, CAST(length(word) AS INTEGER) AS length FROM ({_TOKENS_SQL}) t")
def q_token_lengths(spark, d):
    return words.token_lengths(_doc_lines(spark, d))


@query("token_length_sum", f"""
SELECT word, CAST(SUM(length(word)) AS BIGINT) AS total_length FROM ({_TOKENS_SQL}) t GROUP BY word""")
def q_token_length_sum(spark, d):
    return words.token_length_sum(_doc_lines(spark, d))


@query("word_count", f"""
SELECT word, COUNT(*) AS count FROM ({_TOKENS_SQL}) t WHERE word <> '' GROUP BY word""")
def q_word_count(spark, d):
    return words.word_count(_doc_lines(spark, d))
