"""Registered rating and linear-algebra queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdeck.operators import linalg, ratings
from sparkdeck.plans import bindings as B
from sparkdeck.plans import sqlparts as S
from sparkdeck.plans.registry import query
from sparkdeck.sources.delimited import parse_delimited, parse_items

RATING_TEXT_FIELDS = [("user_id", "bigint"), ("item_id", "bigint"), ("rating", "int")]


def _r1(spark, d):
    return B.rating_pairs(spark, d).select("user_id", "item_id", "rating")


def _items(spark, d):
    return parse_items(B.item_lines(spark, d), B.CATEGORY_NAMES)


@query("avg_rating_by_group", f"""
WITH r AS ({S.RATINGS}), u AS ({S.USERS})
SELECT u.segment, AVG(r.rating) AS avg_rating, COUNT(r.rating) AS n_ratings
FROM r JOIN u ON r.user_id = u.user_id GROUP BY u.segment""")
def q_avg_rating_by_group(spark, d):
    return ratings.avg_rating_by_group(_r1(spark, d), B.users(spark, d), "segment")


@query("item_rating_stats", f"""
WITH r AS ({S.RATINGS})
SELECT item_id, AVG(rating) AS avg_rating, COUNT(*) AS n_ratings,
       printf('%.1f,%d', ROUND(AVG(rating), 1), COUNT(*)) AS stats
FROM r GROUP BY item_id""")
def q_item_rating_stats(spark, d):
    r = parse_delimited(B.rating_lines_csv(spark, d), ",", RATING_TEXT_FIELDS, arity=3, exact=True, on_bad="fail")
    return ratings.item_rating_stats(r)


@query("item_stats_min_count", f"""
WITH r AS ({S.EVENT_RATINGS})
SELECT item_id, ROUND(AVG(rating), 6) AS avg_rating, COUNT(*) AS n_ratings
FROM r GROUP BY item_id HAVING COUNT(*) >= 50""")
def q_item_stats_min_count(spark, d):
    s = ratings.item_stats(B.event_ratings(spark, d), min_count=50)
    return s.select("item_id", F.round("avg_rating", 6).alias("avg_rating"), "n_ratings")


@query("topk_rated_items", f"""
WITH s AS (SELECT item_id, ROUND(AVG(rating), 6) AS avg_rating, COUNT(*) AS n_ratings
           FROM ({S.EVENT_RATINGS}) r GROUP BY item_id HAVING COUNT(*) >= 50),
top AS (SELECT *, ROW_NUMBER() OVER (ORDER BY avg_rating DESC, item_id) AS rk FROM s QUALIFY rk <= 10),
t AS (SELECT item_id, MAX(title) AS title FROM ({S.EVENT_TITLES}) e GROUP BY item_id)
SELECT CAST(top.rk AS INTEGER) AS rank, top.item_id,
       COALESCE(t.title, 'MovieID_' || CAST(top.item_id AS VARCHAR)) AS title,
       top.avg_rating, top.n_ratings
FROM top LEFT JOIN t ON top.item_id = t.item_id""")
def q_topk_rated_items(spark, d):
    return ratings.topk_rated_items(B.event_ratings(spark, d), B.event_titles(spark, d),
                                    k=10, min_count=50, avg_digits=6)


@query("avg_rating_by_title", f"""
WITH r AS ({S.RATINGS})
SELECT r.item_id, p.p_name AS title, AVG(r.rating) AS avg_rating
FROM r JOIN part p ON r.item_id = p.p_partkey
WHERE p.p_name IS NOT NULL AND p.p_name <> ''
GROUP BY r.item_id, p.p_name""")
def q_avg_rating_by_title(spark, d):
    return ratings.avg_rating_by_title(_r1(spark, d), B.item_titles(spark, d))


@query("join_ratings_users", f"""
WITH r AS ({S.RATINGS}), u AS ({S.USERS})
SELECT r.user_id, r.item_id, r.rating, u.segment, u.nation
FROM r JOIN u ON r.user_id = u.user_id""")
def q_join_ratings_users(spark, d):
    return ratings.join_ratings_users(_r1(spark, d), B.users(spark, d), ["segment", "nation"])


@query("multi_hot_to_array", f"""
SELECT item_id, title, array_to_string(categories, ',') AS categories, CAST(len(categories) AS INTEGER) AS n_categories
FROM ({S.ITEM_CATEGORIES}) i""")
def q_multi_hot_to_array(spark, d):
    i = _items(spark, d)
    return i.select("item_id", "title", F.array_join("categories", ",").alias("categories"),
                    F.size("categories").alias("n_categories"))


_CATEGORY_COUNTS_SQL = f"""
WITH r AS ({S.RATINGS}), u AS ({S.USERS}),
c AS (SELECT item_id, unnest(categories) AS category FROM ({S.ITEM_CATEGORIES}) i)
SELECT u.segment, c.category, COUNT(*) AS n_ratings
FROM r JOIN u ON r.user_id = u.user_id JOIN c ON r.item_id = c.item_id
GROUP BY u.segment, c.category"""


@query("category_counts", _CATEGORY_COUNTS_SQL)
def q_category_counts(spark, d):
    return ratings.category_counts(_r1(spark, d), B.users(spark, d), _items(spark, d), "segment")


@query("preferred_category", f"""
WITH cc AS ({_CATEGORY_COUNTS_SQL})
SELECT segment, category, n_ratings FROM cc
QUALIFY ROW_NUMBER() OVER (PARTITION BY segment ORDER BY n_ratings DESC, category) = 1""")
def q_preferred_category(spark, d):
    return ratings.preferred_category(_r1(spark, d), B.users(spark, d), _items(spark, d), "segment")


@query("matvec", f"""
WITH m AS ({S.MATRIX}), v AS ({S.VECTOR})
SELECT m."row", SUM(m.value * COALESCE(v.value, 0.0)) AS value
FROM m LEFT JOIN v ON m.col = v.col GROUP BY m."row\"""")
def q_matvec(spark, d):
    return linalg.matvec(B.matrix_entries(spark, d), B.vector_entries(spark, d))
