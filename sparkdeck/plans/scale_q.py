"""Registered queries of the forms for large or skewed inputs: each equals the
SQL of what it computes, as its plain form does (SURVEY §2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkdeck.operators import features, linalg, models, profile, userfuncs, words
from sparkdeck.plans import bindings as B
from sparkdeck.plans import models_q
from sparkdeck.plans import sqlparts as S
from sparkdeck.plans.registry import ORACLES, query
from sparkdeck.plans.ratings_q import _r1
from sparkdeck.plans.text_q import _TOKENS_SQL, _USERS_PARSED_SQL
from sparkdeck.session import shared_dir
from sparkdeck.sources.delimited import RATING_USER_LAYOUTS, parse_by_content
from sparkdeck.sources.sinks import read_kind, write_bucketed, write_by_kind


@query("string_index_many", f"""
WITH r AS ({S.RATINGS}),
n AS (SELECT CAST(user_id AS VARCHAR) AS u, COUNT(*) AS n FROM r GROUP BY 1),
i AS (SELECT u, CAST(ROW_NUMBER() OVER (ORDER BY n DESC, u) - 1 AS DOUBLE) AS user_id_idx FROM n)
SELECT r.user_id, r.item_id, r.rating, i.user_id_idx FROM r JOIN i ON CAST(r.user_id AS VARCHAR) = i.u""")
def q_string_index_many(spark, d):
    """J4 on ids, by the distributed ranking."""
    r = _r1(spark, d)
    return features.string_index(r, r, ["user_id"], labels_held=0)


@query("boxplot_by_customer", """
WITH s AS (SELECT o_custkey, COUNT(*) AS n, MIN(o_totalprice) AS min, quantile_disc(o_totalprice, 0.25) AS q1,
                  quantile_disc(o_totalprice, 0.5) AS median, quantile_disc(o_totalprice, 0.75) AS q3, MAX(o_totalprice) AS max
           FROM orders WHERE o_totalprice IS NOT NULL GROUP BY o_custkey),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM s)
SELECT f.o_custkey, f.n, f.min, f.q1, f.median, f.q3, f.max, ROUND(f.lower_fence, 4) AS lower_fence, ROUND(f.upper_fence, 4) AS upper_fence,
       COUNT(*) FILTER (WHERE o.o_totalprice < f.lower_fence OR o.o_totalprice > f.upper_fence) AS n_outliers
FROM f JOIN orders o ON o.o_custkey = f.o_custkey GROUP BY ALL""")
def q_boxplot_by_customer(spark, d):
    """E15, H12 with a group a customer: ranks by running totals."""
    s = profile.boxplot_stats(B.table(spark, d, "orders"), "o_totalprice", "o_custkey", groups_held=0)
    return s.withColumns({"lower_fence": F.round("lower_fence", 4), "upper_fence": F.round("upper_fence", 4)})


@query("matvec_blocks", f"""
WITH m AS ({S.MATRIX}), v AS ({S.VECTOR})
SELECT m."row", SUM(m.value * COALESCE(v.value, 0.0)) AS value
FROM m LEFT JOIN v ON m.col = v.col GROUP BY m."row\"""")
def q_matvec_blocks(spark, d):
    """D6, E8, L4 by two-dimensional blocks."""
    return linalg.matvec_blocks(B.matrix_entries(spark, d), B.vector_entries(spark, d))


@query("group_reduce_avg", f"""
SELECT item_id, ROUND(AVG(rating), 6) AS avg_rating, COUNT(*) AS n_ratings FROM ({S.RATINGS}) r GROUP BY item_id""")
def q_group_reduce_avg(spark, d):
    """An average by a user's functions."""
    return userfuncs.group_reduce(
        _r1(spark, d), "item_id", ["rating"], zero=lambda: (0.0, 0), update=lambda s, r: (s[0] + r[0], s[1] + 1),
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]), finish=lambda s: (round(s[0] / s[1], 6), s[1]), result="avg_rating double, n_ratings long")


@query("group_reduce_best", f"""
SELECT user_id, item_id AS best_item, rating FROM (
  SELECT user_id, item_id, rating, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS k FROM ({S.RATINGS}) r) t
WHERE k = 1""")
def q_group_reduce_best(spark, d):
    """A maximum with a tie rule (the smaller item) by a user's functions."""
    return userfuncs.group_reduce(
        _r1(spark, d), "user_id", ["rating", "item_id"], zero=lambda: None,
        update=lambda s, r: min(x for x in (s, (-r[0], r[1])) if x is not None), merge=min,
        finish=lambda s: (s[1], -s[0]), result="best_item long, rating int")


@query("token_lengths_generated", f"SELECT word, CAST(length(word) AS INTEGER) AS length FROM ({_TOKENS_SQL}) t")
def q_token_lengths_generated(spark, d):
    """The tokens of a line by a user's generator."""
    def split(line):
        import re

        parts = re.split("[ \t\n\x0b\f\r]+", line)
        while len(parts) > 1 and not parts[-1] or parts == [""] and line:
            parts.pop()
        return ((w, len(w)) for w in parts)

    lines = words.lines_of_texts(B.document_texts(spark, d))
    return userfuncs.generate_rows(lines, "value", split, "word string, length int")


@query("ratings_users_bucketed", f"""
WITH r AS ({S.RATINGS}), u AS ({S.USERS})
SELECT u.user_id, u.segment, ROUND(AVG(r.rating), 6) AS avg_rating, COUNT(*) AS n_ratings
FROM r JOIN u ON r.user_id = u.user_id GROUP BY u.user_id, u.segment""")
def q_ratings_users_bucketed(spark, d):
    """Ratings and users dealt by user once; joined and grouped
    without an exchange."""
    name = uuid.uuid4().hex
    r = write_bucketed(_r1(spark, d), f"ratings_{name}", shared_dir(spark, "ratings"), "user_id", 16)
    u = write_bucketed(B.users(spark, d), f"users_{name}", shared_dir(spark, "users"), "user_id", 16)
    j = r.join(u.hint("merge"), "user_id")
    return j.groupBy("user_id", "segment").agg(F.round(F.avg("rating"), 6).alias("avg_rating"), F.count(F.lit(1)).alias("n_ratings"))


@query("records_of_one_kind", f"SELECT 'U' AS kind, user_id, gender FROM ({_USERS_PARSED_SQL}) u")
def q_records_of_one_kind(spark, d):
    """A4, B1: mixed records written once, by kind; one kind read back."""
    mixed = B.rating_lines_tab(spark, d).unionByName(B.user_lines(spark, d))
    path = shared_dir(spark, "kinds")
    write_by_kind(parse_by_content(mixed, RATING_USER_LAYOUTS), path)
    return read_kind(spark, path, "U").select("kind", "user_id", "gender")


@query("score_saved_model", ORACLES["predict_linear"])
def q_score_saved_model(spark, d):
    """A model saved in the shared folder, read again and applied."""
    train, test = models_q._split(spark, d)
    path = shared_dir(spark, "model")
    models.save_model(models.fit_regressor(train, ["l_quantity"], "label", "linear"), path, ["l_quantity"])
    p = models.predict_saved(spark, path, test)
    return p.select("order_id", "line_id", F.round("prediction", 2).alias("prediction"))
