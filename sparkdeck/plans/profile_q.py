"""Registered profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdeck.operators import profile, relational
from sparkdeck.plans import bindings as B
from sparkdeck.plans import sqlparts as S
from sparkdeck.plans.registry import query

EXACT = 0.0  # relative error of the registered quantile queries: exact order statistics
LOAN_COLS = ["id", "segment", "status", "priority", "price", "balance", "label"]


def _counts_sql(src: str, pred: dict[str, str]) -> str:
    return "SELECT " + ", ".join(
        f"COUNT(*) FILTER (WHERE {pred.get(c, f'{c} IS NULL')}) AS {c}" for c in LOAN_COLS) + f" FROM ({src}) t"


@query("null_counts", _counts_sql(S.LOAN, {}))
def q_null_counts(spark, d):
    return profile.null_counts(B.loan_table(spark, d))


_ADULT_TRIMMED = f"""
SELECT id, trim(segment) AS segment, trim(status) AS status, trim(priority) AS priority, price, balance, label
FROM ({S.ADULT}) a"""


@query("sentinel_counts", _counts_sql(_ADULT_TRIMMED, {
    c: f"{c} IS NULL OR {c} = '?'" for c in ("segment", "status", "priority")}))
def q_sentinel_counts(spark, d):
    return profile.sentinel_counts(relational.trim_string_columns(B.adult_table(spark, d)), "?")


@query("null_nan_counts", _counts_sql(S.LOAN, {
    c: f"{c} IS NULL OR isnan({c})" for c in ("price", "balance")}))
def q_null_nan_counts(spark, d):
    return profile.null_nan_counts(B.loan_table(spark, d))


@query("before_after_counts", f"""
SELECT COUNT(*) AS n_before, COUNT(*) FILTER (WHERE price IS NOT NULL AND NOT isnan(price)) AS n_after
FROM ({S.LOAN}) t""")
def q_before_after_counts(spark, d):
    p = F.col("price")
    return profile.before_after_counts(B.loan_table(spark, d), p.isNotNull() & ~F.isnan(p))


_SUMMARY_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("numeric_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, "
    f"ROUND(STDDEV_SAMP({c}), 6) AS stddev, MIN({c}) AS min, MAX({c}) AS max FROM lineitem"
    for c in _SUMMARY_COLS))
def q_numeric_summary(spark, d):
    s = profile.numeric_summary(B.table(spark, d, "lineitem"), _SUMMARY_COLS)
    return s.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


_Q_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
_PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]


@query("quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, unnest({_PROBS}::DOUBLE[]) AS prob, "
    f"unnest(quantile_disc({c}, {_PROBS}::DOUBLE[])) AS value FROM lineitem" for c in _Q_COLS))
def q_quantiles(spark, d):
    return profile.quantiles(B.table(spark, d, "lineitem"), _Q_COLS, _PROBS, relative_error=EXACT)


@query("confusion_matrix", f"""
SELECT label, COUNT(*) FILTER (WHERE prediction = 0) AS pred_0, COUNT(*) FILTER (WHERE prediction = 1) AS pred_1,
       COUNT(*) FILTER (WHERE prediction IS NULL OR prediction NOT IN (0, 1)) AS pred_other
FROM ({S.SCORED_LABELS}) s GROUP BY label""")
def q_confusion_matrix(spark, d):
    return profile.confusion_matrix(B.scored_labels(spark, d), "label", "prediction", [0, 1])


@query("boxplot_stats", """
WITH s AS (SELECT event_type, COUNT(value) AS n, MIN(value) AS min,
                  quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.5) AS median,
                  quantile_disc(value, 0.75) AS q3, MAX(value) AS max
           FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY event_type),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM s)
SELECT f.event_type, f.n, f.min, f.q1, f.median, f.q3, f.max,
       ROUND(f.lower_fence, 6) AS lower_fence, ROUND(f.upper_fence, 6) AS upper_fence,
       (SELECT COUNT(*) FROM events e WHERE e.event_type = f.event_type
          AND (e.value < f.lower_fence OR e.value > f.upper_fence)) AS n_outliers
FROM f""")
def q_boxplot_stats(spark, d):
    e = B.table(spark, d, "events")
    s = profile.boxplot_stats(e, "value", "event_type", relative_error=EXACT)
    return s.withColumns({"lower_fence": F.round("lower_fence", 6), "upper_fence": F.round("upper_fence", 6)})
