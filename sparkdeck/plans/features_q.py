"""Registered feature-preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdeck.operators import features as FE
from sparkdeck.operators import relational
from sparkdeck.plans import bindings as B
from sparkdeck.plans import sqlparts as S
from sparkdeck.plans.registry import query

EXACT = 0.0  # exact order statistics

# ------------------------------------------------------------ SQL pieces --

_ADULT_CLEAN = f"""
SELECT id,
       CASE WHEN trim(segment) = '?' THEN 'Unknown' ELSE trim(segment) END AS segment,
       CASE WHEN trim(status) = '?' THEN 'Unknown' ELSE trim(status) END AS status,
       CASE WHEN trim(priority) = '?' THEN 'Unknown' ELSE trim(priority) END AS priority,
       price, balance, label
FROM ({S.ADULT}) a"""


def _index_sql(src: str, col: str) -> str:
    """StringIndexer(frequencyDesc, keep) as SQL: (value, idx)."""
    return (f"SELECT {col}, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {col}) - 1 AS idx "
            f"FROM ({src}) s WHERE {col} IS NOT NULL GROUP BY {col}")


def _indexed_sql(src: str, col: str) -> str:
    """idx per row; NULL/unseen -> number of labels (handleInvalid='keep')."""
    return (f"CAST(COALESCE((SELECT idx FROM ({_index_sql(src, col)}) i WHERE i.{col} = t.{col}), "
            f"(SELECT COUNT(DISTINCT {col}) FROM ({src}) s)) AS DOUBLE)")


_PRIORITY_CASE = ("CASE priority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in B.PRIORITY_ORDER.items())
                  + " ELSE -1 END")


# ---------------------------------------------------------------- queries --

@query("impute_constant", f"""
SELECT id, COALESCE(segment, 'Unknown') AS segment, COALESCE(status, 'Unknown') AS status,
       COALESCE(priority, 'Unknown') AS priority FROM ({S.LOAN}) t""")
def q_impute_constant(spark, d):
    return FE.impute_constant(B.loan_table(spark, d)).select("id", "segment", "status", "priority")


@query("replace_sentinel", f"SELECT id, segment, status, priority FROM ({_ADULT_CLEAN}) t")
def q_replace_sentinel(spark, d):
    t = relational.trim_string_columns(B.adult_table(spark, d))
    return FE.replace_sentinel(t, "?", "Unknown").select("id", "segment", "status", "priority")


@query("impute_mean", f"""
SELECT id,
  ROUND(CASE WHEN price IS NULL OR isnan(price)
        THEN (SELECT AVG(price) FROM ({S.LOAN}) s WHERE price IS NOT NULL AND NOT isnan(price))
        ELSE price END, 6) AS price_imputed,
  ROUND(CASE WHEN balance IS NULL OR isnan(balance)
        THEN (SELECT AVG(balance) FROM ({S.LOAN}) s WHERE balance IS NOT NULL AND NOT isnan(balance))
        ELSE balance END, 6) AS balance_imputed
FROM ({S.LOAN}) t""")
def q_impute_mean(spark, d):
    loan = B.loan_table(spark, d)
    out = FE.impute_mean(loan, loan, ["price", "balance"])
    return out.select("id", F.round("price_imputed", 6).alias("price_imputed"),
                      F.round("balance_imputed", 6).alias("balance_imputed"))


@query("string_index", f"""
SELECT id, {_indexed_sql(S.LOAN, 'segment')} AS segment_idx, {_indexed_sql(S.LOAN, 'priority')} AS priority_idx
FROM ({S.LOAN}) t""")
def q_string_index(spark, d):
    loan = B.loan_table(spark, d)
    return FE.string_index(loan, loan, ["segment", "priority"]).select("id", "segment_idx", "priority_idx")


@query("one_hot_encode", f"""
WITH t AS (SELECT id, {_indexed_sql(S.LOAN, 'segment')} AS si, {_indexed_sql(S.LOAN, 'priority')} AS pi
           FROM ({S.LOAN}) t),
n AS (SELECT COUNT(DISTINCT segment) AS ns, COUNT(DISTINCT priority) AS np FROM ({S.LOAN}) l)
SELECT t.id,
  array_to_string(list_transform(range(n.ns), lambda i: CASE WHEN i = t.si THEN '1.0' ELSE '0.0' END), ',') AS segment_vec,
  array_to_string(list_transform(range(n.np), lambda i: CASE WHEN i = t.pi THEN '1.0' ELSE '0.0' END), ',') AS priority_vec
FROM t, n""")
def q_one_hot_encode(spark, d):
    loan = B.loan_table(spark, d)
    idx = FE.string_index(loan, loan, ["segment", "priority"])
    oh = FE.one_hot_encode(idx, idx, ["segment_idx", "priority_idx"])
    return oh.select("id", FE.vector_text("segment_idx_vec").alias("segment_vec"),
                     FE.vector_text("priority_idx_vec").alias("priority_vec"))


@query("ordinal_encode", f"SELECT id, CAST({_PRIORITY_CASE} AS INTEGER) AS priority_ord FROM ({S.LOAN}) t")
def q_ordinal_encode(spark, d):
    return FE.ordinal_encode(B.loan_table(spark, d), "priority", B.PRIORITY_ORDER).select("id", "priority_ord")


@query("ordinal_encode_udf", f"SELECT id, CAST({_PRIORITY_CASE} AS INTEGER) AS priority_ord FROM ({S.LOAN}) t")
def q_ordinal_encode_udf(spark, d):
    # A self-contained function (the map travels with it), so Python workers
    # need nothing but the standard library to run it.
    rank = lambda v, order=dict(B.PRIORITY_ORDER): order.get(v, -1)
    return FE.ordinal_encode_udf(B.loan_table(spark, d), "priority", rank).select("id", "priority_ord")


_STATUS_LABEL = (f"CAST((SELECT idx FROM ({_index_sql(S.LOAN, 'status')}) i WHERE i.status = t.status) AS DOUBLE)")


@query("label_encode", f"SELECT id, {_STATUS_LABEL} AS status_label FROM ({S.LOAN}) t WHERE status IS NOT NULL")
def q_label_encode(spark, d):
    loan = B.loan_table(spark, d)
    return FE.label_encode(loan, loan, "status", out="status_label").select("id", "status_label")


@query("combine_encoded", f"""
SELECT id, {_indexed_sql(S.LOAN, 'segment')} AS segment_idx, CAST({_PRIORITY_CASE} AS INTEGER) AS priority_ord,
       {_STATUS_LABEL} AS status_label
FROM ({S.LOAN}) t WHERE status IS NOT NULL""")
def q_combine_encoded(spark, d):
    loan = B.loan_table(spark, d)
    t = FE.string_index(loan, loan, ["segment"])
    t = FE.ordinal_encode(t, "priority", B.PRIORITY_ORDER)
    t = FE.label_encode(t, t, "status", out="status_label")
    return t.select("id", "segment_idx", "priority_ord", "status_label")


@query("assemble_features", f"""
SELECT order_id, line_id,
       concat_ws(',', CAST(l_quantity AS VARCHAR), CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR)) AS features
FROM ({S.REGRESSION}) r""")
def q_assemble_features(spark, d):
    r = B.regression_table(spark, d)
    a = FE.assemble_features(r, ["l_quantity", "l_discount", "l_tax"])
    return a.select("order_id", "line_id", FE.vector_text("features").alias("features"))


_EVENT_FENCES = """
(SELECT quantile_disc(value, 0.25) - 1.5 * (quantile_disc(value, 0.75) - quantile_disc(value, 0.25)) FROM events)"""
_EVENT_UPPER = """
(SELECT quantile_disc(value, 0.75) + 1.5 * (quantile_disc(value, 0.75) - quantile_disc(value, 0.25)) FROM events)"""


def _events(spark, d):
    return B.table(spark, d, "events").select("event_id", "value")


@query("iqr_filter", f"SELECT event_id, value FROM events WHERE value >= {_EVENT_FENCES} AND value <= {_EVENT_UPPER}")
def q_iqr_filter(spark, d):
    return FE.iqr_filter(_events(spark, d), "value", relative_error=EXACT)


@query("iqr_outliers", f"SELECT event_id, value FROM events WHERE value < {_EVENT_FENCES} OR value > {_EVENT_UPPER}")
def q_iqr_outliers(spark, d):
    return FE.iqr_outliers(_events(spark, d), "value", relative_error=EXACT)


@query("drop_outlier_ids", f"""
SELECT event_id, value FROM events WHERE event_id NOT IN (
  SELECT event_id FROM events WHERE value < {_EVENT_FENCES} OR value > {_EVENT_UPPER})""")
def q_drop_outlier_ids(spark, d):
    e = _events(spark, d)
    return FE.drop_outlier_ids(e, FE.iqr_outliers(e, "value", relative_error=EXACT), "event_id")


@query("combine_features", f"""
SELECT id, price, balance, {_indexed_sql(_ADULT_CLEAN, 'segment')} AS segment_idx,
       CAST({_PRIORITY_CASE} AS INTEGER) AS priority_ord
FROM ({_ADULT_CLEAN}) t""")
def q_combine_features(spark, d):
    a = FE.replace_sentinel(relational.trim_string_columns(B.adult_table(spark, d)))
    numeric = a.select("id", "price", "balance")
    cat = FE.ordinal_encode(FE.string_index(a, a, ["segment"]), "priority", B.PRIORITY_ORDER)
    return FE.combine_features(numeric, cat.select("id", "segment_idx", "priority_ord"), "id")


@query("numeric_transforms", """
SELECT c_custkey, c_acctbal,
  ROUND(CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END, 6) AS c_acctbal_log,
  ROUND(CASE WHEN c_acctbal <> 0 THEN 1.0 / c_acctbal END, 6) AS c_acctbal_recip,
  ROUND(CASE WHEN c_acctbal < 0 THEN CAST('NaN' AS DOUBLE) ELSE sqrt(c_acctbal) END, 6) AS c_acctbal_sqrt,
  ROUND(CASE WHEN c_acctbal < 0 THEN CAST('NaN' AS DOUBLE) ELSE pow(c_acctbal, 1.0 / 3.0) END, 6) AS c_acctbal_cbrt_pow,
  ROUND(cbrt(c_acctbal), 6) AS c_acctbal_cbrt
FROM customer""")
def q_numeric_transforms(spark, d):
    c = B.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    t = FE.numeric_transforms(c, "c_acctbal")
    return t.select("c_custkey", "c_acctbal", *[F.round(x, 6).alias(x) for x in t.columns[2:]])


def _adult_numeric(spark, d):
    return B.adult_table(spark, d).select("id", "price", "balance")


@query("minmax_scale", f"""
SELECT id,
  ROUND(CASE WHEN MAX(price) OVER () = MIN(price) OVER () THEN 0.5
        ELSE (price - MIN(price) OVER ()) / (MAX(price) OVER () - MIN(price) OVER ()) END, 6) AS price_scaled,
  ROUND(CASE WHEN MAX(balance) OVER () = MIN(balance) OVER () THEN 0.5
        ELSE (balance - MIN(balance) OVER ()) / (MAX(balance) OVER () - MIN(balance) OVER ()) END, 6) AS balance_scaled
FROM ({S.ADULT}) t""")
def q_minmax_scale(spark, d):
    a = _adult_numeric(spark, d)
    s = FE.minmax_scale(a, a, ["price", "balance"])
    return s.select("id", *FE.vector_columns("scaled", ["price_scaled", "balance_scaled"], 6))


@query("standard_scale", f"""
SELECT id, ROUND(price / STDDEV_SAMP(price) OVER (), 6) AS price_scaled,
       ROUND(balance / STDDEV_SAMP(balance) OVER (), 6) AS balance_scaled
FROM ({S.ADULT}) t""")
def q_standard_scale(spark, d):
    a = _adult_numeric(spark, d)
    s = FE.standard_scale(a, a, ["price", "balance"])
    return s.select("id", *FE.vector_columns("scaled", ["price_scaled", "balance_scaled"], 6))


@query("standard_scale_centered", f"""
SELECT id, ROUND((price - AVG(price) OVER ()) / STDDEV_SAMP(price) OVER (), 6) AS price_scaled,
       ROUND((balance - AVG(balance) OVER ()) / STDDEV_SAMP(balance) OVER (), 6) AS balance_scaled
FROM ({S.ADULT}) t""")
def q_standard_scale_centered(spark, d):
    a = _adult_numeric(spark, d)
    s = FE.standard_scale(a, a, ["price", "balance"], with_mean=True)
    return s.select("id", *FE.vector_columns("scaled", ["price_scaled", "balance_scaled"], 6))


@query("robust_scale", f"""
SELECT id, ROUND((price - (SELECT quantile_disc(price, 0.5) FROM ({S.ADULT}) s))
                 / (SELECT quantile_disc(price, 0.75) - quantile_disc(price, 0.25) FROM ({S.ADULT}) s), 6)
       AS price_robust
FROM ({S.ADULT}) t""")
def q_robust_scale(spark, d):
    a = _adult_numeric(spark, d)
    s = FE.robust_scale(a, a, "price", relative_error=EXACT)
    return s.select("id", F.round("price_robust", 6).alias("price_robust"))


@query("stable_split", f"""
SELECT o_orderkey, CAST({S.stable_bucket('o_orderkey', 42, 100)} AS INTEGER) AS bucket,
       {S.train_test('o_orderkey')} AS split
FROM orders""")
def q_stable_split(spark, d):
    o = B.table(spark, d, "orders").select("o_orderkey")
    return FE.stable_split(o, ["o_orderkey"], [0.7, 0.3], seed=42, names=["train", "test"])


_PREP_T = f"""
SELECT id, {_indexed_sql(_ADULT_CLEAN, 'segment')} AS s, CAST({_PRIORITY_CASE} AS DOUBLE) AS p, status, price, balance
FROM ({_ADULT_CLEAN}) t"""
_SEGMENTS = 5  # the labels of the nominal column at every scale ('Unknown' among them): 6 indexes, one vector place each
_PREP_STATUS = f"CAST((SELECT idx FROM ({_index_sql(_ADULT_CLEAN, 'status')}) i WHERE i.status = f.status) AS DOUBLE)"


def _unit(x: str) -> str:
    return (f"ROUND(CASE WHEN MAX({x}) OVER () = MIN({x}) OVER () THEN 0.5 "
            f"ELSE ({x} - MIN({x}) OVER ()) / (MAX({x}) OVER () - MIN({x}) OVER ()) END, 6)")


_PREP_FEATURES = [f"CAST(s = {i} AS DOUBLE)" for i in range(_SEGMENTS + 1)] + ["p", "price", "balance"]


@query("prepare_features", f"""
WITH t AS ({_PREP_T}),
b AS (SELECT quantile_disc(price, 0.25) AS q1, quantile_disc(price, 0.75) AS q3 FROM t),
f AS (SELECT t.* FROM t WHERE price >= (SELECT q1 - 1.5 * (q3 - q1) FROM b)
                           AND price <= (SELECT q3 + 1.5 * (q3 - q1) FROM b))
SELECT id, {_PREP_STATUS} AS label, {', '.join(f'{_unit(x)} AS f{i}' for i, x in enumerate(_PREP_FEATURES))}
FROM f""")
def q_prepare_features(spark, d):
    a = B.adult_table(spark, d).select("id", "segment", "priority", "price", "balance", "status")
    p = FE.prepare_features(a, ["segment"], {"priority": B.PRIORITY_ORDER}, ["price", "balance"], "status",
                            relative_error=EXACT, iqr_col="price")
    return p.select("id", "label", *FE.vector_columns("features", [f"f{i}" for i in range(len(_PREP_FEATURES))], 6))
