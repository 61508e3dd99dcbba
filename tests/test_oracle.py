"""Every registered query against its DuckDB oracle at sf0.001, plus the
rows-only keys and the entry point."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from sparkdeck.operators import evaluate, models, tuning
from sparkdeck.plans import models_q, treesql
from sparkdeck.plans.bindings import TABLES
from tests.conftest import SF0001

ORACLES = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _bag(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


# At this scale deep trees have nodes of a few rows, which several features part
# in the same way; MLlib takes one of such equal splits by the rounding of its
# sums.  test_grid_matches_oracle compares what does not depend on it.
EQUAL_SPLITS = {"grid_search_cv"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - EQUAL_SPLITS))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _bag(rows, df.columns) == _bag(drows, dcols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF0001).count() > 0


def test_every_query_has_stable_schema(spark):
    for name in ("preferred_category", "word_count", "matvec"):
        a = QUERIES[name](spark, SF0001).schema
        b = QUERIES[name](spark, SF0001).schema
        assert a == b


def test_entry_flagship(spark):
    got = sorted(tuple(r) for r in entry_mod.entry(spark).collect())
    assert got == [("AUTOMOBILE", "gear", 160), ("BUILDING", "cold", 217), ("FURNITURE", "cold", 276),
                   ("HOUSEHOLD", "anvil", 153), ("MACHINERY", "gear", 213)]


@pytest.mark.parametrize("name", ["fit_decision_tree", "fit_random_forest", "fit_gbt"])
def test_tree_fits_are_deterministic(spark, name):
    # The generated lineitem carries no signal from quantity/discount/tax to
    # the price (|corr| < 0.02 at every scale); "better than the mean" is
    # tested on the class of marks (test_model_compare_and_grid).
    kind = name.removeprefix("fit_")
    train, test = models_q._split(spark, SF0001)
    cols = models_q._features(spark, SF0001)
    figures = []
    for _ in range(2):
        m = models.fit_regressor(train, cols, "label", kind, seed=42)
        figures.append(tuple(evaluate.regression_metrics(models.predict(m, test)).first()))
    assert figures[0] == figures[1] and all(math.isfinite(x) for x in figures[0])


def test_model_compare_picks_one_best(spark):
    train, test = models_q._split(spark, SF0001)
    cmp = tuning.model_compare(train, test, ["l_quantity"], "label").collect()
    best = [r for r in cmp if r.is_best]
    assert len(best) == 1 and best[0].rmse == min(r.rmse for r in cmp)


def test_model_compare_figures_use_all_features(spark):
    rows = QUERIES["model_compare_figures"](spark, SF0001).collect()
    assert [r.model for r in rows] == ["linear", "decision_tree", "random_forest", "gbt"]
    best = [r for r in rows if r.is_best]
    assert len(best) == 1 and best[0].rmse == min(r.rmse for r in rows)
    # the linear row by the normal equations of every feature
    cols = models_q._features(spark, SF0001)
    assert len(cols) == 3
    (x, y), (u, v) = ((np.array([[1.0, *(float(r[c]) for c in cols)] for r in got]), np.array([float(r["label"]) for r in got]))
                      for got in (df.collect() for df in models_q._split(spark, SF0001)))
    error = v - u @ np.linalg.solve(x.T @ x, x.T @ y)
    assert math.isclose(rows[0].rmse, math.sqrt((error ** 2).mean()), rel_tol=1e-9)
    assert math.isclose(rows[0].r2, 1 - (error ** 2).mean() / v.var(), rel_tol=1e-6, abs_tol=1e-9)
    assert all(r.n_test == len(v) and math.isclose(r.r2, 1 - r.rmse ** 2 / v.var(), abs_tol=1e-9) for r in rows)


def test_forest_figures_are_the_errors(spark):
    (r,) = QUERIES["fit_random_forest_figures"](spark, SF0001).collect()
    train, test = models_q._split(spark, SF0001)
    m = models.fit_regressor(train, models_q._features(spark, SF0001), "label", "random_forest", seed=42)
    y, p = (np.array(x) for x in zip(*((float(x["label"]), x["prediction"]) for x in models.predict(m, test).collect()), strict=True))
    assert (r.model, r.n_test) == ("random_forest", len(y))
    assert math.isclose(r.rmse, math.sqrt(((y - p) ** 2).mean()), rel_tol=1e-9) and math.isclose(r.mae, abs(y - p).mean(), rel_tol=1e-9)
    assert math.isclose(r.r2, 1 - ((y - p) ** 2).mean() / y.var(), abs_tol=1e-9)


def test_split_search_sql_equals_a_fit_with_signal(duck, spark):
    """Depth, leaf means and residual steps of the boosting SQL, on labels that
    follow the features, with a value that only test rows hold."""
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), float(3 * a - 2 * b + (10 if a > 3 and b < 4 else 0) + rng.normal())) for a, b in rng.integers(0, 8, (400, 2))]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    cells = ("SELECT 0 AS fit, 3 AS depth, 0.3::DOUBLE AS step, 4 AS rounds, row_number() OVER () AS cell, a, b, COUNT(*)::DOUBLE AS n, "
             "SUM(label)::DOUBLE AS y FROM (VALUES " + ", ".join(map(str, rows)) + ") t(a, b, label) GROUP BY a, b")
    got = duck.execute(f"WITH RECURSIVE {treesql.boosting_sql(cells, ['a', 'b'])} SELECT a, b, p FROM boosted WHERE level = 0 AND tree = 4").fetchall()
    m = models.fit_regressor(df, ["a", "b"], "label", "gbt", maxDepth=3, stepSize=0.3, maxIter=4)
    want = {(r.a, r.b): r.prediction for r in models.predict(m, df.select("a", "b").distinct()).collect()}
    assert len(got) == len(want) and all(math.isclose(p, want[a, b], rel_tol=1e-9) for a, b, p in got)


def test_logistic_figures_are_a_model_and_its_matrix(spark):
    fit = QUERIES["fit_logistic"](spark, SF0001).collect()
    assert [r.term for r in fit] == ["intercept", *models_q.DOC_FEATURES]
    rows = models_q._doc_split(spark, SF0001)[1].collect()
    m = QUERIES["evaluate_logistic"](spark, SF0001).collect()
    cells = {(int(r["label"]), k): r[f"pred_{k}"] for r in m for k in (0, 1)}
    assert sum(cells.values()) == fit[0].n_test == len(rows) and 0 <= m[0].auc <= 1
    assert math.isclose(m[0].accuracy, sum(n for (a, b), n in cells.items() if a == b) / len(rows), abs_tol=1e-6)
    assert m[0].accuracy == fit[0].accuracy


def test_multinomial_figures_are_coefficients(spark):
    rows = QUERIES["fit_multinomial_figures"](spark, SF0001).collect()
    labels = {r.label for r in rows}
    size = len(rows) // len(labels)
    assert size > 2 and all(sum(r.label == k for r in rows) == size for k in labels)
    assert len({r.value for r in rows}) > size and 0 <= rows[0].accuracy <= 1 and rows[0].n_test > 0


def test_new_rows_get_probabilities(spark):
    rows = QUERIES["score_new_rows"](spark, SF0001).collect()
    assert rows and len({r.p1 for r in rows}) > 1
    assert all(0 <= r.p1 <= 1 and (r.p1 == 0.5 or r.prediction == float(r.p1 > 0.5)) for r in rows)


def test_grid_matches_oracle(spark, duck):
    rows = QUERIES["grid_search_cv"](spark, SF0001).collect()
    res = duck.execute(ORACLES["grid_search_cv"])
    at = {d[0]: i for i, d in enumerate(res.description)}
    want = {(r[at["maxDepth"]], r[at["maxIter"]], r[at["stepSize"]]): r[at["cv_rmse"]] for r in res.fetchall()}
    assert len(want) == 18 and set(at) == set(rows[0].asDict())
    for r in rows:
        exact = r.maxDepth == 3
        assert math.isclose(r.cv_rmse, want[r.maxDepth, r.maxIter, r.stepSize], rel_tol=1e-9 if exact else 0.02), r
    assert len(rows) == 18 and len({r.cv_rmse for r in rows}) > 1
    (best,) = [r for r in rows if r.is_best]
    assert best.cv_rmse == min(r.cv_rmse for r in rows) and best.n_test == models_q._split(spark, SF0001)[1].count()
    assert all((r.test_rmse is None) == (not r.is_best) for r in rows)
