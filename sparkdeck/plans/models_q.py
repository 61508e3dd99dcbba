"""Registered model queries.

All but the random forest equal their SQL: closed forms (linear / ridge fits,
predictions, metrics), an exact split search for trees and boosting
(``treesql.boosting_sql``), Newton steps for the binary logistic fit
(``treesql.newton_sql``), score equations for the multinomial one.  A forest's
bootstrap draws from MLlib's own generator; it is held to an identity here and
its figures are in ``fit_random_forest_figures``.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from sparkdeck.operators import evaluate, models, profile, tuning
from sparkdeck.operators.features import stable_split
from sparkdeck.operators.relational import feature_columns
from sparkdeck.plans import bindings as B
from sparkdeck.plans import sqlparts as S
from sparkdeck.plans.registry import query
from sparkdeck.plans.treesql import boosting_sql, newton_sql

DOC_FEATURES = ["n_chars", "n_lines", "n_words", "n_digits"]
REG_KEY = ["order_id", "line_id"]
RIDGE = {"regParam": 0.3, "maxIter": 10}

_REG_SPLIT = f"SELECT *, {S.train_test('order_id, line_id')} AS split FROM ({S.REGRESSION}) r"
_TRAIN_FIT = (f"(SELECT regr_slope(label, l_quantity) AS b, regr_intercept(label, l_quantity) AS a "
              f"FROM ({_REG_SPLIT}) s WHERE split = 'train')")


def _split(spark, d):
    return tuning.with_split(B.regression_table(spark, d), REG_KEY, 0.7, 42)


@query("fit_linear", f"""
SELECT 'intercept' AS term, ROUND(regr_intercept(label, l_quantity), 4) AS value FROM ({S.REGRESSION}) r
UNION ALL
SELECT 'l_quantity' AS term, ROUND(regr_slope(label, l_quantity), 4) AS value FROM ({S.REGRESSION}) r""")
def q_fit_linear(spark, d):
    m = models.fit_regressor(B.regression_table(spark, d), ["l_quantity"], "label", "linear")
    return models.linear_terms(spark, m, ["l_quantity"]).select("term", F.round("value", 4).alias("value"))


# Ridge on two centred, scaled features: with R their correlation and l the
# penalty in label deviations, (R + l I) beta = corr(x, y).
_RIDGE = f"""
WITH m AS (SELECT corr(l_quantity, l_discount) AS r, corr(l_quantity, label) AS a, corr(l_discount, label) AS b,
                  stddev_pop(label) AS sy, 0.3 / stddev_pop(label) AS l, AVG(label) AS mean,
                  stddev_samp(l_quantity) / stddev_pop(l_quantity) AS k
           FROM ({S.REGRESSION}) r)
SELECT 'intercept' AS term, ROUND(mean, 4) AS value FROM m
UNION ALL SELECT 'l_quantity', ROUND(k * sy * ((1 + l) * a - r * b) / ((1 + l) * (1 + l) - r * r), 4) FROM m
UNION ALL SELECT 'l_discount', ROUND(k * sy * ((1 + l) * b - r * a) / ((1 + l) * (1 + l) - r * r), 4) FROM m"""


@query("fit_ridge", _RIDGE)
def q_fit_ridge(spark, d):
    cols = ["l_quantity", "l_discount"]
    m = models.fit_regressor(B.regression_table(spark, d), cols, "label", "linear", scale=True, with_mean=True, **RIDGE)
    return models.linear_terms(spark, m, cols).select("term", F.round("value", 4).alias("value"))


def _linear_test_predictions(spark, d):
    train, test = _split(spark, d)
    m = models.fit_regressor(train, ["l_quantity"], "label", "linear")
    return models.predict(m, test)


@query("predict_linear", f"""
SELECT order_id, line_id, ROUND(f.a + f.b * l_quantity, 2) AS prediction
FROM ({_REG_SPLIT}) s, {_TRAIN_FIT} f WHERE split = 'test'""")
def q_predict_linear(spark, d):
    p = _linear_test_predictions(spark, d)
    return p.select("order_id", "line_id", F.round("prediction", 2).alias("prediction"))


@query("regression_metrics", f"""
WITH p AS (SELECT label, f.a + f.b * l_quantity AS prediction FROM ({_REG_SPLIT}) s, {_TRAIN_FIT} f
           WHERE split = 'test')
SELECT COUNT(*) AS n, ROUND(sqrt(SUM((label - prediction) ^ 2) / COUNT(*)), 4) AS rmse,
       ROUND(1 - SUM((label - prediction) ^ 2) / (var_pop(label) * COUNT(*)), 6) AS r2,
       ROUND(AVG(abs(label - prediction)), 4) AS mae
FROM p""")
def q_regression_metrics(spark, d):
    m = evaluate.regression_metrics(_linear_test_predictions(spark, d), "label", "prediction")
    return m.select("n", F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"),
                    F.round("mae", 4).alias("mae"))


@query("accuracy", f"""
SELECT {S.train_test('doc_id')} AS split,
       COUNT(*) AS n, ROUND(AVG(CAST(label = prediction AS DOUBLE)), 6) AS accuracy
FROM ({S.SCORED_LABELS}) s GROUP BY 1""")
def q_accuracy(spark, d):
    s = stable_split(B.scored_labels(spark, d), ["doc_id"], [0.7, 0.3], 42, ["train", "test"])
    a = evaluate.accuracy(s, "label", "prediction", by=["split"])
    return a.select("split", "n", F.round("accuracy", 6).alias("accuracy"))


@query("auc_roc", f"""
WITH r AS (SELECT label, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk
           FROM ({S.SCORED_LABELS}) s),
c AS (SELECT SUM(rk) FILTER (WHERE label = 1) AS rs, COUNT(*) FILTER (WHERE label = 1) AS p,
             COUNT(*) FILTER (WHERE label = 0) AS q, COUNT(*) AS n FROM r)
SELECT ROUND((rs - p * (p + 1) / 2.0) / (p * q), 6) AS auc, n, p AS n_pos FROM c""")
def q_auc_roc(spark, d):
    a = evaluate.auc_roc(B.scored_labels(spark, d), "label", "score")
    return a.select(F.round("auc", 6).alias("auc"), "n", "n_pos")


# ----------------------------------------------------------- tree models --
# With at least as many bins as a feature has values, MLlib's thresholds are
# the midpoints between neighbouring values, so the split search can be stated.

FEATURES = ["l_quantity", "l_discount", "l_tax"]
TREE = {"maxBins": 64}

def _features(spark, d) -> list[str]:
    """Every column of the regression table but the label and the key."""
    return feature_columns(B.regression_table(spark, d), "label", exclude=REG_KEY)


_FIT_SQL = f"""
SELECT '{{kind}}' AS model, COUNT(*) FILTER (WHERE split = 'test') AS n_test,
       ROUND(AVG(label) FILTER (WHERE split = 'train') / {{unit}}, {{digits}}) AS train_mean, 1.0::DOUBLE AS test_error
FROM ({_REG_SPLIT}) s"""


def _fit_eval(spark, d, kind, unit=None, digits=2):
    train, test = _split(spark, d)
    m = models.fit_regressor(train, _features(spark, d), "label", kind, seed=42)
    mean = models.predict(m, train).agg(F.avg("prediction").alias("p"), F.avg("label").alias("y")).first()
    scored = models.predict(m, test)
    met = evaluate.regression_metrics(scored, "label", "prediction").first()
    spread = scored.agg(F.stddev_pop("label")).first()[0]
    row = (kind, met["n"], round(mean["p"] / (mean["y"] if unit else 1.0), digits), float(round(met["rmse"] / spread)))
    return spark.createDataFrame([row], "model string, n_test long, train_mean double, test_error double")


# Sums of training rows per combination of feature values; test rows are scored by theirs.
_CELLS = f"""
SELECT 0 AS fit, {{depth}} AS depth, {{step}}::DOUBLE AS step, {{rounds}} AS rounds, row_number() OVER () AS cell, {', '.join(FEATURES)}, n, y
FROM (SELECT {', '.join(FEATURES)}, COUNT(*) FILTER (WHERE split = 'train')::DOUBLE AS n,
             COALESCE(SUM(label) FILTER (WHERE split = 'train'), 0)::DOUBLE AS y
      FROM ({_REG_SPLIT}) s GROUP BY {', '.join(FEATURES)}) c"""


def _boosted(depth: int, step: float, rounds: int) -> str:
    return boosting_sql(_CELLS.format(depth=depth, step=step, rounds=rounds), FEATURES)


def _tree_figures(kind: str, depth: int, step: float, rounds: int) -> str:
    """Leaves and test figures of the trees of ``_boosted``."""
    return f"""
WITH RECURSIVE {_boosted(depth, step, rounds)},
done AS MATERIALIZED (SELECT * FROM boosted WHERE level = 0 AND tree > 0),
t AS (SELECT label, p AS prediction FROM ({_REG_SPLIT}) s JOIN done USING ({', '.join(FEATURES)}) WHERE split = 'test' AND tree = {rounds})
SELECT '{kind}' AS model, (SELECT COUNT(DISTINCT (tree, leaf)) FROM done WHERE n > 0) AS n_leaves, COUNT(*) AS n_test,
       ROUND(sqrt(SUM((label - prediction) ^ 2) / COUNT(*)), 2) AS rmse,
       ROUND(1 - SUM((label - prediction) ^ 2) / (var_pop(label) * COUNT(*)), 6) AS r2, ROUND(AVG(abs(label - prediction)), 2) AS mae
FROM t"""


def _fit_eval_trees(spark, d, kind, **params):
    """Leaves of the fitted trees, and RMSE, R2 and MAE on test rows."""
    train, test = _split(spark, d)
    m = models.fit_regressor(train, FEATURES, "label", kind, seed=42, **TREE, **params)
    fitted = m.stages[-1]
    leaves = sum((t.numNodes + 1) // 2 for t in getattr(fitted, "trees", [fitted]))
    met = evaluate.regression_metrics(models.predict(m, test), "label", "prediction")
    return met.select(F.lit(kind).alias("model"), F.lit(leaves).cast("long").alias("n_leaves"), F.col("n").alias("n_test"),
                      F.round("rmse", 2).alias("rmse"), F.round("r2", 6).alias("r2"), F.round("mae", 2).alias("mae"))


@query("fit_decision_tree", _tree_figures("decision_tree", 5, 0.1, 1))
def q_fit_decision_tree(spark, d):
    return _fit_eval_trees(spark, d, "decision_tree")


_TRAIN_MEAN = "AVG(label) FILTER (WHERE split = 'train')"


@query("fit_random_forest", _FIT_SQL.format(kind="random_forest", unit=_TRAIN_MEAN, digits=2))
def q_fit_random_forest(spark, d):
    return _fit_eval(spark, d, "random_forest", unit="label mean")


@query("fit_gbt", _tree_figures("gbt", 5, 0.1, 20))
def q_fit_gbt(spark, d):
    """K6: twenty rounds of depth 5."""
    return _fit_eval_trees(spark, d, "gbt")


# ------------------------------------------------------- logistic models --

def _doc_split(spark, d):
    return tuning.with_split(B.labelled_documents(spark, d), ["doc_id"], 0.7, 42)


# Enough steps for the coefficients to hold to the digits shown.
LOGISTIC = {"maxIter": 500, "tol": 1e-12}

_DOC_FEATURES_SQL = r"""
SELECT l.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS n_chars,
       CAST(len(string_split(d.text, chr(10))) AS DOUBLE) AS n_lines,
       CAST(len(string_split_regex(trim(d.text, ' '), '[ \t\n\x0B\f\r]+')) AS DOUBLE) AS n_words,
       CAST(length(regexp_replace(d.text, '[^0-9]', '', 'g')) AS DOUBLE) AS n_digits
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""
# Features in training deviations (as the fit scales them), and the Newton steps on them.
_DOC_ROWS = f"""
SELECT f.doc_id, f.label, f.split, {', '.join(f'f.{c} / m.{c} AS {c}' for c in DOC_FEATURES)}
FROM (SELECT *, {S.train_test('doc_id')} AS split FROM ({_DOC_FEATURES_SQL}) x) f,
     (SELECT {', '.join(f'stddev_samp({c}) AS {c}' for c in DOC_FEATURES)}
      FROM (SELECT *, {S.train_test('doc_id')} AS split FROM ({_DOC_FEATURES_SQL}) y) z WHERE split = 'train') m"""
_LOGISTIC = f"""
WITH RECURSIVE doc_rows AS MATERIALIZED ({_DOC_ROWS}),
train AS MATERIALIZED (SELECT * FROM doc_rows WHERE split = 'train'),
{newton_sql('SELECT * FROM train', DOC_FEATURES)},
beta AS MATERIALIZED (SELECT * FROM newton WHERE step = 30),
scored AS MATERIALIZED (
  SELECT doc_id, label, 1 / (1 + exp(-(b0 + {' + '.join(f'b{i} * {c}' for i, c in enumerate(DOC_FEATURES, 1))}))) AS p1 FROM doc_rows, beta WHERE split = 'test')"""


def _logistic_fit(spark, d):
    """K7: the fit on the training documents, and the test documents."""
    train, test = _doc_split(spark, d)
    return models.fit_logistic(train, DOC_FEATURES, "label", scale=True, **LOGISTIC), test


@query("fit_logistic", _LOGISTIC + ",\na AS (SELECT COUNT(*) AS n, AVG(CAST((p1 > 0.5) = (label = 1) AS DOUBLE)) AS accuracy FROM scored)\n"
       + "\nUNION ALL ".join(f"SELECT '{t}' AS term, ROUND(b{i}, 3) AS value, n AS n_test, ROUND(accuracy, 6) AS accuracy FROM beta, a"
                             for i, t in enumerate(["intercept", *DOC_FEATURES])))
def q_fit_logistic(spark, d):
    """Coefficients (of the scaled features) and test accuracy."""
    m, test = _logistic_fit(spark, d)
    return _with_test_accuracy(models.logistic_terms(spark, m, DOC_FEATURES), m, test).select(
        "term", F.round("value", 3).alias("value"), "n_test", F.round("accuracy", 6).alias("accuracy"))


@query("evaluate_logistic", _LOGISTIC + """,
r AS (SELECT label, rank() OVER (ORDER BY p1) + (COUNT(*) OVER (PARTITION BY p1) - 1) / 2.0 AS rk FROM scored),
c AS (SELECT SUM(rk) FILTER (WHERE label = 1) AS rs, COUNT(*) FILTER (WHERE label = 1) AS p, COUNT(*) FILTER (WHERE label = 0) AS q FROM r),
a AS (SELECT AVG(CAST((p1 > 0.5) = (label = 1) AS DOUBLE)) AS accuracy FROM scored)
SELECT label, COUNT(*) FILTER (WHERE p1 <= 0.5) AS pred_0, COUNT(*) FILTER (WHERE p1 > 0.5) AS pred_1,
       ROUND(any_value(accuracy), 6) AS accuracy, ROUND(any_value((rs - p * (p + 1) / 2.0) / (p * q)), 4) AS auc
FROM scored, c, a GROUP BY label""")
def q_evaluate_logistic(spark, d):
    """The confusion matrix on test rows, accuracy and AUC."""
    m, test = _logistic_fit(spark, d)
    scored = models.positive_probability(models.predict(m, test))
    accuracy = evaluate.accuracy(scored, "label", "prediction").first()["accuracy"]
    auc = evaluate.auc_roc(scored, "label", "p1").first()["auc"]
    return profile.confusion_matrix(scored, "label", "prediction", [0, 1]).select(
        "label", "pred_0", "pred_1", F.round(F.lit(accuracy), 6).alias("accuracy"), F.round(F.lit(auc), 4).alias("auc"))


# Score equations of the multinomial fit: per label and component, the sum of
# probability times component is that of the label's own rows.  Together
# they hold for no other model of the family.
_MULTINOMIAL = {"maxIter": 500, "tol": 1e-10, "regParam": 0.0}


def _embedding_split(spark, d):
    e = B.embedding_table(spark, d).select("vec_id", array_to_vector("embedding").alias("embedding"),
                                          F.col("label").cast("double").alias("label"))
    return tuning.with_split(e, ["vec_id"], 0.7, 42)


@query("fit_multinomial", f"""
WITH s AS (SELECT label, embedding, {S.train_test('vec_id')} AS split FROM embeddings),
t AS (SELECT label, unnest(list_prepend(1.0::DOUBLE, embedding::DOUBLE[])) AS x, unnest(range(len(embedding) + 1)) AS component FROM s WHERE split = 'train'),
g AS (SELECT DISTINCT CAST(label AS DOUBLE) AS label FROM s WHERE split = 'train')
SELECT g.label, t.component, ROUND(SUM(CASE WHEN t.label = g.label THEN x ELSE 0 END) / (SELECT COUNT(*) FROM s WHERE split = 'train'), 3) AS expected
FROM t, g GROUP BY g.label, t.component""")
def q_fit_multinomial(spark, d):
    """K8: mean of probability times component over the training rows."""
    train, _ = _embedding_split(spark, d)
    m = models.fit_logistic(train, ["embedding"], "label", family="multinomial", **_MULTINOMIAL)
    p = models.predict(m, train).select(vector_to_array("probability").alias("p"),
                                        F.concat(F.array(F.lit(1.0)), vector_to_array("embedding")).alias("x"))
    terms = p.select("x", F.posexplode("p").alias("k", "p")).select("k", "p", F.posexplode("x").alias("component", "x"))
    sums = terms.groupBy(F.col("k").cast("double").alias("label"), F.col("component").cast("long").alias("component"))
    return sums.agg(F.round(F.sum(F.col("p") * F.col("x")) / F.lit(train.count()), 3).alias("expected"))


_NEW_ROWS = f"""
WITH RECURSIVE m AS MATERIALIZED (SELECT {', '.join(f'stddev_samp({c}) AS {c}' for c in DOC_FEATURES)} FROM ({_DOC_FEATURES_SQL}) z),
train AS MATERIALIZED (SELECT label, {', '.join(f'f.{c} / m.{c} AS {c}' for c in DOC_FEATURES)} FROM ({_DOC_FEATURES_SQL}) f, m),
{newton_sql('SELECT * FROM train', DOC_FEATURES)},
p AS (SELECT f.doc_id, 1 / (1 + exp(-(b0 + {' + '.join(f'b{i} * f.{c} / m.{c}' for i, c in enumerate(DOC_FEATURES, 1))}))) AS p1
      FROM ({_DOC_FEATURES_SQL.replace('l.doc_id, l.quality AS label', 'd.doc_id').replace('labels l JOIN documents d ON l.doc_id = d.doc_id', 'documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)')}) f, m,
           (SELECT * FROM newton WHERE step = 30) b)
SELECT doc_id, ROUND(p1, 3) AS p1, CAST(p1 > 0.5 AS DOUBLE) AS prediction FROM p"""


@query("score_new_rows", _NEW_ROWS)
def q_score_new_rows(spark, d):
    """Probability and prediction of every row without a label."""
    m = models.fit_logistic(B.labelled_documents(spark, d), DOC_FEATURES, "label", scale=True, **LOGISTIC)
    unlabelled = B.document_features(spark, d).join(B.table(spark, d, "labels").select("doc_id"), "doc_id",
                                                    "left_anti")
    return models.positive_probability(models.predict(m, unlabelled)).select("doc_id", F.round("p1", 3).alias("p1"), "prediction")


# Normal equations of all features: two steps of elimination less the mean.
def _linear_predictions(features) -> str:
    """Test rows with the prediction of the least-squares fit on the training rows."""
    k = len(features)
    mean = ", ".join(f"AVG({c}) AS m{i}" for i, c in enumerate([*features, "label"]))
    sums = ", ".join(f"SUM(({a} - m{i}) * ({b} - m{j})) AS a{i}_{j}" for i, a in enumerate(features)
                     for j, b in enumerate([*features, "label"]))
    keep = ", ".join(f"m{i}" for i in range(k + 1))
    inner = (f"SELECT {keep}, {sums} FROM ({_REG_SPLIT}) s, (SELECT {mean} FROM ({_REG_SPLIT}) t WHERE split = 'train') m "
             f"WHERE split = 'train' GROUP BY {keep}")
    for i in range(k):
        cells = [f"a{r}_{r}" for r in range(i + 1)] + [f"a{i}_{c}" for c in range(i + 1, k + 1)]
        cells += [f"a{r}_{c} - a{r}_{i} / a{i}_{i} * a{i}_{c} AS a{r}_{c}" for r in range(k) if r != i for c in range(i + 1, k + 1)]
        inner = f"SELECT {keep}, {', '.join(cells)} FROM ({inner}) g{i}"
    score = " + ".join(f"a{i}_{k} / a{i}_{i} * ({c} - m{i})" for i, c in enumerate(features))
    return f"SELECT label, m{k} + {score} AS prediction FROM ({_REG_SPLIT}) s, ({inner}) b WHERE split = 'test'"


_COMPARED = ("linear", "decision_tree", "gbt")


@query("model_compare", f"""
WITH RECURSIVE {_boosted(5, 0.1, 20)},
done AS MATERIALIZED (SELECT * FROM boosted WHERE level = 0 AND tree IN (1, 20)),
scored AS (
  SELECT CASE WHEN tree = 1 THEN 'decision_tree' ELSE 'gbt' END AS model, label, p AS prediction
  FROM ({_REG_SPLIT}) s JOIN done USING ({', '.join(FEATURES)}) WHERE split = 'test'
  UNION ALL SELECT 'linear', label, prediction FROM ({_linear_predictions(FEATURES)}) l),
e AS (SELECT model, sqrt(AVG((label - prediction) ^ 2)) AS rmse, 1 - SUM((label - prediction) ^ 2) / (var_pop(label) * COUNT(*)) AS r2,
             COUNT(*) AS n_test FROM scored GROUP BY model)
SELECT model, ROUND(rmse, 2) AS rmse, ROUND(r2, 6) AS r2, n_test, rmse = MIN(rmse) OVER () AS is_best FROM e""")
def q_model_compare(spark, d):
    """K16, F3 over the models whose fit SQL can state; ``model_compare_figures``
    adds the random forest."""
    train, test = _split(spark, d)
    t = tuning.model_compare(train, test, FEATURES, "label", _COMPARED, params={"decision_tree": TREE, "gbt": TREE})
    return t.select("model", F.round("rmse", 2).alias("rmse"), F.round("r2", 6).alias("r2"), "n_test", "is_best")


_FOLD = S.stable_bucket("order_id, line_id", 42, 3)
_GRID_CELLS = f"""
SELECT row_number() OVER () AS fit, depth, step, fold, 30 AS rounds FROM
  (VALUES (3), (5), (7)) d(depth), (VALUES (0.05::DOUBLE), (0.1)) s(step), (VALUES (0), (1), (2), (-1)) f(fold)"""


@query("grid_search_cv", f"""
WITH RECURSIVE reg AS MATERIALIZED (SELECT *, {_FOLD} AS fold FROM ({_REG_SPLIT}) s),
fits AS MATERIALIZED ({_GRID_CELLS}),
sums AS MATERIALIZED (SELECT {', '.join(FEATURES)}, fold, COUNT(*)::DOUBLE AS n, SUM(label)::DOUBLE AS y, SUM(label * label)::DOUBLE AS yy
                      FROM reg WHERE split = 'train' GROUP BY ALL),
each_cell AS MATERIALIZED (SELECT row_number() OVER () AS cell, * FROM (SELECT DISTINCT {', '.join(FEATURES)} FROM reg) c),
of_fit AS MATERIALIZED (
  SELECT fit, depth, step, rounds, cell, {', '.join(FEATURES)}, COALESCE(SUM(n) FILTER (WHERE sums.fold <> fits.fold), 0) AS n,
         COALESCE(SUM(y) FILTER (WHERE sums.fold <> fits.fold), 0) AS y
  FROM fits, each_cell LEFT JOIN sums USING ({', '.join(FEATURES)}) GROUP BY ALL),
{boosting_sql("SELECT * FROM of_fit", FEATURES)},
done AS MATERIALIZED (SELECT fit, tree, {', '.join(FEATURES)}, p FROM boosted WHERE level = 0 AND tree IN (10, 20, 30)),
errors AS (SELECT depth, step, tree, fits.fold, sqrt(SUM(yy - 2 * p * y + n * p * p) / SUM(n)) AS rmse
           FROM done JOIN fits USING (fit) JOIN sums ON sums.fold = fits.fold AND {' AND '.join(f'sums.{c} = done.{c}' for c in FEATURES)}
           GROUP BY ALL),
cv AS (SELECT depth, step, tree, AVG(rmse) AS cv_rmse FROM errors GROUP BY ALL),
best AS (SELECT depth, step, tree FROM cv ORDER BY cv_rmse LIMIT 1),
test AS (SELECT COUNT(*) AS n_test, sqrt(AVG((label - p) ^ 2)) AS rmse FROM best JOIN fits USING (depth, step)
         JOIN done USING (fit, tree) JOIN reg USING ({', '.join(FEATURES)}) WHERE fits.fold = -1 AND split = 'test')
SELECT depth::DOUBLE AS "maxDepth", tree::DOUBLE AS "maxIter", step AS "stepSize", ROUND(cv_rmse, 1) AS cv_rmse, best.depth IS NOT NULL AS is_best,
       n_test, CASE WHEN best.depth IS NOT NULL THEN ROUND(test.rmse, 1) END AS test_rmse
FROM cv LEFT JOIN best USING (depth, step, tree), test""")
def q_grid_search_cv(spark, d):
    """The error of every map, the best one, and the refit's error on test rows."""
    train, test = _split(spark, d)
    found = tuning.grid_search_cv(train, FEATURES, "label", REG_KEY, tuning.FULL_GRID, folds=3, seed=42, params=TREE)
    met = found.evaluate(test, "label").first()
    return found.results.select(*tuning.FULL_GRID, F.round("cv_rmse", 1).alias("cv_rmse"), "is_best", F.lit(met["n"]).cast("long").alias("n_test"),
                                F.when(F.col("is_best"), F.round(F.lit(met["rmse"]), 1)).alias("test_rmse"))


# ------------------------------------------------------------ whole figures --
# What SQL cannot state (a forest's bootstrap, 640 coefficients); ``tests/``
# hold it against other fits and its own predictions.

@query("model_compare_figures")
def q_model_compare_figures(spark, d):
    """Four models on all features."""
    train, test = _split(spark, d)
    return tuning.model_compare(train, test, _features(spark, d), "label")


def _fit_figures(spark, d, kind):
    train, test = _split(spark, d)
    m = models.fit_regressor(train, _features(spark, d), "label", kind, seed=42)
    return evaluate.regression_metrics(models.predict(m, test), "label", "prediction").select(
        F.lit(kind).alias("model"), F.col("n").alias("n_test"), "rmse", "r2", "mae")


@query("fit_random_forest_figures")
def q_fit_random_forest_figures(spark, d):
    return _fit_figures(spark, d, "random_forest")


def _with_test_accuracy(terms, m, test):
    """Terms of a model, with its accuracy on the test rows."""
    a = evaluate.accuracy(models.predict(m, test), "label", "prediction").first()
    return terms.withColumns({"n_test": F.lit(a["n"]).cast("long"), "accuracy": F.lit(a["accuracy"]).cast("double")})


@query("fit_multinomial_figures")
def q_fit_multinomial_figures(spark, d):
    """Coefficients per label and test accuracy."""
    train, test = _embedding_split(spark, d)
    m = models.fit_logistic(train, ["embedding"], "label", family="multinomial", maxIter=100)
    lr = m.stages[-1]
    rows = [(float(k), term, float(v)) for k, (b, w) in enumerate(zip(lr.interceptVector, lr.coefficientMatrix.toArray(), strict=True))
            for term, v in [("intercept", b), *((f"embedding_{i}", x) for i, x in enumerate(w))]]
    return _with_test_accuracy(spark.createDataFrame(rows, "label double, term string, value double"), m, test)
