"""Profiling, feature and model operators on a generated class of marks, plus
invariants (SURVEY §5)."""

from __future__ import annotations

import math
import os
import statistics
import tempfile

import pytest
from pyspark.sql import functions as F

from sparkdeck.operators import evaluate, features, models, profile, relational, tuning
from sparkdeck.sources.csv import read_csv_strings

# A generated class: the exam follows essay and quiz but for a small remainder.
HEAD = ["student", "essay", "quiz", "attendance", "exam"]
ROWS = [(i, 30 + i * 37 % 69, 28 + i * 53 % 71, 40 + i * 29 % 60) for i in range(1, 25)]
ROWS = [(*r, round(4 + 0.6 * r[1] + 0.35 * r[2] + r[0] * 7 % 5 - 2)) for r in ROWS]
MARKS = "\n".join(",".join(map(str, r)) for r in [HEAD, *ROWS]) + "\n"
CW1, CW2, ATT, EXAM = HEAD[1:]


def column(name):
    return [r[HEAD.index(name)] for r in ROWS]


@pytest.fixture(scope="module")
def marks(spark):
    d = tempfile.mkdtemp(prefix="marks-")
    with open(os.path.join(d, "marks.csv"), "w", newline="") as f:
        f.write(MARKS.replace("\n", "\r\n"))  # CRLF
    raw = read_csv_strings(spark, d)
    df = relational.cast_all(raw, "float")
    return relational.drop_columns(df, ["student", ATT]).cache()


def test_marks_read_and_cast(marks):
    assert marks.columns == [CW1, CW2, EXAM] and marks.count() == len(ROWS)


def test_numeric_summary_marks(marks):
    s = {r.column_name: r for r in profile.numeric_summary(marks, [CW1, CW2, EXAM]).collect()}
    for c in (CW1, CW2, EXAM):
        x = column(c)
        assert (s[c]["min"], s[c]["max"]) == (min(x), max(x))
        assert s[c]["mean"] == pytest.approx(statistics.fmean(x)) and s[c]["stddev"] == pytest.approx(statistics.stdev(x))


def test_quantiles_marks(marks):
    q = profile.quantiles(marks, [CW1, CW2, EXAM], [0.25, 0.5, 0.75], relative_error=0).collect()
    got = {(r.column_name, r.prob): r.value for r in q}
    for c in (CW1, CW2, EXAM):
        x = sorted(column(c))
        assert [got[(c, p)] for p in (0.25, 0.5, 0.75)] == [x[math.ceil(p * len(x)) - 1] for p in (0.25, 0.5, 0.75)]


def test_exact_quantiles_of_twenty_million_values(spark):
    n = 20_000_000
    # a bijection of 0..n-1: the value of rank r is r - 1
    df = spark.range(n, numPartitions=8).select(((F.col("id") * 7_368_787 + 11) % n).cast("double").alias("x"))
    probs = [0.0, 0.001, 0.25, 1 / 3, 0.5, 0.75, 0.999999, 1.0]
    got = profile.exact_quantiles(df, ["x"], probs)
    assert got == {(None, "x", p): float(max(1, math.ceil(p * n - 1e-12)) - 1) for p in probs}


def test_exact_quantiles_of_odd_columns(spark):
    inf, nan = math.inf, math.nan
    rows = ([("a", v) for v in (1e308, -1e308, inf, -inf, nan, None, 0.0, -0.0, 1e-300)] + [("b", 5.0)] * 3000 + [(None, 2.0), ("c", None)])
    df = spark.createDataFrame(rows, "g string, x double").withColumn("y", F.lit(None).cast("double"))
    got = profile.exact_quantiles(df, ["x", "y"], [0.0, 0.5, 1.0], "g")
    assert got == {("a", "x", 0.0): -inf, ("a", "x", 0.5): 0.0, ("a", "x", 1.0): inf, ("b", "x", 0.0): 5.0, ("b", "x", 0.5): 5.0,
                   ("b", "x", 1.0): 5.0, (None, "x", 0.0): 2.0, (None, "x", 0.5): 2.0, (None, "x", 1.0): 2.0}
    assert features.iqr_filter(df, "y", 0).isEmpty() and features.iqr_outliers(df, "y", 0).isEmpty()


def test_linear_regression_marks(spark, marks):
    m = models.fit_regressor(marks, [CW1], EXAM, "linear")
    terms = {r.term: r.value for r in models.linear_terms(spark, m, [CW1]).collect()}
    slope, intercept = statistics.linear_regression(column(CW1), column(EXAM))
    assert terms[CW1] == pytest.approx(slope, abs=1e-6) and terms["intercept"] == pytest.approx(intercept, abs=1e-5)
    met = evaluate.regression_metrics(models.predict(m, marks), EXAM).first()
    assert met.r2 == pytest.approx(statistics.correlation(column(CW1), column(EXAM)) ** 2, abs=1e-6)


def test_centred_pipeline_has_the_mean_as_intercept(spark, marks):
    m = models.fit_regressor(marks, [CW1, CW2], EXAM, "linear", scale=True, with_mean=True, regParam=0.3, maxIter=10)
    terms = {r.term: r.value for r in models.linear_terms(spark, m, [CW1, CW2]).collect()}
    assert terms["intercept"] == pytest.approx(statistics.fmean(column(EXAM)))


def test_metrics_of_a_constant_label_and_of_no_rows(spark):
    one = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "label double, prediction double")
    r = evaluate.regression_metrics(one).first()
    assert (r.n, r.rmse, r.r2) == (2, 1.0, None)
    r = evaluate.regression_metrics(one.limit(0)).first()
    assert (r.n, r.rmse, r.r2, r.mae) == (0, None, None, None)


def test_iqr_filter_partition_invariant(spark):
    df = spark.createDataFrame([(i, float(v) if v is not None else None)
                                for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 100, -50, None])],
                               "id int, x double")
    kept = features.iqr_filter(df, "x", 0).count()
    out = features.iqr_outliers(df, "x", 0).count()
    nulls = df.filter(F.col("x").isNull()).count()
    assert kept + out + nulls == df.count() and out == 2


def test_minmax_within_unit_interval_and_constant(spark):
    df = spark.createDataFrame([(1, 3.0, 7.0), (2, 5.0, 7.0), (3, 9.0, 7.0)], "id int, a double, c double")
    s = features.minmax_scale(df, df, ["a", "c"])
    got = sorted(tuple(r) for r in s.select("id", *features.vector_columns("scaled", ["a", "c"])).collect())
    assert got == [(1, 0.0, 0.5), (2, 1 / 3, 0.5), (3, 1.0, 0.5)]


def test_standard_scale_zero_std(spark):
    df = spark.createDataFrame([(1, 7.0), (2, 7.0)], "id int, c double")
    got = features.standard_scale(df, df, ["c"]).select(*features.vector_columns("scaled", ["c"])).collect()
    assert [r.c for r in got] == [0.0, 0.0]


def test_impute_mean_int_column_not_truncated(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, None), (4, 3), (5, 3)], "id int, x int")
    got = {r.id: r.x_imputed for r in features.impute_mean(df, df, ["x"]).collect()}
    assert got[3] == pytest.approx(2.75)


def test_impute_fit_on_train_only(spark):
    train = spark.createDataFrame([(1, 1.0), (2, 3.0)], "id int, x double")
    test = spark.createDataFrame([(3, None), (4, 100.0)], "id int, x double")
    got = {r.id: r.x_imputed for r in features.impute_mean(train, test, ["x"]).collect()}
    assert got == {3: 2.0, 4: 100.0}


def test_string_index_order_and_keep(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), (None,)], "k string")
    got = {r.k: r.k_idx for r in features.string_index(df, df, ["k"]).collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, None: 3.0}  # ties by value, NULL -> n


def test_ordinal_encode_default(spark):
    df = spark.createDataFrame([("Graduate",), ("Not Graduate",), ("x",), (None,)], "e string")
    m = {"Graduate": 1, "Not Graduate": 0}
    assert [r.e_ord for r in features.ordinal_encode(df, "e", m).collect()] == [1, 0, -1, -1]
    assert [r.e_ord for r in features.ordinal_encode_udf(df, "e", lambda v: m.get(v, -1)).collect()] == [1, 0, -1, -1]


def test_ordinal_udf_calls_the_function_once_a_distinct_value(spark):
    df = spark.createDataFrame([("a",)] * 500 + [("b",)] * 400 + [(None,)] * 100, "e string").coalesce(1)

    def numbered(v, seen=[]):  # noqa: B006 - counts the calls
        seen.append(v)
        return len(seen)

    assert features.ordinal_encode_udf(df, "e", numbered).agg(F.max("e_ord")).first()[0] == 3


def test_numeric_transform_edges(spark):
    df = spark.createDataFrame([(0.0,), (-8.0,), (8.0,)], "x double")
    r = {x.x: x for x in features.numeric_transforms(df, "x").collect()}
    assert r[0.0].x_log is None and r[0.0].x_recip is None
    assert r[-8.0].x_cbrt == -2.0 and r[-8.0].x_cbrt_pow != r[-8.0].x_cbrt_pow  # NaN
    assert r[8.0].x_cbrt_pow == pytest.approx(2.0)


def test_stable_split_is_partition_independent(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = features.stable_split(df.repartition(1), ["k"], [0.7, 0.3], 7, ["train", "test"])
    b = features.stable_split(df.repartition(5), ["k"], [0.7, 0.3], 7, ["train", "test"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    n_train = a.filter(F.col("split") == "train").count()
    assert 600 < n_train < 800


def test_stable_split_serves_small_shares(spark):
    df = spark.range(100_000).withColumnRenamed("id", "k")
    n = features.stable_split(df, ["k"], [0.996, 0.004], 42, ["train", "test"]).where("split = 'test'").count()
    assert 300 < n < 500


def test_cv_folds_disjoint(spark):
    df = spark.range(300).withColumnRenamed("id", "k")
    f = df.select("k", features.stable_bucket(["k"], 42, 3).alias("fold"))
    assert f.groupBy("k").agg(F.countDistinct("fold").alias("n")).filter("n <> 1").count() == 0
    assert sorted(r.fold for r in f.select("fold").distinct().collect()) == [0, 1, 2]


def test_confusion_and_accuracy(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, prediction int")
    odd = df.union(spark.createDataFrame([(0, 7), (0, None)], df.schema))
    cm = {r.label: (r.pred_0, r.pred_1, r.pred_other) for r in profile.confusion_matrix(odd, "label", "prediction", [0, 1]).collect()}
    assert cm == {0: (2, 0, 2), 1: (1, 1, 0)}
    assert evaluate.accuracy(df).first().accuracy == 0.75


def test_auc_ties_count_half(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "label int, score double")
    # pairs (pos, neg): (.9,.9) tie 0.5, (.9,.1) 1, (.5,.9) 0, (.5,.1) 1
    assert evaluate.auc_roc(df).first().auc == pytest.approx(2.5 / 4)


def test_model_compare_and_grid(spark, marks):
    df = marks.withColumn("k", F.monotonically_increasing_id())
    train, test = tuning.with_split(df, ["k"], 0.7, 1)
    cmp = tuning.model_compare(train, test, [CW1, CW2], EXAM).collect()
    assert [r.model for r in cmp] == ["linear", "decision_tree", "random_forest", "gbt"]
    assert sum(r.is_best for r in cmp) == 1
    lin = [r for r in cmp if r.model == "linear"][0]
    assert lin.r2 > 0.9  # better than predicting the mean
    found = tuning.grid_search_cv(train, [CW1, CW2], EXAM, ["k"], {"maxDepth": [2, 3], "maxIter": [2, 5]}, folds=2)
    g = found.results.collect()
    assert len(g) == 4 and sum(r.is_best for r in g) == 1
    assert min(g, key=lambda r: r.cv_rmse).is_best and found.evaluate(test, EXAM).first().n == test.count()
    # a prefix scores as a fit of that length
    data = train.withColumn("f", features.stable_bucket(["k"], 42, 2)).cache()
    for depth, n in ((2, 2), (3, 5)):
        each = []
        for fold in (0, 1):
            m = models.fit_regressor(data.where(F.col("f") != fold), [CW1, CW2], EXAM, "gbt", scale=True, maxDepth=depth, maxIter=n)
            each.append(evaluate.regression_metrics(models.predict(m, data.where(F.col("f") == fold)), EXAM).first().rmse)
        mine = next(r.cv_rmse for r in g if (r.maxDepth, r.maxIter) == (depth, n))
        assert mine == pytest.approx(sum(each) / 2, rel=1e-9)


@pytest.mark.parametrize("scaler", ["minmax", "standard", "centred"])
def test_prepare_features_shape(spark, scaler):
    df = spark.createDataFrame([(i, " a" if i % 3 else " ?", " low" if i % 2 else " high", float(i), float(i % 5), " yes" if i % 4 else " no")
                                for i in range(30)], "id int, seg string, st string, p double, b double, t string")
    out = features.prepare_features(df, ["seg"], {"st": {"low": 0, "high": 1}}, ["p", "b"], "t", relative_error=0, iqr_col="p", scaler=scaler)
    assert out.columns == ["id", "label", "features"] and out.count() == 30
    assert out.first().features.size == 2 + 1 + 2 and {r.label for r in out.collect()} == {0.0, 1.0}
