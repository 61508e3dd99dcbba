"""Forms for large or skewed inputs: the same results as the plain forms, and
the plans they are for."""

from __future__ import annotations

import io
import math
import uuid
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdeck.operators import features, linalg, models, profile, tuning, userfuncs
from sparkdeck.operators.ranking import running_totals
from sparkdeck.session import shared_dir
from sparkdeck.sources.sinks import read_kind, write_bucketed, write_by_kind


def plan_of(df) -> str:
    df.collect()
    with redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    return out.getvalue()


def test_running_totals_equal_a_sorted_sum(spark):
    df = spark.range(0, 2000, 1, 5).select(F.col("id"), (F.col("id") * 7919 % 31).alias("w"))
    rows = sorted((r["id"], r["w"], r["total"]) for r in running_totals(df, [F.desc("id")], "w").collect())
    total = 0
    for _, w, got in reversed(rows):
        total += w
        assert got == total


def test_index_of_as_many_labels_as_rows(spark):
    df = spark.range(0, 20_000, 1, 6).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit(1).alias("user_id"))
    got = {r.k: r.k_idx for r in features.string_index(df, df, ["k"], labels_held=100).collect()}
    want = {k: float(i) for i, k in enumerate(sorted(f"k{i}" for i in range(20_000)))}
    assert got == want


@pytest.mark.parametrize("held", [0, 50_000])
def test_index_is_the_same_by_join_and_by_model(spark, held):
    fit = spark.createDataFrame([(x,) for x in ["b"] * 5 + ["a"] * 5 + ["hot"] * 40 + ["c", None, ""]], "k string")
    new = spark.createDataFrame([(i, x) for i, x in enumerate(["a", "b", "hot", "hot", None, "unseen", "", "c"])], "i int, k string")
    got = {r.i: r.k_idx for r in features.string_index(fit, new, ["k"], labels_held=held).collect()}
    assert got == {0: 1.0, 1: 2.0, 2: 0.0, 3: 0.0, 4: 5.0, 5: 5.0, 6: 3.0, 7: 4.0}
    seen = new.where("k <> 'unseen'")
    assert {r.i: r.y for r in features.label_encode(fit, seen, "k", "y", labels_held=held).collect()} == {0: 1.0, 1: 2.0, 2: 0.0, 3: 0.0, 6: 3.0, 7: 4.0}
    assert features.string_index(fit, new, ["k"], handle_invalid="skip", labels_held=held).count() == 6
    with pytest.raises(Exception):
        features.string_index(fit, new, ["k"], handle_invalid="error", labels_held=held).collect()


def test_quantiles_of_many_groups_equal_those_by_intervals(spark):
    rng = np.random.default_rng(2)
    rows = [(None if g == 7 else f"g{g}", float(x)) for g, x in zip(rng.integers(0, 9, 3000), rng.normal(size=3000), strict=True)]
    rows += [("hot", 1.0)] * 2000 + [("hot", float("nan")), ("none", None), ("one", -0.0), ("two", 0.0), ("two", float("inf"))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    _, found = profile.group_quantiles(df, "x", "g", probs)
    got = {(r["_g"], p): r[f"q{i}"] for r in found.collect() for i, p in enumerate(probs)}
    want = {(g, p): v for (g, _, p), v in profile.exact_quantiles(df, ["x"], probs, "g").items()}
    assert got == want
    few, many = (sorted(map(tuple, profile.boxplot_stats(df, "x", "g", groups_held=n).collect()), key=str) for n in (1000, 0))
    assert few == many and len(few) == 12


def test_box_plot_of_many_groups_keeps_nothing_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(profile, "exact_quantiles", lambda *a, **k: pytest.fail("intervals on the driver"))
    df = spark.range(0, 6000, 1, 4).select((F.col("id") % 3000).alias("g"), F.col("id").cast("double").alias("x"))
    got = profile.boxplot_stats(df, "x", "g")
    assert got.count() == 3000 and got.where("n <> 2 or q1 <> g or q3 <> g + 3000").isEmpty()


def test_matvec_blocks_with_a_hot_column(spark):
    entries = spark.range(0, 9000, 1, 6).select(
        (F.col("id") % 50).alias("row"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 700).alias("col"),
        (F.col("id") % 11).cast("double").alias("value"))
    vector = spark.range(0, 600).select(F.col("id").alias("col"), (F.col("id") + 0.5).alias("value")).union(spark.createDataFrame([(1, 0.25)], "col long, value double"))
    got = linalg.matvec_blocks(entries, vector, row_blocks=4)
    want = {r["row"]: r["value"] for r in linalg.matvec(entries, vector).collect()}
    assert {r["row"]: r["value"] for r in got.collect()} == pytest.approx(want)
    plan = plan_of(got)
    assert "SortMergeJoin" in plan and "_block" in plan.split("SortMergeJoin", 1)[1]


def test_group_reduce_merges_partial_states(spark):
    df = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 != 1, F.col("id").cast("string")).alias("k"),
                                           (F.col("id") % 13).alias("x"), F.col("id"))
    got = userfuncs.group_reduce(df, "k", ["x", "id"], zero=lambda: (0, 0, -1), update=lambda s, r: (s[0] + 1, s[1] + r[0], max(s[2], r[1])),
                                 merge=lambda a, b: (a[0] + b[0], a[1] + b[1], max(a[2], b[2])), finish=lambda s: s,
                                 result="n long, total long, last long", keys_held=5, fan_in=3)
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"), F.max("id").alias("last"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = plan_of(got)
    assert "MapInArrow" in plan and plan.count("Exchange hashpartitioning") == 0 and plan.count("FlatMapGroupsInPandas") >= 2
    assert userfuncs.group_reduce(df.limit(0), "k", ["x"], lambda: 0, lambda s, r: s, lambda a, b: a, lambda s: (s,), "n long").isEmpty()


def test_generated_rows(spark):
    df = spark.createDataFrame([("ab",), ("",), (None,), ("c" * 3000,)], "value string")
    got = userfuncs.generate_rows(df, "value", lambda v: ((c, i) for i, c in enumerate(v or "")), "letter string, at int")
    rows = got.collect()
    assert len(rows) == 3002 and got.columns == ["letter", "at"] and ("b", 1) in {tuple(r) for r in rows}


def test_bucketed_tables_join_and_group_without_an_exchange(spark):
    name = uuid.uuid4().hex
    r = spark.range(0, 3000, 1, 4).select((F.col("id") % 100).alias("user_id"), F.col("id").alias("rating"))
    u = spark.range(0, 100).select(F.col("id").alias("user_id"), (F.col("id") % 3).alias("segment"))
    tables = [write_bucketed(df, f"{t}_{name}", shared_dir(spark, t), "user_id", 8) for t, df in (("r", r), ("u", u))]
    j = tables[0].join(tables[1].hint("merge"), "user_id").groupBy("user_id", "segment").agg(F.sum("rating").alias("s"))
    assert sorted(map(tuple, j.collect())) == sorted(map(tuple, r.join(u, "user_id").groupBy("user_id", "segment").agg(F.sum("rating")).collect()))
    assert "Exchange" not in plan_of(j)


def test_one_kind_is_read_by_its_folder(spark):
    path = shared_dir(spark, "kinds")
    df = spark.createDataFrame([("U", 1), ("R", 2), ("R", 3)], "kind string, x int")
    write_by_kind(df, path)
    assert sorted(r.x for r in read_kind(spark, path, "R").collect()) == [2, 3]
    partition_filters = [x for x in plan_of(read_kind(spark, path, "R")).splitlines() if "PartitionFilters" in x]
    assert partition_filters and "= R" in partition_filters[0]
    write_by_kind(spark.createDataFrame([("R", 9)], "kind string, x int"), path)  # replaces one folder
    assert [r.x for r in read_kind(spark, path, "R").collect()] == [9] and [r.x for r in read_kind(spark, path, "U").collect()] == [1]


def test_saved_model_scores_as_the_fit_does(spark):
    df = spark.createDataFrame([(float(i), float(i % 7), 2.0 * i - (i % 7)) for i in range(60)], "a double, b double, label double")
    m = models.fit_regressor(df, ["a", "b"], "label", "gbt", maxIter=3, maxDepth=3)
    path = shared_dir(spark, "model")
    models.save_model(m, path, ["a", "b"])
    want = [r.prediction for r in models.predict(m, df).orderBy("a").collect()]
    assert [r.prediction for r in models.predict_saved(spark, path, df).orderBy("a").collect()] == want
    one = models.predict_saved(spark, path, models.new_rows(spark, path, [(3, 3), (8, 1)])).orderBy("a").collect()
    assert math.isclose(one[0].prediction, want[3]) and math.isclose(one[1].prediction, want[8])
    with pytest.raises(ValueError, match="missing: b"):
        models.predict_saved(spark, path, df.drop("b"))
    with pytest.raises(ValueError, match="needs 2 values a row .a, b., not 3"):
        models.new_rows(spark, path, [(1, 2, 3)])
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        models.save_model(m, path, ["a", "b"])


def test_group_reduce_calls_do_not_grow_with_the_keys(spark):
    calls = spark.sparkContext.accumulator(0)
    df = spark.range(0, 40_000, 1, 4).select(F.when(F.col("id") % 7 > 0, (F.col("id") % 20_000) + 2**60).alias("k"), F.col("id").alias("x"))

    def pair(a, b):
        calls.add(1)
        return a[0] + b[0], max(a[1], b[1])

    def reduced(keys_held):
        return userfuncs.group_reduce(df, "k", ["x"], zero=lambda: (0, -1), update=lambda s, r: (s[0] + 1, max(s[1], r[0])), merge=pair,
                                      finish=lambda s: s, result="n long, last long", keys_held=keys_held)

    got = reduced(100_000)
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("last"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert sorted(map(tuple, reduced(50).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    # groups are buckets of keys
    grouped = [x for x in plan_of(got).splitlines() if x.startswith("Arguments") and "hashpartitioning" in x]
    assert grouped and all("_bucket" in x and "hashpartitioning(k" not in x for x in grouped)
    assert calls.value > 0


def test_generated_rows_travel_in_batches_of_many_values(spark):
    df = spark.range(0, 30_000, 1, 2).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("x"))
    got = userfuncs.generate_rows(df, "x", lambda v: None if v is None else ((v, str(i)) for i in range(v % 3)), "x long, at string")
    want = df.where("x is not null").selectExpr("x", "explode(sequence(0, 2)) as i").where("i < x % 3").selectExpr("x", "cast(i as string) as at")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert "MapInArrow" in plan_of(got) and "ArrowEvalPythonUDTF" not in plan_of(got)
    assert userfuncs.generate_rows(df, "x", lambda v: ["a"], "letter string").count() == 30_000
    # one value of a million rows leaves in bounded batches
    assert userfuncs.generate_rows(df.limit(1), "x", lambda v: ((i,) for i in range(1_000_000)), "i long").count() == 1_000_000


def _rows_fitted(monkeypatch, kind):
    """Rows that each fit of an estimator reads, in a list that grows."""
    seen, fit = [], kind._fit

    def counted(self, df):
        seen.append(df.count())
        return fit(self, df)

    monkeypatch.setattr(kind, "_fit", counted)
    return seen


def _regression_rows(spark, few: bool):
    r = spark.range(0, 6000, 1, 4)
    a, b = ((F.col("id") * 7919 % 13).cast("double"), (F.col("id") * 104729 % 9) / 8) if few else (F.rand(3), F.randn(4))
    return r.select(a.alias("a"), b.alias("b"), "id").select("id", "a", "b", (F.col("a") * 3 + F.col("b") ** 2 + F.randn(5)).alias("y")).localCheckpoint()


@pytest.mark.parametrize("kind", ["decision_tree", "gbt"])
def test_trees_are_fitted_on_cells(spark, monkeypatch, kind):
    params = {"maxBins": 16, "maxDepth": 4, **({"maxIter": 4} if kind == "gbt" else {})}
    estimator = models.make_regressor(kind, 7, **params)
    df = _regression_rows(spark, few=True)
    on_rows = models.model_stages(["a", "b"], "y", models.make_regressor(kind, 7, **params), scale=True).fit(df)
    seen = _rows_fitted(monkeypatch, type(estimator))
    on_cells = models.fit_regressor(df, ["a", "b"], "y", kind, 7, scale=True, **params)
    assert seen == [13 * 9]
    got, want = ([r.prediction for r in models.predict(m, df).orderBy("id").collect()] for m in (on_cells, on_rows))
    assert got == pytest.approx(want, rel=1e-9)
    # features without repeats: quantile bins, and nearly the errors of the fit on rows
    df = _regression_rows(spark, few=False)
    on_rows = models.model_stages(["a", "b"], "y", models.make_regressor(kind, 7, **params)).fit(df)
    seen.clear()
    on_cells = models.fit_regressor(df, ["a", "b"], "y", kind, 7, **params)
    assert len(seen) == 1 and seen[0] <= 32 * 32
    mse = [models.predict(m, df).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0] for m in (on_cells, on_rows)]
    assert mse[0] == pytest.approx(mse[1], rel=0.03)
    # a parameter that counts rows keeps the rows
    seen.clear()
    models.fit_regressor(df, ["a", "b"], "y", kind, 7, minInstancesPerNode=50, **params)
    assert seen == [6000]


def test_grid_search_reads_cells(spark, monkeypatch):
    df = _regression_rows(spark, few=True)
    grid = {"maxDepth": [2, 3], "maxIter": [1, 3]}
    search = dict(folds=2, seed=7, params={"maxBins": 16})
    seen = _rows_fitted(monkeypatch, type(models.make_regressor("gbt")))
    on_cells = tuning.grid_search_cv(df, ["a", "b"], "y", ["id"], grid, **search)
    assert len(seen) == 5 and max(seen) <= 2 * 13 * 9  # two folds a depth, and the refit
    monkeypatch.setattr(tuning, "fits_cells", lambda *a: False)
    on_rows = tuning.grid_search_cv(df, ["a", "b"], "y", ["id"], grid, **search)
    assert max(seen) == 6000 and on_cells.best == on_rows.best
    got, want = ([r.cv_rmse for r in x.results.orderBy("maxDepth", "maxIter").collect()] for x in (on_cells, on_rows))
    assert got == pytest.approx(want, rel=1e-9)


def test_a_null_label_is_refused_as_before(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None), (2.0, 3.0)], "a double, y double")
    with pytest.raises(Exception, match="(?i)label"):
        models.fit_regressor(df, ["a"], "y", "gbt", maxIter=2)
