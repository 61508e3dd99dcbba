"""Model comparison and cross-validated grid search.

The training frame is persisted once for all fits.  Cross-validation folds
come from a stable hash of the row key, so they are disjoint, reproducible and
independent of partitioning; ``parallelism`` fits several parameter maps at once.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdeck.operators.evaluate import regression_metrics
from sparkdeck.operators.features import stable_bucket
from sparkdeck.operators.models import (
    CELL_ROWS,
    CELL_SPREAD,
    apply_bins,
    bin_features,
    fit_model,
    fit_prepared,
    fits_cells,
    make_regressor,
    model_stages,
    tree_cells,
)
from sparkdeck.session import ensure_checkpoint_dir
from sparkdeck.sources.sinks import persist_for_reuse


#: The search's full grid.
FULL_GRID = {"maxDepth": [3, 5, 7], "maxIter": [10, 20, 30], "stepSize": [0.05, 0.1]}


def model_compare(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                  kinds: Sequence[str] = ("linear", "decision_tree", "random_forest", "gbt"),
                  seed: int = 42, scale: bool = True, parallelism: int = 4,
                  params: Mapping[str, Mapping] | None = None) -> DataFrame:
    """Fit each regressor, score the test rows; one row per model with
    RMSE, R2 and ``is_best`` (lowest RMSE, ties by model order).  ``params``:
    parameters of an estimator by its name.

    Up to ``parallelism`` fits run at once as concurrent Spark jobs (each
    fit is itself distributed); both frames are persisted once for all."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    tr, te = (persist_for_reuse(df.select(label, *features)) for df in (train, test))

    def fit_one(order_kind):
        order, kind = order_kind
        model = fit_model(tr, features, label, make_regressor(kind, seed, **(params or {}).get(kind, {})), scale)
        m = regression_metrics(model.transform(te), label).collect()[0]  # one row per model
        return kind, order, m["rmse"], m["r2"], int(m["n"])  # NULL figures without test rows

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            rows = list(pool.map(fit_one, enumerate(kinds)))
    finally:
        tr.unpersist()
        te.unpersist()
    best = min(rows, key=lambda r: (math.inf if r[2] is None else r[2], r[1]))[0]
    return spark.createDataFrame([(k, rmse, r2, n, k == best) for k, _, rmse, r2, n in rows],
                                 "model string, rmse double, r2 double, n_test long, is_best boolean")


@dataclass
class GridSearch:
    """Cross-validated maps (``results``: the grid columns, cv_rmse, is_best),
    the best map, and the model refitted on all training rows."""

    results: DataFrame
    best: dict
    model: PipelineModel

    def evaluate(self, test: DataFrame, label: str) -> DataFrame:
        """RMSE, R2 and MAE of the refitted model on test rows."""
        return regression_metrics(self.model.transform(test), label)


def grid_search_cv(train: DataFrame, features: Sequence[str], label: str, key_cols: Sequence[str],
                   grid: Mapping[str, Sequence], folds: int = 3, seed: int = 42, parallelism: int = 4,
                   scale: bool = True, params: Mapping | None = None) -> GridSearch:
    """GBT pipeline (assemble -> scale -> GBT) over a parameter grid
    with k-fold CV on RMSE, then a refit of the best map on all training rows.
    ``params`` are set in every fit.

    The first trees of a boosted model do not depend on how many follow, so
    maps that differ in ``maxIter`` alone share one fit per fold with the
    largest value; the errors of its prefixes (``evaluateEachIteration``) are
    those of the smaller values.

    Where the fits allow it, all read the cells of the training rows, counted
    once per fold; bins are those of all training rows, scaling that of a fit's
    own rows, and an error on cells plus the spread inside them is that on rows."""
    names, fixed = list(grid), dict(params or {})
    maps = [dict(zip(names, v, strict=True)) for v in product(*grid.values())]
    default = make_regressor("gbt", seed, **fixed).getMaxIter()
    fits: dict[tuple, list[int]] = {}
    for i, m in enumerate(maps):
        fits.setdefault(tuple((n, v) for n, v in m.items() if n != "maxIter"), []).append(i)
    ensure_checkpoint_dir(train.sparkSession)
    data = persist_for_reuse(train.select(label, *features, stable_bucket(key_cols, seed, folds).alias("_fold")))
    sums = [0.0] * len(maps)

    def estimator(**varied):
        return make_regressor("gbt", seed, **{**fixed, **varied})

    def part(df, fold):
        return df if fold is None else df.where(F.col("_fold") != fold)

    cells = data
    try:
        tried = [estimator(**m) for m in maps]
        by_cells = all(fits_cells(e, features, data) for e in tried)
        bins, columns = bin_features(data, features, max(e.getMaxBins() for e in tried)) if by_cells else ([], list(features))
        binned = apply_bins(bins, data)
        cells = tree_cells(binned, columns, label, ["_fold"]) if by_cells else (
            data.withColumns({CELL_ROWS: F.lit(1.0), CELL_SPREAD: F.lit(0.0)}))
        total = F.sum(CELL_ROWS)
        inside = {r["_fold"]: r["inside"] for r in cells.groupBy("_fold").agg(
            (F.sum(F.col(CELL_SPREAD) * F.col(CELL_ROWS)) / total).alias("inside")).collect()}  # one row a fold
        before = model_stages(columns, label, estimator(), scale).getStages()[:-1]
        prepared = {fold: Pipeline(stages=before).fit(part(binned, fold)) for fold in (*range(folds), None)}

        def fit(varied, fold):
            *_, e = model_stages(columns, label, estimator(**varied), scale).getStages()
            return fit_prepared(prepared[fold], e, part(cells, fold))

        def fold_errors(task):
            (varied, ids), fold = task
            longest = max(maps[i].get("maxIter", default) for i in ids)
            fitted = fit({"maxIter": longest, **dict(varied)}, fold)
            held = prepared[fold].transform(cells.where(F.col("_fold") == fold))
            each = fitted.stages[-1].evaluateEachIteration(held, "squared")
            return [(i, math.sqrt(each[maps[i].get("maxIter", default) - 1] + inside[fold])) for i in ids]

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            for errors in pool.map(fold_errors, product(fits.items(), range(folds))):
                for i, rmse in errors:
                    sums[i] += rmse / folds
        best = min(range(len(maps)), key=lambda i: (sums[i], i))
        model = PipelineModel([*bins, *fit(maps[best], None).stages])
    finally:
        cells.unpersist()
        data.unpersist()
    rows = [(*(float(m[n]) for n in names), sums[i], i == best) for i, m in enumerate(maps)]
    schema = ", ".join(f"{n} double" for n in names) + ", cv_rmse double, is_best boolean"
    return GridSearch(train.sparkSession.createDataFrame(rows, schema), maps[best], model)


def with_split(df: DataFrame, key_cols: Sequence[str], train_share: float = 0.7, seed: int = 42):
    """Train/test frames from the stable split."""
    from sparkdeck.operators.features import stable_split

    s = stable_split(df, key_cols, [train_share, 1 - train_share], seed, ["train", "test"])
    return (s.filter(F.col("split") == "train").drop("bucket", "split"),
            s.filter(F.col("split") == "test").drop("bucket", "split"))
