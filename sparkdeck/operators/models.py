"""Model fits (K1-K11) on MLlib.

Every fit is an MLlib estimator over a DataFrame: the statistics (normal
equations, tree split histograms, gradient sums) are computed by
distributed aggregation, and only the model - a bounded object - lives on
the driver.  Results are returned as DataFrames: coefficients one row per
term, predictions as a projection of the input.

Inputs that a fit scans repeatedly (iterative solvers, forests per level) are
persisted once (``persist_for_reuse``) and released after the fit.

A tree sees a row only by its bins.  Single and boosted trees of squared error
are therefore fitted on cells (``tree_cells``): one weighted row, with the mean
label, for all rows that no split can part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from sparkdeck.session import ensure_checkpoint_dir
from sparkdeck.sources.sinks import persist_for_reuse


def model_stages(features: Sequence[str], label: str, estimator, scale: bool = False,
                 with_mean: bool = False) -> Pipeline:
    """K1: assemble (-> optionally standard-scale, centred if asked) -> estimator."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="features_raw" if scale else "features")]
    if scale:
        stages.append(StandardScaler(inputCol="features_raw", outputCol="features", withMean=with_mean))
    estimator.setFeaturesCol("features").setLabelCol(label)
    return Pipeline(stages=stages + [estimator])


def make_regressor(kind: str, seed: int = 42, **params):
    """K2/K4/K5/K6 by name: 'linear', 'decision_tree', 'random_forest', 'gbt'."""
    if kind == "linear":
        return LinearRegression(**params)
    if kind == "decision_tree":
        return DecisionTreeRegressor(seed=seed, **params)
    if kind == "random_forest":
        return RandomForestRegressor(seed=seed, **params)
    if kind == "gbt":
        return GBTRegressor(seed=seed, **params)
    raise ValueError(kind)


def fit_persisted(train: DataFrame, stages: Pipeline) -> PipelineModel:
    """Fit on a persisted copy; iterative estimators (GBT) checkpoint their
    lineage every ``checkpointInterval`` rounds into the shared folder."""
    ensure_checkpoint_dir(train.sparkSession)
    cached = persist_for_reuse(train)
    try:
        return stages.fit(cached)
    finally:
        cached.unpersist()


#: Columns of a cell: its rows, and the variance of their labels.
CELL_ROWS, CELL_SPREAD = "_cell_rows", "_cell_spread"
#: Cells of one partition.
CELLS_A_TASK = 50_000


def fits_cells(estimator, features: Sequence[str], df: DataFrame) -> bool:
    """Whether a fit on cells is the fit on rows: trees that use every row once,
    by squared error, with no figure that counts or spreads rows in a node."""
    if not isinstance(estimator, (DecisionTreeRegressor, GBTRegressor)) or estimator.getMinInstancesPerNode() != 1:
        return False
    if isinstance(estimator, GBTRegressor) and (estimator.getLossType() != "squared" or estimator.getSubsamplingRate() != 1.0):
        return False
    if any(estimator.hasParam(p) and estimator.isSet(p) for p in ("weightCol", "varianceCol", "validationIndicatorCol")):
        return False
    return all(isinstance(df.schema[f].dataType, (NumericType, BooleanType)) for f in features)


def bin_features(df: DataFrame, features: Sequence[str], max_bins: int) -> tuple[list[Bucketizer], list[str]]:
    """(stages, columns): features of more than ``2 * max_bins`` values become
    the number of their quantile bin, of ``2 * max_bins``; a value that fills a
    bin has one of its own.  The estimator chooses its ``max_bins`` among them.
    Other features, nominal ones too, stay as they are."""
    most = 2 * max_bins
    n = df.agg(*(F.approx_count_distinct(f).alias(f"n{i}") for i, f in enumerate(features))).first()
    wide = [f for i, f in enumerate(features) if n[i] > most and "ml_attr" not in df.schema[f].metadata]
    if not wide:
        return [], list(features)
    splits = []
    for found in df.approxQuantile(wide, [i / most for i in range(1, most)], 0.1 / most):
        heavy = {math.nextafter(a, math.inf) for a, b in zip(found, found[1:]) if a == b}
        splits.append([-math.inf, *sorted({x for x in {*found, *heavy} if math.isfinite(x)}), math.inf])
    binned = {f: f"{f}_bin" for f in wide}
    stage = Bucketizer(inputCols=wide, outputCols=list(binned.values()), splitsArray=splits, handleInvalid="error")
    return [stage], [binned.get(f, f) for f in features]


def apply_bins(bins: Sequence[Bucketizer], df: DataFrame) -> DataFrame:
    """Rows with binned features, as numbers in order (a plain bucketizer marks
    them as nominal)."""
    for b in bins:
        df = b.transform(df).withColumns({c: F.col(c) + 0.0 for c in b.getOutputCols()})
    return df


def tree_cells(df: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per combination of feature values (and ``by``): the mean label,
    ``CELL_ROWS`` and ``CELL_SPREAD``, persisted in few partitions.  A label that
    is null in one row is null in its cell, as the fit refuses it.  At most as
    many cells as rows, and with binned features a number that does not grow."""
    y = F.col(label).cast("double")
    cells = df.groupBy(*features, *by).agg(F.count(F.lit(1)).cast("double").alias(CELL_ROWS), F.var_pop(y).alias(CELL_SPREAD),
                                           F.when(F.count(y) == F.count(F.lit(1)), F.avg(y)).alias(label))
    whole = persist_for_reuse(cells)
    try:
        tasks = min(df.sparkSession.sparkContext.defaultParallelism, whole.count() // CELLS_A_TASK + 1)
        few = persist_for_reuse(whole.coalesce(tasks))
        few.count()
    finally:
        whole.unpersist()
    return few


def fit_prepared(prepared: PipelineModel, estimator, cells: DataFrame) -> PipelineModel:
    """The pipeline of fitted stages with the estimator fitted on cells."""
    return PipelineModel([*prepared.stages, estimator.setWeightCol(CELL_ROWS).fit(PipelineModel(_after_bins(prepared)).transform(cells))])


def _after_bins(prepared: PipelineModel) -> list:
    """The stages for cells, whose features are binned."""
    return [s for s in prepared.stages if not isinstance(s, Bucketizer)]


def fit_model(train: DataFrame, features: Sequence[str], label: str, estimator, scale: bool = False,
              with_mean: bool = False) -> PipelineModel:
    """Assemble (-> scale) -> estimator, fitted on rows or, where that is the
    same fit, on cells.  Scaling is of the rows."""
    if not fits_cells(estimator, features, train):
        return model_stages(features, label, estimator, scale, with_mean).fit(train)
    ensure_checkpoint_dir(train.sparkSession)
    bins, columns = bin_features(train, features, estimator.getMaxBins())
    *before, estimator = model_stages(columns, label, estimator, scale, with_mean).getStages()
    prepared = Pipeline(stages=[*bins, *before]).fit(train)
    cells = tree_cells(apply_bins(bins, train), columns, label)
    try:
        return fit_prepared(prepared, estimator, cells)
    finally:
        cells.unpersist()


def fit_regressor(train: DataFrame, features: Sequence[str], label: str, kind: str = "linear",
                  seed: int = 42, scale: bool = False, with_mean: bool = False, **params) -> PipelineModel:
    """A linear fit reads its rows once or a few times and keeps its own
    statistics, single and boosted trees read them for their cells; a forest
    reads them once per level, so they are persisted (label and features only)."""
    estimator = make_regressor(kind, seed, **params)
    train = train.select(label, *features)
    if kind != "linear" and not fits_cells(estimator, features, train):
        return fit_persisted(train, model_stages(features, label, estimator, scale, with_mean))
    return fit_model(train, features, label, estimator, scale, with_mean)


def linear_terms(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """K9: (term, value): the intercept and one coefficient per feature."""
    lm = model.stages[-1]
    rows = [("intercept", float(lm.intercept))] + [(f, float(c)) for f, c in zip(features, lm.coefficients)]
    return spark.createDataFrame(rows, "term string, value double")


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch prediction (a projection of ``df``)."""
    return model.transform(df)


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, family: str = "auto",
                 scale: bool = False, **params) -> PipelineModel:
    """K7/K8: binary or multinomial logistic regression."""
    lr = LogisticRegression(family=family, **params)
    return fit_persisted(train.select(label, *features), model_stages(features, label, lr, scale))


def logistic_terms(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """K9 for a binary logistic model: intercept and coefficients."""
    lr = model.stages[-1]
    rows = [("intercept", float(lr.intercept))] + [(f, float(c)) for f, c in zip(features, lr.coefficients)]
    return spark.createDataFrame(rows, "term string, value double")


def positive_probability(df: DataFrame, prob_col: str = "probability") -> DataFrame:
    """Probability of class 1 as a plain double column ``p1``."""
    from pyspark.ml.functions import vector_to_array

    return df.withColumn("p1", vector_to_array(F.col(prob_col))[1])


#: Layout of a saved model's folder.
SAVED_VERSION = 1


def save_model(model: PipelineModel, path: str, features: Sequence[str]) -> None:
    """A fitted pipeline, with the columns it was fitted on in their
    order, in a folder that other jobs can read."""
    spark = SparkSession.active()
    model.write().save(f"{path}/model")
    spark.createDataFrame([(SAVED_VERSION, list(features))], "version int, features array<string>").write.json(f"{path}/columns")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str]]:
    """(fitted pipeline, its columns)."""
    saved = spark.read.schema("version int, features array<string>").json(f"{path}/columns").first()
    if saved["version"] != SAVED_VERSION:
        raise ValueError(f"{path} holds a model of layout {saved['version']}, not {SAVED_VERSION}")
    return PipelineModel.load(f"{path}/model"), list(saved["features"])


def predict_saved(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """Predictions of a saved model; an error names the columns that ``df`` lacks."""
    model, features = load_model(spark, path)
    if missing := [f for f in features if f not in df.columns]:
        raise ValueError(f"the model needs {len(features)} columns ({', '.join(features)}); missing: {', '.join(missing)}")
    return predict(model, df)


def new_rows(spark: SparkSession, path: str, rows: Sequence[Sequence[float]]) -> DataFrame:
    """Rows of plain values in the order of a saved model's columns."""
    _, features = load_model(spark, path)
    for r in rows:
        if len(r) != len(features):
            raise ValueError(f"the model needs {len(features)} values a row ({', '.join(features)}), not {len(r)}")
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], ", ".join(f"`{f}` double" for f in features))
