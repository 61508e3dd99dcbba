"""Evaluation metrics as DataFrames.

RMSE, R2 and accuracy are one aggregate pass each (partial sums per task).
AUC uses MLlib's exact curve (``numBins=0``): a distributed sort of the
scores with per-partition cumulative counts; only the area (a scalar)
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """RMSE = sqrt(mean((y - p)^2)); R2 = 1 - SSE / SST with SST around the
    mean of y on the evaluated rows; also MAE and n.  No rows give NULL
    figures, a constant label a NULL R2."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    g = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum((y - p) * (y - p)).alias("_sse"),
                            F.var_pop(y).alias("_vy"), F.avg(F.abs(y - p)).alias("mae"))
    return g.select(*by, "n", F.sqrt(F.try_divide(F.col("_sse"), F.col("n"))).alias("rmse"),
                    (1 - F.try_divide(F.col("_sse"), F.col("_vy") * F.col("n"))).alias("r2"), "mae")


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction",
             by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with prediction == label, per group."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def auc_roc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve with tied scores counted half (rank-sum AUC)."""
    ev = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, metricName="areaUnderROC",
                                       numBins=0)
    data = df.select(F.col(score).cast("double").alias(score), F.col(label).cast("double").alias(label))
    area = ev.evaluate(data)
    counts = data.agg(F.count(F.lit(1)).alias("n"), F.sum(label).cast("bigint").alias("n_pos"))
    return counts.select(F.lit(float(area)).alias("auc"), "n", "n_pos")
