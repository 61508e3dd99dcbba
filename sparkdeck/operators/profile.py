"""Data profiling.

Every profile is one aggregate pass: per-column conditional counts,
moments and quantile sketches are all expressions of a single ``agg``, so
each task combines its rows locally and only one partial row per task is
shuffled.  Long ("one row per column") outputs are unpivoted in the same
projection with ``inline``.

Quantiles: ``relative_error=0`` gives the exact order statistic by bounded
passes (``exact_quantiles``); a positive error, as of ``approxQuantile``, uses
``percentile_approx`` (a mergeable sketch of about 1/error entries), meant for
the coarse errors of the scripts (0.05, 0.01).  Quantiles of groups that are too
many for the driver come from a distributed ranking (``group_quantiles``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from sparkdeck.operators.ranking import running_totals
from sparkdeck.session import cut_lineage


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def accuracy_of(relative_error: float) -> int:
    """``percentile_approx`` accuracy for an ``approxQuantile`` relative error."""
    if not 0 < relative_error <= 1:
        raise ValueError("a relative error in (0, 1]; 0 is exact_quantiles")
    return max(1, int(round(1.0 / relative_error)))


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (DoubleType, FloatType))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, one row, one column per input column."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count(F.when(_q(c).isNull(), 1)).alias(c) for c in cols])


def sentinel_counts(df: DataFrame, sentinel: str = "?", cols: Sequence[str] | None = None) -> DataFrame:
    """NULL or the sentinel text per column (sentinel tested on strings)."""
    cols = list(cols or df.columns)

    def missing(c: str) -> Column:
        if isinstance(df.schema[c].dataType, StringType):
            return _q(c).isNull() | (_q(c) == sentinel)
        return _q(c).isNull()

    return df.agg(*[F.count(F.when(missing(c), 1)).alias(c) for c in cols])


def null_nan_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL or NaN per column; ``isnan`` only on float columns (on text
    it would raise under ANSI)."""
    cols = list(cols or df.columns)

    def missing(c: str) -> Column:
        return (_q(c).isNull() | F.isnan(_q(c))) if _is_float(df, c) else _q(c).isNull()

    return df.agg(*[F.count(F.when(missing(c), 1)).alias(c) for c in cols])


def before_after_counts(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a filter step, one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_before"), F.count_if(F.coalesce(keep, F.lit(False))).alias("n_after"))


def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Typed summary, one row per column: count, mean, sample stddev,
    min, max (``df.summary`` would return strings)."""
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"sd{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
                              F.col(f"mean{i}").alias("mean"), F.col(f"sd{i}").alias("stddev"),
                              F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"))
                     for i, c in enumerate(cols)])
    return df.agg(*aggs).select(F.inline(rows))


#: Bins of a pass, and the most values of one interval that are listed.
QUANTILE_BINS, QUANTILE_LISTED = 1024, 2048


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    group: str | None = None) -> dict[tuple, float]:
    """Exact order statistics: (group value or None, column, prob) -> the
    smallest value with at least ``prob`` of the non-missing values at or
    below it.  NULL and NaN are ignored; a column without values has no entry.

    Each pass cuts every interval that still holds a wanted rank into
    ``QUANTILE_BINS`` equal bins and counts them, with their least and greatest
    value, in one distributed aggregation; the bin with the rank becomes the
    next interval.  An interval of few values is listed instead.  Every task
    sends at most one row a bin, however many rows it has; the driver holds one
    interval a wanted rank.  The groups are meant to be few (categories)."""
    spark = df.sparkSession
    g = F.col(f"`{group}`") if group else F.lit(None).cast("string")
    x = [_q(c).cast("double") for c in cols]
    cells = F.array(*[F.struct(F.lit(i).alias("c"), v.alias("x")) for i, v in enumerate(x)])
    long = (df.select(g.cast("string").alias("g"), g.isNull().alias("gn"), F.inline(cells))
            .where(F.col("x").isNotNull() & ~F.isnan("x")).withColumn("x", F.col("x") + F.lit(0.0)))
    finite = F.when(F.abs("x") < math.inf, F.col("x"))
    first = long.groupBy("g", "gn", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(finite).alias("lo"), F.max(finite).alias("hi"),
        F.count_if(F.col("x") == -math.inf).alias("below"), F.count_if(F.col("x") == math.inf).alias("above")).collect()
    done: dict[tuple, float] = {}
    # wanted rank within an interval: (group, column, prob) -> (lo, hi, rows in it, rank in it)
    open_: dict[tuple, tuple] = {}
    for r in first:
        for p in probs:
            k, rank = (r["g"], r["gn"], r["c"], p), max(1, math.ceil(p * r["n"] - 1e-12))
            if rank <= r["below"]:
                done[k] = -math.inf
            elif rank > r["n"] - r["above"]:
                done[k] = math.inf
            else:
                open_[k] = (r["lo"], r["hi"], r["n"] - r["below"] - r["above"], rank - r["below"])
    while open_:
        for k in [k for k, (lo, hi, _, _) in open_.items() if lo == hi]:
            done[k] = open_.pop(k)[0]
        spans = sorted({(k[0] or "", k[0], k[1], k[2], *v[:3]) for k, v in open_.items()})
        if not spans:
            break
        ids = {s[1:]: i for i, s in enumerate(spans)}
        table = spark.createDataFrame([(i, *k[:5], k[5] <= QUANTILE_LISTED) for k, i in ids.items()],
                                      "i int, sg string, sn boolean, sc int, lo double, hi double, listed boolean")
        # one row an open interval: at most one for each wanted rank
        at = long.join(F.broadcast(table), F.col("g").eqNullSafe(F.col("sg")) & (F.col("gn") == F.col("sn")) & (F.col("c") == F.col("sc"))
                       & (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))
        # halves before the difference: the range itself may exceed a double
        share = (F.col("x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        cell = F.when(F.col("listed"), F.col("x")).otherwise(F.least(F.floor(share * QUANTILE_BINS), F.lit(QUANTILE_BINS - 1)).cast("double"))
        counted = at.groupBy("i", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
        bins: dict[int, list] = {}
        for r in counted:
            bins.setdefault(r["i"], []).append((r["lo"], r["hi"], r["n"]))
        for k, (lo, hi, n, rank) in list(open_.items()):
            for b_lo, b_hi, b_n in sorted(bins[ids[(k[0], k[1], k[2], lo, hi, n)]]):
                if rank <= b_n:
                    open_[k] = (b_lo, b_hi, b_n, rank)
                    break
                rank -= b_n
    return {(g_, cols[c], p): v for (g_, _, c, p), v in done.items()}


#: Groups whose intervals the driver may hold; more are ranked without it.
GROUPS_HELD = 1_000


def group_quantiles(df: DataFrame, value: str, group: str, probs: Sequence[float]) -> tuple[DataFrame, DataFrame]:
    """Exact quantiles of any number of groups, of any size: (cells, quartiles).

    ``cells`` has a row for each group and distinct value: _g, _x, _n rows.  The
    cells are range-partitioned by group and value, and running totals give each
    the ranks it covers; a group's first total and size give the wanted ranks.
    ``quartiles`` has a row a group: _g, n, and q0, q1, ... for ``probs``.  No
    group meets in one task, and nothing reaches the driver."""
    x = F.col(value).cast("double")
    clean = df.select(F.col(group).alias("_g"), (x + F.lit(0.0)).alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    cells = clean.groupBy("_g", "_x").agg(F.count(F.lit(1)).alias("_n"))
    totals = cut_lineage(running_totals(cells, [F.asc_nulls_first("_g"), F.asc("_x")], "_n", "_upto"))
    groups = totals.groupBy("_g").agg(F.sum("_n").alias("n"), F.min(F.col("_upto") - F.col("_n")).alias("_before"))
    groups = groups.select(F.col("_g").alias("_k"), "n", "_before")
    ranked = totals.join(groups, F.col("_g").eqNullSafe(F.col("_k")))
    rank = [F.col("_before") + F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.col("n") - 1e-12)) for p in probs]
    covers = [(F.col("_upto") - F.col("_n") < r) & (r <= F.col("_upto")) for r in rank]
    found = ranked.groupBy("_g", "n").agg(*[F.max(F.when(c, F.col("_x"))).alias(f"q{i}") for i, c in enumerate(covers)])
    return totals.select("_g", "_x", "_n"), found


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              relative_error: float = 0.01) -> DataFrame:
    """Quantiles of several columns: (column, prob, value).  NULL and NaN
    are ignored, as ``approxQuantile`` does; 0 as the error is exact."""
    if relative_error == 0:
        found = exact_quantiles(df, cols, probs)
        rows = [(c, float(p), found.get((None, c, p))) for c in cols for p in probs]
        return df.sparkSession.createDataFrame(rows, "column_name string, prob double, value double")
    acc = accuracy_of(relative_error)
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs.append(F.percentile_approx(x, list(probs), acc).alias(f"q{i}"))
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(float(p)).alias("prob"),
                              F.col(f"q{i}")[j].alias("value"))
                     for i, c in enumerate(cols) for j, p in enumerate(probs)])
    return df.agg(*aggs).select(F.inline(rows))


def quantile_values(df: DataFrame, col: str, probs: Sequence[float], relative_error: float) -> list[float | None]:
    """Driver-side scalars (as ``approxQuantile`` returns), in order of ``probs``."""
    found = {r["prob"]: r["value"] for r in quantiles(df, [col], probs, relative_error).collect()}
    return [found[float(p)] for p in probs]


def confusion_matrix(df: DataFrame, label: str, prediction: str, values: Sequence) -> DataFrame:
    """Counts per (label, prediction) pivoted to one column per
    prediction value, missing cells 0; predictions not listed, or null, count
    under ``pred_other``.  ``values`` are passed explicitly, so the pivot needs
    no extra distinct-values job."""
    p = F.col(prediction)
    listed = [F.count_if(p == v).alias(f"pred_{v}") for v in values]
    other = F.count_if(~F.coalesce(p.isin(*values), F.lit(False))).alias("pred_other")
    return df.groupBy(label).agg(*listed, other)


def boxplot_stats(df: DataFrame, value: str, group: str | None = None,
                  relative_error: float = 0.0, whisker: float = 1.5, groups_held: int = GROUPS_HELD) -> DataFrame:
    """H12 (the box plot, as numbers): per group n, min, q1, median, q3, max,
    the fences ``q1 - w*IQR`` / ``q3 + w*IQR`` and the count of points
    outside them.  The quartiles of the groups are found first; one aggregation
    then counts against the fences, given to the tasks as one row a group.  More
    than ``groups_held`` groups (by a distinct-count sketch) go through
    ``group_quantiles``, which holds nothing on the driver."""
    x = F.col(value).cast("double")
    clean = df.select((F.col(group) if group else F.lit("all")).alias("_g"), x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    probs = [0.25, 0.5, 0.75]
    if relative_error == 0 and group and _many_groups(clean, groups_held):
        return _boxplot_of_many(df, value, group, whisker)
    if relative_error == 0:
        found = exact_quantiles(clean, ["_x"], probs, "_g")
        keys = {k[0] for k in found}
        rows = [(k, *[found[(k, "_x", p)] for p in probs]) for k in keys]
    else:
        q = clean.groupBy("_g").agg(F.percentile_approx("_x", probs, accuracy_of(relative_error)).alias("q")).collect()
        rows = [(None if r["_g"] is None else str(r["_g"]), *r["q"]) for r in q]
    box = df.sparkSession.createDataFrame(rows, "_k string, q1 double, median double, q3 double")
    iqr = F.col("q3") - F.col("q1")
    box = box.withColumn("lower_fence", F.col("q1") - whisker * iqr).withColumn("upper_fence", F.col("q3") + whisker * iqr)
    j = clean.join(box, F.col("_g").cast("string").eqNullSafe(F.col("_k")))
    fixed = ["q1", "median", "q3", "lower_fence", "upper_fence"]
    out = F.count_if((F.col("_x") < F.col("lower_fence")) | (F.col("_x") > F.col("upper_fence"))).alias("n_outliers")
    res = j.groupBy("_g", *fixed).agg(F.count("_x").alias("n"), F.min("_x").alias("min"), F.max("_x").alias("max"), out)
    shown = ["n", "min", "q1", "median", "q3", "max", "lower_fence", "upper_fence", "n_outliers"]
    return res.select(*([F.col("_g").alias(group)] if group else []), *shown)


def _many_groups(clean: DataFrame, held: int) -> bool:
    return clean.agg(F.approx_count_distinct("_g")).first()[0] > held


def _boxplot_of_many(df: DataFrame, value: str, group: str, whisker: float) -> DataFrame:
    cells, box = group_quantiles(df, value, group, [0.25, 0.5, 0.75])
    iqr = F.col("q2") - F.col("q0")
    box = box.select(F.col("_g").alias("_k"), "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"),
                     (F.col("q0") - whisker * iqr).alias("lower_fence"), (F.col("q2") + whisker * iqr).alias("upper_fence"))
    j = cells.join(box, F.col("_g").eqNullSafe(F.col("_k")))
    out = (F.col("_x") < F.col("lower_fence")) | (F.col("_x") > F.col("upper_fence"))
    fixed = ["n", "q1", "median", "q3", "lower_fence", "upper_fence"]
    res = j.groupBy("_g", *fixed).agg(F.min("_x").alias("min"), F.max("_x").alias("max"), F.sum(F.when(out, F.col("_n")).otherwise(0)).alias("n_outliers"))
    return res.select(F.col("_g").alias(group), "n", "min", "q1", "median", "q3", "max", "lower_fence", "upper_fence", "n_outliers")
