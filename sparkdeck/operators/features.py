"""Feature preparation.

Estimators take ``fit_df`` (rows the statistics are learnt from) and
``apply_df`` (rows transformed); the scripts fitted on all rows, which is
``fit_df = apply_df``.  Fitting is a distributed aggregate (MLlib's
Summarizer / value counts / quantile passes); only bounded results reach
the driver: label lists of a categorical column of few values, a handful of scalars.
Transforms are narrow projections.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.ml.feature import (
    Imputer,
    MinMaxScaler,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdeck.functions import numeric as N
from sparkdeck.functions.encode import map_lookup
from sparkdeck.operators.profile import quantile_values
from sparkdeck.operators.ranking import row_numbers
from sparkdeck.operators.relational import columns_by_type


def impute_constant(df: DataFrame, value: str = "Unknown", cols: Sequence[str] | None = None) -> DataFrame:
    """NULL strings -> a constant (string columns only)."""
    return df.fillna(value, subset=list(cols or columns_by_type(df, "string")))


def replace_sentinel(df: DataFrame, sentinel: str = "?", value: str = "Unknown",
                     cols: Sequence[str] | None = None) -> DataFrame:
    """Whole-value replacement of a sentinel in string columns."""
    return df.replace(sentinel, value, subset=list(cols or columns_by_type(df, "string")))


def impute_mean(fit_df: DataFrame, apply_df: DataFrame, cols: Sequence[str],
                suffix: str = "_imputed", strategy: str = "mean") -> DataFrame:
    """NULL and NaN -> the column mean (or median) learnt on ``fit_df``.
    Inputs are cast to double first, so an integer column is not truncated."""
    cols = list(cols)
    as_double = lambda df: df.withColumns({c: F.col(c).cast("double") for c in cols})
    model = Imputer(strategy=strategy, inputCols=cols, outputCols=[c + suffix for c in cols]).fit(as_double(fit_df))
    return model.transform(as_double(apply_df))


#: Labels of a column that a model on the driver may hold; a column with more
#: is indexed by a distributed ranking.
LABELS_HELD = 50_000


def label_index(df: DataFrame, col: str, label: str = "label", index: str = "index") -> DataFrame:
    """(label, index) of every value of a column as text: the most frequent is
    0.0, ties by value.  Counted, sorted and numbered without the driver
    (``row_numbers``): any number of labels."""
    counts = df.select(F.col(col).cast("string").alias(label)).where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    return row_numbers(counts, [F.desc("_n"), F.asc(label)], "_row").select(label, (F.col("_row") - 1).cast("double").alias(index))


def _index_by_join(fit_df: DataFrame, apply_df: DataFrame, col: str, out: str, handle_invalid: str) -> DataFrame:
    """The index as a join with the labels (Spark broadcasts them if they are
    few, and splits a hot value of the rows otherwise)."""
    index = label_index(fit_df, col, "_label", out)
    joined = apply_df.join(index, F.col(col).cast("string") == F.col("_label"), "inner" if handle_invalid == "skip" else "left")
    if handle_invalid == "keep":
        missing = F.lit(float(index.count()))
    elif handle_invalid == "error":
        missing = F.raise_error(F.concat(F.lit(f"no index in {col} for "), F.coalesce(F.col(col).cast("string"), F.lit("NULL")))).cast("double")
    else:
        missing = F.lit(None).cast("double")
    return joined.select(*[F.col(f"`{c}`") for c in apply_df.columns], F.coalesce(F.col(out), missing).alias(out))


def string_index(fit_df: DataFrame, apply_df: DataFrame, cols: Sequence[str], suffix: str = "_idx",
                 handle_invalid: str = "keep", labels_held: int = LABELS_HELD) -> DataFrame:
    """Most frequent value -> 0, ties by value; with 'keep', NULL and
    unseen values -> index n.  Columns of up to about ``labels_held`` values
    (by a distinct-count sketch) go through one multi-column StringIndexer, a
    narrow projection; columns of more values are joined with ``label_index``,
    so that no list of labels reaches the driver."""
    cols = list(cols)
    many = _with_many_labels(fit_df, cols, labels_held)
    few = [c for c in cols if c not in many]
    out = apply_df
    if few:
        si = StringIndexer(inputCols=few, outputCols=[c + suffix for c in few], handleInvalid=handle_invalid,
                           stringOrderType="frequencyDesc")
        out = si.fit(fit_df).transform(out)
    for c in many:
        out = _index_by_join(fit_df, out, c, c + suffix, handle_invalid)
    return out.select(*[F.col(f"`{c}`") for c in apply_df.columns], *[c + suffix for c in cols]) if many else out


def _with_many_labels(df: DataFrame, cols: Sequence[str], held: int) -> list[str]:
    if not held:
        return list(cols)
    sizes = df.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if sizes[f"n{i}"] > held]


def one_hot_encode(fit_df: DataFrame, apply_df: DataFrame, idx_cols: Sequence[str], suffix: str = "_vec",
                   drop_last: bool = True, handle_invalid: str = "error") -> DataFrame:
    """One-hot vectors of index columns (last category dropped).  After
    a 'keep' StringIndexer the NULL/unseen index is the last category, so
    with ``drop_last`` it encodes as all zeros and the width is n."""
    idx_cols = list(idx_cols)
    enc = OneHotEncoder(inputCols=idx_cols, outputCols=[c + suffix for c in idx_cols], dropLast=drop_last,
                        handleInvalid=handle_invalid)
    return enc.fit(fit_df).transform(apply_df)


def ordinal_encode(df: DataFrame, col: str, mapping: Mapping, default: int = -1, out: str | None = None) -> DataFrame:
    """Ordinal codes from a fixed map, ``default`` for misses/NULL;
    one native map expression (pushdown and codegen stay intact)."""
    return df.withColumn(out or f"{col}_ord", map_lookup(col, mapping, default))


def ordinal_encode_udf(df: DataFrame, col: str, fn: Callable[[object], int], out: str | None = None) -> DataFrame:
    """Ordinal codes from an arbitrary Python function, vectorised as a
    pandas UDF (Arrow batches), for maps that are not a finite table.  ``fn``
    is shipped to the Python workers by value when it is a lambda or a
    closure; a module-level function must be importable on the workers."""

    @F.pandas_udf("int")
    def _apply(s: pd.Series) -> pd.Series:
        codes, values = pd.factorize(s, use_na_sentinel=False)  # fn once per distinct value
        coded = pd.Series([fn(None if pd.isna(v) else v) for v in values], dtype="int32")
        return pd.Series(coded.to_numpy()[codes], index=s.index)

    return df.withColumn(out or f"{col}_ord", _apply(F.col(col)))


def label_encode(fit_df: DataFrame, apply_df: DataFrame, col: str, out: str = "label",
                 labels_held: int = LABELS_HELD) -> DataFrame:
    """Target -> class index; rows with a NULL target are dropped first
    (they would otherwise form an extra class).  Targets of many values as in
    ``string_index``."""
    keep = lambda df: df.filter(F.col(col).isNotNull())
    if _with_many_labels(fit_df, [col], labels_held):
        return _index_by_join(keep(fit_df), keep(apply_df), col, out, "error")
    si = StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc")
    return si.fit(keep(fit_df)).transform(keep(apply_df))


def assemble_features(df: DataFrame, cols: Sequence[str], out: str = "features",
                      handle_invalid: str = "error") -> DataFrame:
    """VectorAssembler ('error' fails on NULL, as the default does)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)


def vector_columns(vec: str, names: Sequence[str], digits: int | None = None) -> list[Column]:
    """A vector column as one double column per component."""
    arr = vector_to_array(F.col(vec))
    return [(F.round(arr[i], digits) if digits is not None else arr[i]).alias(n) for i, n in enumerate(names)]


def vector_text(vec: str) -> Column:
    """A vector as ``'v0,v1,...'`` text (sinks cannot write vectors)."""
    return F.array_join(vector_to_array(F.col(vec)).cast("array<string>"), ",")


def iqr_bounds(df: DataFrame, col: str, relative_error: float = 0.05, whisker: float = 1.5) -> tuple[float, float]:
    """(lower, upper) = (Q1 - w*IQR, Q3 + w*IQR) from one quantile pass."""
    q1, q3 = quantile_values(df, col, [0.25, 0.75], relative_error)
    if q1 is None or q3 is None:  # no value: nothing lies inside or outside
        return float("nan"), float("nan")
    iqr = q3 - q1
    return q1 - whisker * iqr, q3 + whisker * iqr


def iqr_filter(df: DataFrame, col: str, relative_error: float = 0.05, whisker: float = 1.5) -> DataFrame:
    """Keep lower <= x <= upper (inclusive); NULL drops out."""
    lo, hi = iqr_bounds(df, col, relative_error, whisker)
    return df.filter(F.lit(lo == lo) & (F.col(col) >= lo) & (F.col(col) <= hi))


def iqr_outliers(df: DataFrame, col: str, relative_error: float = 0.05, whisker: float = 1.5) -> DataFrame:
    """Rows strictly outside the fences."""
    lo, hi = iqr_bounds(df, col, relative_error, whisker)
    return df.filter(F.lit(lo == lo) & ((F.col(col) < lo) | (F.col(col) > hi)))


def drop_outlier_ids(df: DataFrame, outliers: DataFrame, key: str) -> DataFrame:
    """Remove rows whose key is among ``outliers`` (left anti join)."""
    return df.join(outliers.select(key).distinct(), key, "left_anti")


def combine_features(numeric: DataFrame, categorical: DataFrame, key: str) -> DataFrame:
    """Numeric and categorical features side by side, joined on a
    real key (the script would have matched rows by position)."""
    return numeric.join(categorical, key)


def numeric_transforms(df: DataFrame, col: str) -> DataFrame:
    """Log, reciprocal, square root and cube root columns of ``col``."""
    return df.withColumns({f"{col}_log": N.ln(col), f"{col}_recip": N.reciprocal(col),
                           f"{col}_sqrt": N.sqrt(col), f"{col}_cbrt_pow": N.cube_root_pow(col),
                           f"{col}_cbrt": N.cube_root(col)})


def _vector_scaled(fit_df: DataFrame, apply_df: DataFrame, cols: Sequence[str], estimator) -> DataFrame:
    cols = list(cols)
    asm = VectorAssembler(inputCols=cols, outputCol="_features")
    model = estimator.fit(asm.transform(fit_df))
    out = model.transform(asm.transform(apply_df))
    return out.drop("_features")


def minmax_scale(fit_df: DataFrame, apply_df: DataFrame, cols: Sequence[str], out: str = "scaled") -> DataFrame:
    """To [0, 1] with min/max learnt on ``fit_df``; constant -> 0.5."""
    return _vector_scaled(fit_df, apply_df, cols, MinMaxScaler(inputCol="_features", outputCol=out))


def standard_scale(fit_df: DataFrame, apply_df: DataFrame, cols: Sequence[str], out: str = "scaled",
                   with_mean: bool = False, with_std: bool = True) -> DataFrame:
    """Divide by the sample std (and centre on the mean if asked);
    zero std -> 0.0."""
    est = StandardScaler(inputCol="_features", outputCol=out, withMean=with_mean, withStd=with_std)
    return _vector_scaled(fit_df, apply_df, cols, est)


def robust_scale(fit_df: DataFrame, apply_df: DataFrame, col: str, relative_error: float = 0.01,
                 out: str | None = None) -> DataFrame:
    """``(x - median) / (Q3 - Q1)``, the three quantiles from one pass;
    a zero IQR gives NULL rather than a division error."""
    q1, med, q3 = quantile_values(fit_df, col, [0.25, 0.5, 0.75], relative_error)
    scaled = F.try_divide(F.col(col) - F.lit(med), F.lit(q3 - q1))
    return apply_df.withColumn(out or f"{col}_robust", scaled)


def stable_hash(key_cols: Sequence[str], seed: int) -> Column:
    """A reproducible number in [0, 2^32) from the row key and a seed: the
    first 8 hex digits of md5(key:seed).  Unlike ``randomSplit`` it does not
    depend on partitioning or row order."""
    h = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def stable_bucket(key_cols: Sequence[str], seed: int, n: int) -> Column:
    """A reproducible bucket in [0, n)."""
    return (stable_hash(key_cols, seed) % n).cast("int")


def stable_split(df: DataFrame, key_cols: Sequence[str], weights: Sequence[float], seed: int = 42,
                 names: Sequence[str] | None = None, buckets: int = 100) -> DataFrame:
    """Tag every row with a split name: the whole hash against the
    cumulative weights, so a share of any size gets its rows.  ``bucket`` is a
    label (hash modulo ``buckets``)."""
    names = list(names or [f"part{i}" for i in range(len(weights))])
    total = float(sum(weights))
    h = F.col("_hash")
    expr, acc = None, 0.0
    for name, w in zip(names[:-1], weights[:-1]):
        acc += w / total
        cut = int(round(acc * 2**32))
        expr = (F.when(h < cut, F.lit(name)) if expr is None else expr.when(h < cut, F.lit(name)))
    expr = F.lit(names[-1]) if expr is None else expr.otherwise(F.lit(names[-1]))
    return (df.withColumn("_hash", stable_hash(key_cols, seed))
            .withColumns({"bucket": (h % buckets).cast("int"), "split": expr}).drop("_hash"))


def prepare_features(df: DataFrame, nominal: Sequence[str], ordinal: Mapping[str, Mapping], numeric: Sequence[str],
                     target: str, sentinel: str = "?", relative_error: float = 0.05, iqr_col: str | None = None,
                     scaler: str = "minmax") -> DataFrame:
    """Trim -> sentinel to 'Unknown' -> index and one-hot encode nominal
    columns -> ordinal codes -> target class index -> impute numeric means ->
    IQR filter -> assemble (one-hot vectors, ordinal codes, numerics) -> scale
    ('minmax', 'standard' or 'centred').  Returns the untouched columns, ``label``
    (the target's index) and ``features``.

    The fits (indexers, imputer, quantiles, scaler) each scan the cleaned
    input; it is persisted for them (memory, spilling to disk) and released
    before the lazily transformed result is returned."""
    from sparkdeck.operators.relational import trim_string_columns
    from sparkdeck.sources.sinks import persist_for_reuse

    texts = [*nominal, *ordinal, target]
    cleaned = persist_for_reuse(replace_sentinel(trim_string_columns(df), sentinel, "Unknown", cols=texts))
    try:
        t = string_index(cleaned, cleaned, nominal)
        t = one_hot_encode(t, t, [c + "_idx" for c in nominal])
        for c, order in ordinal.items():
            t = ordinal_encode(t, c, order)
        t = label_encode(t, t, target, out="_label")
        t = impute_mean(t, t, numeric)
        if iqr_col is not None:
            t = iqr_filter(t, iqr_col + "_imputed", relative_error)
        cols = [c + "_idx_vec" for c in nominal] + [c + "_ord" for c in ordinal] + [c + "_imputed" for c in numeric]
        if scaler == "minmax":
            out = minmax_scale(t, t, cols, out="features")
        elif scaler in ("standard", "centred"):
            out = standard_scale(t, t, cols, out="features", with_mean=scaler == "centred")
        else:
            raise ValueError(scaler)
    finally:
        cleaned.unpersist()
    keep = [c for c in df.columns if c not in {*nominal, *ordinal, *numeric, target}]
    return out.select(*keep, F.col("_label").alias("label"), "features")
