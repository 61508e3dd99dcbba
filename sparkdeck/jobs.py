"""Command-line front end: the batch jobs as ``spark-submit`` commands.

    python -m sparkdeck.jobs <job> <inputs...> <output> [options]

Each job reads text (or CSV) inputs, runs the library's operators and writes
``key<TAB>value`` text (or value-only lines) to an output directory that
must not exist yet (``--overwrite`` replaces it).  Everything runs as one
Spark plan per job: the temporary directories between chained MapReduce
steps are not needed.

Jobs: word-count, filter-transactions, project-transactions,
union-transactions, intersect-transactions, difference-transactions,
movie-ratings-stats, matrix-vector, avg-rating-by-title,
avg-rating-by-gender, top-rated, preferred-genre, linear-regression,
model-compare, grid-search, logistic-regression, prepare-features.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdeck.operators import evaluate, features, linalg, profile, ratings, relational, tuning, words
from sparkdeck.operators import models as M
from sparkdeck.operators.evaluate import regression_metrics
from sparkdeck.sources.csv import read_csv_inferred, read_csv_strings
from sparkdeck.sources.delimited import (
    RATING_FIELDS,
    USER_TEXT_FIELDS,
    Layout,
    parse_by_content,
    parse_delimited,
    parse_item_titles,
    parse_items,
    parse_rated_pairs,
    parse_tab_ratings,
    parse_user_texts,
)
from sparkdeck.sources.sinks import persist_for_reuse, write_csv, write_kv_text, write_text_values
from sparkdeck.sources.text import read_lines

# The genre flags of the MovieLens item file, in file order.
GENRES = ["unknown", "Action", "Adventure", "Animation", "Children's", "Comedy",
          "Crime", "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror",
          "Musical", "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western"]

ITEM_ENCODING = "ISO-8859-1"  # the MovieLens item file is Latin-1


def _mode(a) -> str:
    return "overwrite" if a.overwrite else "errorifexists"


def _kv(df: DataFrame, a, key: str, value: str | Sequence[str]) -> None:
    write_kv_text(df, a.output, key, value, mode=_mode(a), sort_output=a.sort)


def _values(df: DataFrame, a, col: str = "value") -> None:
    write_text_values(df, a.output, col, mode=_mode(a), sort_output=a.sort)


# ------------------------------------------------------------ line jobs --

def word_count(spark: SparkSession, a) -> None:
    lines = read_lines(spark, a.input)
    if a.variant == "lengths":        # as coded: (token, length) per occurrence
        _kv(words.token_lengths(lines), a, "word", "length")
    elif a.variant == "length-sum":   # with the declared sum reducer
        _kv(words.token_length_sum(lines), a, "word", "total_length")
    else:                             # as titled
        _kv(words.word_count(lines), a, "word", "count")


def filter_transactions(spark: SparkSession, a) -> None:
    _values(relational.filter_amount(read_lines(spark, a.input), a.threshold, on_bad=a.on_bad), a)


def project_transactions(spark: SparkSession, a) -> None:
    _values(relational.project_distinct(read_lines(spark, a.input)), a)


def _set_job(op):
    def run(spark: SparkSession, a) -> None:
        _values(op(read_lines(spark, a.left), read_lines(spark, a.right)), a)
    return run


def movie_ratings_stats(spark: SparkSession, a) -> None:
    r = parse_delimited(read_lines(spark, a.input), ",",
                        [("user_id", "string"), ("item_id", "string"), ("rating", "int")],
                        arity=3, exact=True, on_bad=a.on_bad)
    _kv(ratings.item_rating_stats(r), a, "item_id", "stats")


def matrix_vector(spark: SparkSession, a) -> None:
    m = parse_delimited(read_lines(spark, a.matrix), ",", [("row", "int"), ("col", "int"), ("value", "double")],
                        arity=3, exact=True, on_bad=a.on_bad)
    v = parse_delimited(read_lines(spark, a.vector), ",", [("col", "int"), ("value", "double")],
                        arity=2, exact=True, on_bad=a.on_bad)
    _kv(linalg.matvec(m, v), a, "row", "value")


# ---------------------------------------------------------- rating jobs --

def _ratings(spark: SparkSession, path: str, on_bad: str) -> DataFrame:
    return parse_tab_ratings(read_lines(spark, path), on_bad=on_bad)


def _items(spark: SparkSession, path: str) -> DataFrame:
    return parse_items(read_lines(spark, path, encoding=ITEM_ENCODING), GENRES)


def avg_rating_by_title(spark: SparkSession, a) -> None:
    # One read of both files; records told apart by content (tab -> rating,
    # pipe -> item), joined and averaged by one aggregation on the item id.
    # Lines are taken as they are (an empty user field stays in place).
    rating = [("user_id", "string"), *RATING_FIELDS[1:3]]
    layouts = (Layout("R", "\t", "\t", rating, arity=3, exact=False, on_bad=a.on_bad, trim_line=False),
               Layout("M", "|", "|", [("item_id", "bigint"), ("title", "string")], arity=2, exact=False, trim_line=False))
    tagged = parse_by_content(read_lines(spark, [a.ratings, a.items], encoding=ITEM_ENCODING), layouts)
    _kv(ratings.labelled_average_one_pass(tagged, "item_id", "title"), a, "title", "avg_rating")


def avg_rating_by_gender(spark: SparkSession, a) -> None:
    layouts = (Layout("R", "\t", "\t", RATING_FIELDS[:3], arity=3, exact=False, on_bad=a.on_bad),
               Layout("U", "|", "|", USER_TEXT_FIELDS, arity=5, exact=True))
    tagged = parse_by_content(read_lines(spark, [a.ratings, a.users]), layouts)
    _kv(ratings.group_average_one_pass(tagged, "user_id", "gender"), a, "gender", "avg_rating")


def top_rated(spark: SparkSession, a) -> None:
    out = ratings.topk_rated_items(_ratings(spark, a.ratings, a.on_bad),
                                   parse_item_titles(read_lines(spark, a.items, encoding=ITEM_ENCODING)),
                                   k=a.k, min_count=a.min_count, default_prefix=a.default_prefix)
    _kv(out, a, "title", "avg_rating")


def preferred_genre(spark: SparkSession, a) -> None:
    users = parse_user_texts(read_lines(spark, a.users))
    rated = parse_rated_pairs(read_lines(spark, a.ratings), on_bad=a.on_bad)
    out = ratings.preferred_category(rated, users, _items(spark, a.items), "occupation")
    _kv(out, a, "occupation", "category")


# ----------------------------------------------------------- model jobs --

def _table(spark: SparkSession, a) -> DataFrame:
    df = relational.cast_all(read_csv_strings(spark, a.input), "double", safe=a.on_bad == "skip")
    return relational.drop_columns(df, a.drop or [])


def linear_regression(spark: SparkSession, a) -> None:
    df = _table(spark, a)
    feats = relational.feature_columns(df, a.label)
    train, test = tuning.with_split(df, feats + [a.label], 0.7, a.seed)
    m = M.fit_regressor(train, feats, a.label, "linear", regParam=a.reg_param, maxIter=a.max_iter,
                        scale=True, with_mean=True)
    met = regression_metrics(M.predict(m, test), a.label).first()
    terms = M.linear_terms(spark, m, feats)
    # NULL where the test rows give no figure
    extra = spark.createDataFrame([("test_rmse", met["rmse"] if met else None), ("test_r2", met["r2"] if met else None)],
                                  "term string, value double")
    write_csv(terms.unionByName(extra), a.output, mode=_mode(a))


def model_compare(spark: SparkSession, a) -> None:
    df = _table(spark, a)
    feats = relational.feature_columns(df, a.label)
    train, test = tuning.with_split(df, feats + [a.label], 0.7, a.seed)
    write_csv(tuning.model_compare(train, test, feats, a.label, seed=a.seed), a.output, mode=_mode(a))


def grid_search(spark: SparkSession, a) -> None:
    df = _table(spark, a)
    feats = relational.feature_columns(df, a.label)
    train, test = tuning.with_split(df, feats + [a.label], 0.7, a.seed)
    found = tuning.grid_search_cv(train, feats, a.label, feats + [a.label], tuning.FULL_GRID, folds=a.folds, seed=a.seed)
    met = found.evaluate(test, a.label).select(F.col("rmse").alias("test_rmse"), F.col("r2").alias("test_r2"))
    scored = found.results.join(met.withColumn("is_best", F.lit(True)), "is_best", "left")
    write_csv(scored.select(*found.results.columns, "test_rmse", "test_r2"), a.output, mode=_mode(a))


def logistic_regression(spark: SparkSession, a) -> None:
    """Fit on the train split; coefficients and, on the test rows, accuracy,
    area under the curve and the confusion matrix, one line a figure."""
    df = _table(spark, a)
    feats = relational.feature_columns(df, a.label)
    train, test = tuning.with_split(df, feats + [a.label], 0.7, a.seed)
    m = M.fit_logistic(train, feats, a.label, scale=True)
    scored = persist_for_reuse(M.positive_probability(M.predict(m, test)))
    try:
        acc = evaluate.accuracy(scored, a.label, "prediction").first()["accuracy"]
        both = scored.agg(F.count_distinct(a.label)).first()[0] == 2  # an area needs both classes
        auc = evaluate.auc_roc(scored, a.label, "p1").first()["auc"] if both else None
        cells = profile.confusion_matrix(scored, a.label, "prediction", [0, 1]).collect()  # one row a class
    finally:
        scored.unpersist()
    rows = [("test_accuracy", acc), ("test_auc", auc)]
    rows += [(f"label_{int(r[a.label])}_{c}", float(r[c])) for r in cells for c in ("pred_0", "pred_1", "pred_other")]
    write_csv(M.logistic_terms(spark, m, feats).unionByName(spark.createDataFrame(rows, "term string, value double")),
              a.output, mode=_mode(a))


def prepare_features(spark: SparkSession, a) -> None:
    """One-hot, ordinal and numeric features of a CSV table and the target's
    class index; the vector is written as text (CSV holds no vectors)."""
    order = {}
    for spec in a.ordinal or []:
        col, _, values = spec.partition("=")
        order[col] = {v: i for i, v in enumerate(values.split(","))}
    out = features.prepare_features(read_csv_inferred(spark, a.input), a.nominal or [], order, a.numeric, a.target,
                                    sentinel=a.sentinel, relative_error=a.relative_error, iqr_col=a.iqr_col, scaler=a.scaler)
    write_csv(out.withColumn("features", features.vector_text("features")), a.output, mode=_mode(a))


# ------------------------------------------------------------------ CLI --

def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparkdeck.jobs", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="job", required=True)

    def job(name, fn, *positional, on_bad="fail"):
        s = sub.add_parser(name)
        for arg in positional:
            s.add_argument(arg)
        s.add_argument("output")
        s.add_argument("--overwrite", action="store_true", help="replace an existing output directory")
        s.add_argument("--sort", action="store_true", help="sort the output by key (parallel range sort)")
        s.add_argument("--on-bad", choices=["fail", "skip"], default=on_bad,
                       help="unparsable numbers: fail the job or drop the row")
        s.set_defaults(fn=fn)
        return s

    job("word-count", word_count, "input").add_argument(
        "--variant", choices=["count", "lengths", "length-sum"], default="count")
    job("filter-transactions", filter_transactions, "input").add_argument("--threshold", type=float, default=1000.0)
    job("project-transactions", project_transactions, "input")
    job("union-transactions", _set_job(relational.union_lines), "left", "right")
    job("intersect-transactions", _set_job(relational.intersect_lines), "left", "right")
    job("difference-transactions", _set_job(relational.difference_lines), "left", "right")
    job("movie-ratings-stats", movie_ratings_stats, "input")
    job("matrix-vector", matrix_vector, "matrix", "vector")
    job("avg-rating-by-title", avg_rating_by_title, "ratings", "items")
    job("avg-rating-by-gender", avg_rating_by_gender, "ratings", "users", on_bad="skip")
    s = job("top-rated", top_rated, "ratings", "items", on_bad="skip")
    s.add_argument("--k", type=int, default=10)
    s.add_argument("--min-count", type=int, default=50)
    s.add_argument("--default-prefix", default="MovieID_")
    job("preferred-genre", preferred_genre, "ratings", "users", "items", on_bad="skip")
    s = job("prepare-features", prepare_features, "input")
    s.add_argument("--nominal", nargs="*", help="columns to index and one-hot encode")
    s.add_argument("--ordinal", nargs="*", metavar="COLUMN=LOW,..,HIGH", help="columns with an order of values")
    s.add_argument("--numeric", nargs="+", required=True)
    s.add_argument("--target", required=True)
    s.add_argument("--sentinel", default="?")
    s.add_argument("--iqr-col", help="numeric column whose outliers are dropped")
    s.add_argument("--relative-error", type=float, default=0.05, help="of the quartiles; 0: exact")
    s.add_argument("--scaler", choices=["minmax", "standard", "centred"], default="minmax")
    for name, fn in (("linear-regression", linear_regression), ("model-compare", model_compare),
                     ("grid-search", grid_search), ("logistic-regression", logistic_regression)):
        s = job(name, fn, "input")
        s.add_argument("--label", required=True)
        s.add_argument("--drop", nargs="*", default=[])
        s.add_argument("--seed", type=int, default=123)
        if name == "linear-regression":
            s.add_argument("--reg-param", type=float, default=0.3)
            s.add_argument("--max-iter", type=int, default=10)
        if name == "grid-search":
            s.add_argument("--folds", type=int, default=3)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    a = build_parser().parse_args(argv)
    if spark is None:
        # master, memory and partitioning are the submitter's
        spark = SparkSession.builder.appName(f"sparkdeck-{a.job}").getOrCreate()
    a.fn(spark, a)


if __name__ == "__main__":
    main()
