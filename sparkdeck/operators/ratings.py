"""Rating jobs: per-item statistics, top-k, joins with users/items, the
preferred category per user group (D1-D5, E3-E7, F1, F2, H8-H11, L1-L3).

Inputs are typed frames:
  ratings  (user_id, item_id, rating)
  users    (user_id, <group columns>)
  items    (item_id, title) / (item_id, categories: array<string>)

Plans aggregate *before* joining wherever the result allows it: a rating
table is reduced to one row per item (or per user, or per group x item) with
a partial aggregate, and only that is joined with the dimension.  This is
the reduction the reducer-side joins could not do, and it keeps the join
input bounded by the number of distinct keys instead of the number of
ratings.  Duplicate dimension keys keep one deterministic row ("last one
wins", see ``dedupe_build_side``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkdeck.operators.joins import dedupe_build_side


def _sum_count(ratings: DataFrame, keys: list[str], rating: str = "rating") -> DataFrame:
    return ratings.groupBy(*keys).agg(F.sum(F.col(rating).cast("double")).alias("_sum"),
                                      F.count(F.col(rating)).alias("n_ratings"))


def item_rating_stats(ratings: DataFrame) -> DataFrame:
    """Average and count per item, plus the job's text value
    ``"%.1f,%d"`` (half-up rounding of the average, as the JVM formats it)."""
    g = _sum_count(ratings, ["item_id"])
    avg = F.col("_sum") / F.col("n_ratings")
    return g.select("item_id", avg.alias("avg_rating"), "n_ratings",
                    F.format_string("%.1f,%d", F.round(avg, 1), F.col("n_ratings")).alias("stats"))


def item_stats(ratings: DataFrame, min_count: int = 0) -> DataFrame:
    """Average and count per item with ``HAVING count >= min_count``."""
    g = _sum_count(ratings, ["item_id"])
    return (g.filter(F.col("n_ratings") >= min_count)
            .select("item_id", (F.col("_sum") / F.col("n_ratings")).alias("avg_rating"), "n_ratings"))


def topk_rated_items(ratings: DataFrame, titles: DataFrame, k: int = 10, min_count: int = 50,
                     default_prefix: str = "MovieID_", avg_digits: int | None = None) -> DataFrame:
    """The k best-rated items with at least ``min_count``
    ratings, labelled by title, or ``<prefix><id>`` when the item has none.

    Ties in the average go to the smaller item id (the job left them to
    arrival order).  ``avg_digits`` compares averages rounded to that many
    digits, so float noise cannot reorder equal averages.  The global top-k
    is a TakeOrderedAndProject (per-task top k, then a k-row merge), and the
    title lookup broadcasts the k winners - a side whose size is bounded by
    k - into the title table rather than shipping titles anywhere.
    """
    stats = item_stats(ratings, min_count)
    if avg_digits is not None:
        stats = stats.withColumn("avg_rating", F.round("avg_rating", avg_digits))
    top = stats.orderBy(F.desc("avg_rating"), F.asc("item_id")).limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("avg_rating"), F.asc("item_id")))  # <= k rows
    ranked = top.select(rank.alias("rank"), "*")
    # Titles of the winners only: the k ids are the broadcast (build) side of
    # a semi join that streams the title table; duplicates are resolved over
    # <= k rows; the winners then take their title by a left join whose
    # build side is those <= k rows.  Both references to the winners read
    # the same aggregate exchange (ReusedExchange), so ratings are scanned
    # and shuffled once.
    wanted = titles.select("item_id", "title").join(F.broadcast(ranked.select("item_id")), "item_id", "left_semi")
    named = dedupe_build_side(wanted, "item_id", "title")
    out = ranked.join(F.broadcast(named), "item_id", "left")
    label = F.coalesce(F.col("title"), F.concat(F.lit(default_prefix), F.col("item_id").cast("string")))
    return out.select("rank", "item_id", label.alias("title"), "avg_rating", "n_ratings")


def avg_rating_by_title(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """L/D1/E5/C6: average rating per item, labelled with its title; grouped
    by item id so equal titles stay apart; items without a (non-empty)
    title and items never rated are dropped (inner join)."""
    per_item = _sum_count(ratings, ["item_id"])
    titles = dedupe_build_side(items.filter(F.col("title").isNotNull() & (F.col("title") != "")),
                               "item_id", "title")
    j = per_item.join(titles, "item_id")
    return j.select("item_id", "title", (F.col("_sum") / F.col("n_ratings")).alias("avg_rating"))


def join_ratings_users(ratings: DataFrame, users: DataFrame, user_cols: list[str]) -> DataFrame:
    """Each rating with attributes of its user (inner equi-join)."""
    u = dedupe_build_side(users.select("user_id", *user_cols), "user_id", user_cols)
    return ratings.select("user_id", "item_id", "rating").join(u, "user_id")


def avg_rating_by_group(ratings: DataFrame, users: DataFrame, group_col: str) -> DataFrame:
    """Average rating per user attribute (e.g. gender).

    Ratings are first reduced to (user, sum, count), so the join sees one
    row per rating user, not one per rating."""
    per_user = _sum_count(ratings, ["user_id"])
    u = dedupe_build_side(users.select("user_id", group_col), "user_id", group_col)
    j = per_user.join(u, "user_id")
    g = j.groupBy(group_col).agg(F.sum("_sum").alias("_s"), F.sum("n_ratings").alias("n_ratings"))
    return g.select(group_col, (F.col("_s") / F.col("n_ratings")).alias("avg_rating"), "n_ratings")


def category_counts(ratings: DataFrame, users: DataFrame, items: DataFrame, group_col: str) -> DataFrame:
    """Ratings per (user group, item category).

    (user -> group) join, then one partial aggregate to (group, item, n)
    before the item join, so the category fan-out (explode) runs on
    distinct (group, item) pairs, not on raw ratings.  Items without a
    category list are dropped (inner join)."""
    u = dedupe_build_side(users.select("user_id", group_col), "user_id", group_col)
    rated = ratings.select("user_id", "item_id").join(u, "user_id")
    per_item = rated.groupBy(group_col, "item_id").agg(F.count(F.lit(1)).alias("_n"))
    cats = dedupe_build_side(items.select("item_id", "categories"), "item_id", "categories")
    j = per_item.join(cats, "item_id")
    exploded = j.select(group_col, F.explode("categories").alias("category"), "_n")
    return exploded.groupBy(group_col, "category").agg(F.sum("_n").cast("bigint").alias("n_ratings"))


def preferred_category(ratings: DataFrame, users: DataFrame, items: DataFrame, group_col: str) -> DataFrame:
    """L1/F2: for each user group, the category rated most often; ties go to
    the alphabetically first category.  The rank is a per-group window whose
    ``rank = 1`` filter Spark turns into a WindowGroupLimit, so each task
    keeps one candidate per group before the final shuffle."""
    counts = category_counts(ratings, users, items, group_col)
    w = Window.partitionBy(group_col).orderBy(F.desc("n_ratings"), F.asc("category"))
    return (counts.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select(group_col, "category", "n_ratings"))


# -------------------------------------------------- one-pass mixed inputs --
# When ratings and their dimension arrive as one mixed line input (parsed by
# ``sources.delimited.parse_by_content``), the join is an aggregation by the
# key: per key, the ratings are summed and counted and the dimension value
# is taken (greatest value: "last one wins", deterministic).  One scan, one
# shuffle of partial aggregates, no join; a key without ratings or without a
# dimension row drops out, as in the inner join.

def group_average_one_pass(tagged: DataFrame, key: str, attr: str, rating: str = "rating") -> DataFrame:
    """L3 over a mixed input (ratings + users): average rating per ``attr``."""
    per_key = tagged.groupBy(key).agg(F.sum(F.col(rating).cast("double")).alias("_sum"),
                                      F.count(F.col(rating)).alias("_n"), F.max(attr).alias(attr))
    matched = per_key.filter((F.col("_n") > 0) & F.col(attr).isNotNull())
    g = matched.groupBy(attr).agg(F.sum("_sum").alias("_s"), F.sum("_n").alias("n_ratings"))
    return g.select(attr, (F.col("_s") / F.col("n_ratings")).alias("avg_rating"), "n_ratings")


def labelled_average_one_pass(tagged: DataFrame, key: str, label: str, rating: str = "rating") -> DataFrame:
    """D1/E5 over a mixed input (ratings + items): average per key with its
    non-empty label (title); equal labels stay apart."""
    per_key = tagged.groupBy(key).agg(F.sum(F.col(rating).cast("double")).alias("_sum"),
                                      F.count(F.col(rating)).alias("_n"),
                                      F.max(F.when(F.col(label) != "", F.col(label))).alias(label))
    matched = per_key.filter((F.col("_n") > 0) & F.col(label).isNotNull())
    return matched.select(key, label, (F.col("_sum") / F.col("_n")).alias("avg_rating"))
