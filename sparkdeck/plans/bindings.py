"""Bindings: the driver's tables -> operator inputs (FIXTURES.md §3).

Each binding is a lazy DataFrame built from the parquet tables, so Catalyst
prunes columns and pushes filters into the scans, and work grows with the
tables.  Bad rows, nulls, NaN and sentinels are injected with key-modulus
rules that the SQL oracle repeats word for word (``plans/sqlparts.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdeck.functions.encode import names_to_flags

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# The words of part names at every scale factor (8 adjectives,
# 8 nouns), used as the item category list.
CATEGORY_NAMES = ["blue", "cold", "hot", "large", "new", "old", "red", "small",
                  "anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]

# Ordinal order of the order priorities (low -> high).
PRIORITY_ORDER = {"5-LOW": 0, "4-NOT SPECIFIED": 1, "3-MEDIUM": 2, "2-HIGH": 3, "1-URGENT": 4}

NAN = float("nan")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod(c: str, m: int) -> Column:
    return F.col(c) % m == 0


# ---------------------------------------------------------------- lines --

def price_text(c: str = "o_totalprice") -> Column:
    return F.col(c).cast("decimal(12,2)").cast("string")


def transaction_lines(spark: SparkSession, d: str) -> DataFrame:
    """orders -> ``user,item,amount,date``; every 13th key a blank line, every
    11th an empty last field (3 fields for the JVM split), every 7th padded
    with a tab and a blank (kept untrimmed on output)."""
    o = table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    base = F.concat_ws(",", "o_custkey", "o_orderkey", price_text(), day)
    value = (F.when(_mod("o_orderkey", 13), F.lit(" \t "))
             .when(_mod("o_orderkey", 11), F.concat_ws(",", "o_custkey", "o_orderkey", price_text(), F.lit("")))
             .when(_mod("o_orderkey", 7), F.concat(F.lit("\t"), base, F.lit(" ")))
             .otherwise(base))
    return o.select(value.alias("value"))


def set_lines(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two line sets over whole tables, with duplicates inside each:
    A = every order as ``custkey,orderstatus``; B = every line item as
    ``custkey,linestatus`` (through its order).  Every 5th key adds a
    trailing blank, which the trimmed comparison must ignore."""
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem")

    def padded(line: Column, key: str) -> Column:
        return F.when(_mod(key, 5), F.concat(line, F.lit(" "))).otherwise(line).alias("value")

    a = o.select(padded(F.concat_ws(",", "o_custkey", "o_orderstatus"), "o_orderkey"))
    b = (li.join(o, li.l_orderkey == o.o_orderkey)
         .select(padded(F.concat_ws(",", "o_custkey", "l_linestatus"), "l_orderkey")))
    return a, b


def rating_pairs(spark: SparkSession, d: str) -> DataFrame:
    """lineitem x orders: (user, item, rating, orderkey, linenumber)."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                    F.col("l_quantity").cast("int").alias("rating"),
                    F.col("l_orderkey"), F.col("l_linenumber")))


def rating_lines_csv(spark: SparkSession, d: str) -> DataFrame:
    """ratings as ``user,item,rating`` lines."""
    r = rating_pairs(spark, d)
    return r.select(F.concat_ws(",", "user_id", "item_id", "rating").alias("value"))


def rating_lines_tab(spark: SparkSession, d: str) -> DataFrame:
    """ratings as ``user<TAB>item<TAB>rating<TAB>ts``; every second line of an
    order is half a point higher; the first line of every 17th order has a
    non-numeric rating (dropped by the guarded parse)."""
    r = rating_pairs(spark, d)
    bad = _mod("l_orderkey", 17) & (F.col("l_linenumber") == 1)
    half = F.when(_mod("l_linenumber", 2), F.lit(0.5)).otherwise(F.lit(0.0))
    rating = F.when(bad, F.lit("x")).otherwise((F.col("rating") + half).cast("string"))
    return r.select(F.concat_ws("\t", "user_id", "item_id", rating, "l_orderkey").alias("value"))


def user_lines(spark: SparkSession, d: str) -> DataFrame:
    """customer x nation as ``id|age|gender|occupation|zip`` with
    age := nationkey, gender := segment, occupation := nation name,
    zip := last five characters of the name (leading zeros kept); every
    23rd key has an empty zip, so the JVM split sees 4 fields."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    zip_ = F.when(_mod("c_custkey", 23), F.lit("")).otherwise(F.substring("c_name", -5, 5))
    return j.select(F.concat_ws("|", "c_custkey", "c_nationkey", "c_mktsegment", "n_name", zip_).alias("value"))


def item_lines(spark: SparkSession, d: str) -> DataFrame:
    """part as ``id|title|date|video date|url|flag x 16``; flag i is 1 when
    category i is a word of the part name."""
    p = table(spark, d, "part")
    flags = names_to_flags(F.split("p_name", " "), CATEGORY_NAMES)
    return p.select(F.concat_ws("|", "p_partkey", "p_name", F.lit(""), F.lit(""), F.lit(""), *flags).alias("value"))


def document_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


# --------------------------------------------------------- typed inputs --

def users(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, segment, nation) from customer x nation."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"),
                    F.col("n_name").alias("nation")))


def item_titles(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def event_ratings(spark: SparkSession, d: str) -> DataFrame:
    """R2: events as (item := user_id, rating := value)."""
    e = table(spark, d, "events")
    return e.select(F.col("event_id").alias("user_id"), F.col("user_id").alias("item_id"),
                    F.col("value").alias("rating"))


def event_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles for R2: supplier names by key (the whole table).  Event users
    outnumber suppliers, so ids without a title take the default label."""
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("item_id"), F.col("s_name").alias("title"))


def matrix_entries(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_suppkey").alias("row"), F.col("l_partkey").alias("col"),
                     F.col("l_quantity").alias("value"))


def vector_entries(spark: SparkSession, d: str) -> DataFrame:
    """part sizes by part key (the whole table)."""
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("col"), F.col("p_size").cast("double").alias("value"))


def loan_table(spark: SparkSession, d: str) -> DataFrame:
    """orders x customer with injected gaps: segment NULL at key%17, priority
    NULL at key%29, price NULL at key%17 and NaN at key%19, balance NULL at
    key%23; label = status 'F'."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = "o_orderkey"
    return j.select(
        F.col(k).alias("id"),
        F.when(_mod(k, 17), F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.col("o_orderstatus").alias("status"),
        F.when(_mod(k, 29), F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(_mod(k, 17), F.lit(None).cast("double")).when(_mod(k, 19), F.lit(NAN))
        .otherwise(F.col("o_totalprice")).alias("price"),
        F.when(_mod(k, 23), F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("balance"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )


def adult_table(spark: SparkSession, d: str) -> DataFrame:
    """orders x customer as the space-after-comma census file reads: string
    fields carry a leading blank, ' ?' marks a missing segment at key%13
    and a missing priority at key%31."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = "o_orderkey"
    sp = F.lit(" ")
    return j.select(
        F.col(k).alias("id"),
        F.when(_mod(k, 13), F.lit(" ?")).otherwise(F.concat(sp, "c_mktsegment")).alias("segment"),
        F.concat(sp, "o_orderstatus").alias("status"),
        F.when(_mod(k, 31), F.lit(" ?")).otherwise(F.concat(sp, "o_orderpriority")).alias("priority"),
        F.col("o_totalprice").alias("price"),
        F.col("c_acctbal").alias("balance"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )


def regression_table(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_id"),
                     "l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("label"))


def document_features(spark: SparkSession, d: str) -> DataFrame:
    """documents: n_chars and simple text counts (lines, words, digits)."""
    docs = table(spark, d, "documents")
    return docs.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", "\n", -1)).cast("double").alias("n_lines"),
        F.size(F.split(F.trim("text"), r"\s+", -1)).cast("double").alias("n_words"),
        F.length(F.regexp_replace("text", r"[^0-9]", "")).cast("double").alias("n_digits"),
    )


def labelled_documents(spark: SparkSession, d: str) -> DataFrame:
    lab = table(spark, d, "labels")
    return document_features(spark, d).join(lab.select("doc_id", F.col("quality").alias("label")), "doc_id")


def scored_labels(spark: SparkSession, d: str) -> DataFrame:
    """labels: quality as label, toxic as prediction, score = n_chars / 1000."""
    lab = table(spark, d, "labels")
    docs = table(spark, d, "documents")
    return (lab.join(docs.select("doc_id", "n_chars"), "doc_id")
            .select("doc_id", F.col("quality").alias("label"), F.col("toxic").alias("prediction"),
                    (F.col("n_chars") / 1000.0).alias("score")))


def embedding_table(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "embedding", "label")
