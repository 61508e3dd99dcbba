"""Benchmark decontamination: hashed windows of the test items, broadcast.

Words are runs of ASCII letters and digits and of non-ASCII characters after
lower-casing A-Z.  A *window* is ``size`` consecutive words of a test item, or
the whole item when it has fewer words.  Every document window whose hash is
in the broadcast set of item windows is verified on the words themselves.

Plan: one pass over the documents.  Each task hashes its document windows,
probes the broadcast set (a hash join on one bigint) and keeps one marker row
per document plus its hits; only these rows are shuffled, to join the window
texts (the verification) and to be grouped per document.  The set of window
hashes has a size bound (``max_set`` per pass, about 25 bytes each); a larger
test collection is split by hash into several passes whose hits are united.

Defined results: a null or wordless text has no words and no hits; an item
without words matches nothing; items of one id count once; windows of an item
with a null id mark words but add no item; repeated documents each get a row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdeck.llm.common import SQL_WORDS, fresh, saved, words

WINDOW_WORDS = 10
#: Window hashes broadcast in one pass (a bigint and a length each).
MAX_SET = 2_000_000
#: Digests of contaminated texts (about 60 bytes each) up to which they are broadcast.
MAX_BAD = 500_000


def item_windows(items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(hash, len, gram, item_id) of every window of every item."""
    w = (items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
         .withColumn("len", F.least(F.size("w"), F.lit(size))))
    at = w.select("item_id", "len", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("len") + 1), lambda i: F.slice("w", i, F.col("len")))).alias("g"))
    return at.select(F.xxhash64("g").alias("hash"), "len", F.array_join("g", " ").alias("gram"), "item_id")


def _hash_from(w: Column, k: int) -> Callable[[Column], Column]:
    return lambda i: F.xxhash64(F.slice(w, i, k))


def _hashes(w: Column, n: Column, lengths: list[int]) -> Column:
    """Element 0 is the document's marker, then the window hashes per length."""
    parts = [F.array(F.lit(0).cast("long"))]
    for k in lengths:
        parts.append(F.when(n >= k, F.transform(F.sequence(F.lit(1), n - (k - 1)), _hash_from(w, k)))
                     .otherwise(F.array().cast("array<bigint>")))
    return F.concat(*parts)


def _start(pos: Column, length: Column, n: Column, lengths: list[int]) -> Column:
    """1-based word position of element ``pos`` of ``_hashes`` for its length."""
    out, before = F.lit(None).cast("int"), F.lit(0)
    for k in lengths:
        out = F.when(length == k, pos - before).otherwise(out)
        before = before + F.greatest(n - (k - 1), F.lit(0))
    return out


def find_hits(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS, max_set: int = MAX_SET,
              keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document row: its ``keep`` columns, ``n_words``, ``covered``
    (sorted 0-based positions of hit words) and ``items`` (sorted item ids as
    strings).  ``docs`` needs ``text``; columns not in ``keep`` are ignored."""
    grams = item_windows(items, size)
    by_hash = grams.select("hash", "len").distinct().persist()
    try:
        total = by_hash.count()
        lengths = [r[0] for r in by_hash.select("len").distinct().orderBy(F.desc("len")).collect()]  # at most `size`
    finally:
        by_hash.unpersist()
    passes = max(1, -(-total // max_set))
    base = docs.select(F.monotonically_increasing_id().alias("__uid"),
                       *[F.col(c).alias(f"__keep_{i}") for i, c in enumerate(keep)],
                       words(F.col("text")).alias("w"))
    kept = [f"__keep_{i}" for i in range(len(keep))]
    at = (base.withColumn("n", F.size("w"))
          .select("__uid", *kept, "w", "n", F.posexplode(_hashes(F.col("w"), F.col("n"), lengths)).alias("p", "h")))
    found = []
    for b in range(passes):
        part = by_hash if passes == 1 else by_hash.where(F.pmod("hash", F.lit(passes)) == b)
        j = at.join(F.broadcast(part.select(F.col("hash").alias("g"), F.col("len"))),
                    F.when(F.col("p") > 0, F.col("h")) == F.col("g"), "left")
        j = j.where((F.col("p") == 0 if b == 0 else F.lit(False)) | F.col("g").isNotNull())
        start = _start(F.col("p"), F.col("len"), F.col("n"), lengths)
        found.append(j.withColumn("s", start).select(
            "__uid", *kept, "n", (F.col("s") - 1).alias("s"), "len",
            # a marker gets a text of its own, no gram starts with a space
            F.when(F.col("p") == 0, F.concat(F.lit(" "), F.col("__uid").cast("string")))
            .otherwise(F.array_join(F.slice("w", F.col("s"), F.col("len")), " ")).alias("gram")))
    hits = reduce(DataFrame.unionByName, found)
    texts = grams.groupBy("gram").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    j = hits.join(texts, "gram", "left")
    ok = F.col("ids").isNotNull()
    one = (j.groupBy("__uid")
           .agg(*[F.max_by(F.col(c), F.col("s").isNull()).alias(c) for c in kept], F.max("n").alias("n_words"),
                F.collect_set(F.when(ok, F.struct("s", "len"))).alias("at"),
                F.collect_set(F.when(ok, F.col("ids"))).alias("sets")))
    covered = F.array_sort(F.array_distinct(F.flatten(
        F.transform("at", lambda x: F.sequence(x["s"], x["s"] + x["len"] - 1)))))
    return one.select(*[F.col(c).alias(k) for c, k in zip(kept, keep, strict=True)], F.col("n_words").cast("long"),
                      covered.alias("covered"), F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS, max_set: int = MAX_SET) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hits = find_hits(docs, items, size, max_set)
    n_hit = F.size("covered").cast("long")
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS, max_set: int = MAX_SET,
                        max_bad: int = MAX_BAD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text has no item window.  Texts
    are told apart by their digest, so copies share one decision.  The digests
    of the few texts that go are written; up to ``max_bad`` they are sent to the
    tasks, so no text is shuffled, beyond that joined by a shuffle."""
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    hits = find_hits(docs.select(digest.alias("digest"), "text"), items, size, max_set, keep=("digest",))
    name = fresh("bad", docs.columns)
    bad = saved(hits.where(F.size("covered") > 0).select(F.col("digest").alias(name)).distinct(), "bad")
    bad = F.broadcast(bad) if bad.count() <= max_bad else bad
    return docs.join(bad, digest == F.col(name), "left_anti")


#: DuckDB: the same result per document over the tables ``documents`` and ``benchmark``.
CONTAMINATION_SQL = f"""
WITH b AS (SELECT item_id, {SQL_WORDS.format('text')} AS w FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
      FROM (SELECT item_id, w, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS i FROM bl)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {SQL_WORDS.format('text')} AS w FROM documents),
lens AS (SELECT DISTINCT k FROM g),
dw AS (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
       FROM (SELECT rid, k, w, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS i FROM d, lens WHERE len(w) >= k)),
h AS (SELECT dw.rid, dw.i, dw.k, g.item_id FROM dw JOIN g USING (gram)),
c AS (SELECT rid, count(DISTINCT p) AS n_hit
      FROM (SELECT rid, unnest(range(CAST(i AS BIGINT), CAST(i + k AS BIGINT))) AS p FROM (SELECT DISTINCT rid, i, k FROM h)) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
      FROM (SELECT DISTINCT rid, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""
