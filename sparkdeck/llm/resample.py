"""Importance resampling of documents towards a target distribution.

Features are the runs of 1 to ``longest`` consecutive words, hashed to buckets.
A bucket's gain is the scaled logarithm of its smoothed share among the target
texts over that among all documents; the gains are one array, and a document's
weight is the floored mean of the array over its features.  Gumbel noise from a
hash of the id is added, and the highest scores are drawn: sampling without
replacement in proportion to the importance weights, the same at every run.

*Cutoff.*  A quantile sketch of the scores gives a bracket around the wanted
rank.  The rows above and inside it are counted exactly: the bracket holds if
the rank falls inside, and is widened fourfold otherwise (at last to all rows).
Only the bracket is sorted to find the last row drawn.  The drawn rows are then
numbered by a range-partitioned sort with offsets (``row_numbers``).

*Scale.*  Two scans of the texts: one adds up bucket counts in each task (at
most ``buckets`` rows of a task are shuffled), one scores and writes narrow
rows.  The driver holds the array of gains and one row, the cutoff.  Long texts
are cut into pieces at word ends.

Defined results: a null text, or one without words, has no features and the
weight 0; a null doc_id takes part with the empty text as its id and comes last
among equal scores; every row is scored, counted and drawn by itself, repeated
ones too; an empty target or an empty table gives gains from the smoothing
alone, or no rows.  Other columns of the tables are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from sparkdeck.llm.common import SQL_WORDS, saved, ship
from sparkdeck.llm.textnp import split_words
from sparkdeck.operators.ranking import row_numbers

BUCKETS = 10_000
LONGEST_RUN = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Of the quantile sketch: ranks are off by at most 1 / ACCURACY of the rows.
ACCURACY = 10_000
#: Id that orders rows without one.
LAST_ID = 2**63 - 1


def bucket_runs(text: str | None, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """For each piece of a text: the number of its words, and the buckets of
    the runs that end in it (a run's crc32 continues that of the run one word
    shorter)."""
    tail: list[bytes] = []
    for words in split_words(text):
        w = tail + words
        run = list(map(zlib.crc32, w))
        found = [run[len(tail):]]
        for k in range(1, longest):
            run = [zlib.crc32(b" " + x, c) for c, x in zip(run, w[k:], strict=False)]
            found.append(run[max(0, len(tail) - k):])
        yield len(words), np.fromiter((c for f in found for c in f), np.int64, sum(map(len, found))) % buckets
        tail = w[len(w) - longest + 1:] if longest > 1 else []


def bucket_counts(texts: DataFrame, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                for _, found in bucket_runs(text, longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at.astype(np.int64), "n": total[at]})

    return texts.select("text").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket: at most ``buckets`` counts of each table are
    collected."""
    counts = []
    for texts in (docs, target):
        c = np.zeros(buckets, dtype=np.int64)
        for r in bucket_counts(texts, longest, buckets).collect():
            c[r["bucket"]] = r["n"]
        counts.append(c.tolist())
    source, wanted = counts
    s, t = sum(source), sum(wanted)
    return np.array([math.floor(1000 * math.log(float(b + 1) * float(s + buckets) / (float(a + 1) * float(t + buckets))))
                     for a, b in zip(source, wanted, strict=True)], dtype=np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Scaled Gumbel noise from the first 32 bits of a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST_RUN, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                words = features = total = 0
                for n, found in bucket_runs(text, longest, len(gain)):
                    words, features, total = words + n, features + len(found), total + int(gain[found].sum())
                rows.append((words, features, total // features if features else 0))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"], dtype="int64")

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), weigh(F.coalesce("text", F.lit(""))).alias("w"))
    return d.select("doc_id", "w.*").withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def bracket(scores: DataFrame, rows: int, wanted: int, accuracy: int = ACCURACY, slack: float | None = None) -> tuple[int | None, int | None, int]:
    """(low, high, above): the ``wanted``-th highest of ``rows`` scores lies
    from low to high (None: unbounded), and ``above`` rows are higher."""
    q, slack = 1 - wanted / rows, slack if slack is not None else 2 / accuracy
    while True:
        low_q, high_q = q - slack, q + slack
        low, high = scores.agg(F.percentile_approx("score", [max(0.0, low_q), min(1.0, high_q)], accuracy).alias("b")).first()["b"]
        low, high = low if low_q > 0 else None, high if high_q < 1 else None
        over = F.col("score") > high if high is not None else F.lit(False)
        within = ~over & (F.col("score") >= low if low is not None else F.lit(True))
        above, inside = scores.agg(F.count_if(over), F.count_if(within)).first()
        if above < wanted <= above + inside:
            return low, high, above
        slack = max(4 * slack, 1 / rows)


def cutoff(candidates: DataFrame, rows: int, wanted: int, accuracy: int = ACCURACY, slack: float | None = None) -> Row:
    """(score, id, row) of the last row drawn."""
    low, high, above = bracket(candidates.select("score"), rows, wanted, accuracy, slack)
    inside = candidates.select("score", "id", "row")
    if high is not None:
        inside = inside.where(F.col("score") <= high)
    if low is not None:
        inside = inside.where(F.col("score") >= low)
    return row_numbers(inside, [F.desc("score"), F.asc("id"), F.asc("row")], "n").where(F.col("n") == wanted - above).first()


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             longest: int = LONGEST_RUN, buckets: int = BUCKETS, seed: int = SEED, accuracy: int = ACCURACY) -> DataFrame:
    """Every row's doc_id, n_features, weight, score and, of those drawn, rank;
    ``percent`` of the rows with at least ``least_words`` words are drawn."""
    ship(docs.sparkSession)
    gain = gains(docs, target, longest, buckets)
    # written once: the numbers that part equal rows must not change between passes
    all_rows = saved(scored(docs, gain, longest, seed).withColumn("id", F.coalesce("doc_id", F.lit(LAST_ID)))
                     .withColumn("row", F.monotonically_increasing_id()), "scored")
    may = F.col("n_words") >= least_words
    columns = ["doc_id", "n_features", "weight", "score"]
    rows = all_rows.where(may).count()
    wanted = rows * percent // 100
    if not wanted:
        return all_rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    last = cutoff(all_rows.where(may), rows, wanted, accuracy)
    order = [F.desc("score"), F.asc("id"), F.asc("row")]
    same = F.col("score") == last["score"]
    drawn = may & ((F.col("score") > last["score"]) | (same & (F.col("id") < last["id"]))
                   | (same & (F.col("id") == last["id"]) & (F.col("row") <= last["row"])))
    ranked = row_numbers(all_rows.where(drawn), order, "rank").select(*columns, "rank")
    return ranked.unionByName(all_rows.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


#: DuckDB: crc32 bytewise with its table of 256 remainders, per distinct word.
RESAMPLE_SQL = f"""
WITH RECURSIVE remainder(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM remainder WHERE k < 8),
lookup AS (SELECT list(c ORDER BY i) AS t FROM remainder WHERE k = 8),
docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {SQL_WORDS.format('text')} AS w FROM documents),
doc_words AS MATERIALIZED (SELECT r, x, count(*) AS n FROM (SELECT r, unnest(w) AS x FROM docs) GROUP BY r, x),
item_words AS MATERIALIZED (SELECT x, count(*) AS n FROM (SELECT unnest({SQL_WORDS.format('text')}) AS x FROM benchmark) GROUP BY x),
vocabulary AS MATERIALIZED (
  SELECT x, xor(4294967295, list_reduce(list_transform(range(octet_length(encode(x)) + 1),
      lambda i: CASE WHEN i = 0 THEN 4294967295 ELSE ('0x' || substr(hex(encode(x)), 2 * i - 1, 2))::BIGINT END),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % {BUCKETS} AS bucket
  FROM (SELECT x FROM doc_words UNION SELECT x FROM item_words), lookup),
source AS (SELECT bucket, sum(n)::DOUBLE AS s FROM doc_words JOIN vocabulary USING (x) GROUP BY bucket),
wanted AS (SELECT bucket, sum(n)::DOUBLE AS t FROM item_words JOIN vocabulary USING (x) GROUP BY bucket),
totals AS (SELECT coalesce((SELECT sum(s) FROM source), 0)::DOUBLE AS s_all, coalesce((SELECT sum(t) FROM wanted), 0)::DOUBLE AS t_all),
gain AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (s_all + {BUCKETS}) / ((s + 1) * (t_all + {BUCKETS}))))::BIGINT AS g
  FROM source LEFT JOIN wanted USING (bucket), totals),
weights AS (SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * g)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM doc_words JOIN vocabulary USING (x) JOIN gain USING (bucket) GROUP BY r),
scores AS (
  SELECT r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (r)),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id, r) AS rank, count(*) OVER () AS n
  FROM scores WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, rank::BIGINT AS rank
FROM scores LEFT JOIN (SELECT r, rank FROM ranked WHERE rank <= n * {PERCENT} // 100) USING (r)"""
