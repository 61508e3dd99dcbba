"""Ranked lexical search: accumulator-limited term-at-a-time evaluation.

A query item is the set of its terms; a document scores the sum of the weights
of those it holds, damped by their occurrences and the document's length
(whole numbers throughout, so equal scores are equal everywhere).

*Method.*  Documents meet the items where they are scanned.  A task gathers a
block of documents into posting lists of the items' terms and evaluates each
item term at a time, rarest term first.  A document gets an accumulator at the
first of the terms it holds, as long as the bounds of the terms still to come
(the largest contribution in the block) together can reach the score of the
item's k-th best partial score so far; then no accumulator is made any more,
and those there are go on to be updated exactly.  The k-th score found in a
block carries over to the task's next blocks, which therefore open fewer
accumulators.  Bounds that just equal the k-th score still open one, since the
smaller id wins ties.

*Scale.*  Two scans: one counts documents, terms and the documents of each
query term; one evaluates.  No posting is shuffled; each task yields k rows an
item.  The items go to the tasks in passes of about ``TERMS_A_PASS`` terms
(items are dealt to passes by a hash of their id; an item is never split), so
what is broadcast is bounded whatever the number of items.  Long texts are cut
into pieces at word ends; a block holds its postings only.

Defined results: a null text, or one without a term, is no document; every row
is a document, repeated ones too; a null doc_id comes last among equal scores;
rows of one item_id form one item with the terms of all its texts (null is an
id like others); items without terms, or without a document that scores above
0, give no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkdeck.llm.common import SQL_WORDS, saved, ship, words
from sparkdeck.llm.textnp import split_words

TOP = 10
TERMS_A_PASS = 100_000
#: Documents and postings of one block.
BLOCK_DOCS, BLOCK_POSTINGS = 16_384, 2_000_000
#: Fixed values of the score: lengths count 90 %, damping 0.8, whole numbers.
SCALE, TF, LENGTH, FLOOR, SHARE = 1_000_000_000, 1000, 8, 10, 90
LAST_ID = 2**63 - 1


def term_ids(text: str | None, vocabulary: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """(terms of the text, query terms it holds, their occurrences)."""
    n, found = 0, []
    for w in split_words(text):
        ids = np.fromiter(map(vocabulary.get, w, repeat(-1)), np.int32, len(w))
        n += len(ids)
        found.append(np.unique(ids[ids >= 0], return_counts=True))
    if len(found) == 1:
        return n, *found[0]
    ids, back = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return n, ids, np.bincount(back, np.concatenate([f[1] for f in found]), len(ids)).astype(np.int64)


def statistics(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """(documents, their terms, documents of each query term)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(len(vocabulary) + 2, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                n, ids, _ = term_ids(text, vocabulary)
                df[ids] += 1
                df[-2:] += (n > 0, n)
        at = np.flatnonzero(df)
        yield pd.DataFrame({"term": at.astype(np.int64), "n": df[at]})

    df = np.zeros(len(vocabulary) + 2, dtype=np.int64)
    found = docs.select("text").mapInPandas(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in found.collect():  # at most a row for each term of a pass
        df[r["term"]] = r["n"]
    return int(df[-2]), int(df[-1]), df[:-2]


class Block:
    """Posting lists of the query terms in a block of documents."""

    def __init__(self, weight: np.ndarray, documents: int, terms: int, block_docs: int = BLOCK_DOCS):
        self.weight, self.documents, self.terms, self.block_docs = weight, documents, terms, block_docs
        self.clear()

    def clear(self) -> None:
        self.ids: list[int] = []
        self.found: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.postings = 0

    def add(self, doc_id: int, n: int, term: np.ndarray, tf: np.ndarray) -> None:
        # a Python number: no overflow, however long the text or large the table
        m = FLOOR + (SHARE * n * self.documents) // self.terms
        self.ids.append(doc_id)
        self.found.append((term, tf, m))
        self.postings += len(term)

    @property
    def full(self) -> bool:
        return len(self.ids) >= self.block_docs or self.postings >= BLOCK_POSTINGS

    def invert(self) -> None:
        """Postings by term: document, contribution, and each list's largest."""
        sizes = [len(t) for t, _, _ in self.found]
        term = np.concatenate([t for t, _, _ in self.found]).astype(np.int64)
        tf = np.concatenate([c for _, c, _ in self.found]).astype(np.int64)
        m = np.repeat(np.array([m for _, _, m in self.found], dtype=np.int64), sizes)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(term, kind="stable")
        self.doc = doc[order]
        term = term[order]
        self.gives = self.weight[term] * ((SCALE * tf[order]) // (TF * tf[order] + LENGTH * m[order]))
        self.start = np.searchsorted(term, np.arange(len(self.weight) + 1))
        self.most = np.zeros(len(self.weight), dtype=np.int64)
        np.maximum.at(self.most, term, self.gives)
        self.id = np.array(self.ids, dtype=np.int64)

    def evaluate(self, item: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
        """Best (score, id) of the item's terms (rarest first), those below
        ``least`` need not be found."""
        score = np.zeros(len(self.id), dtype=np.int64)
        has = np.zeros(len(self.id), dtype=bool)
        bound = np.cumsum(self.most[item][::-1])[::-1]  # of this term and all later ones
        opened = True
        for term, left in zip(item, bound, strict=True):
            if opened and left < least:
                opened = False
            doc, gives = self.doc[self.start[term]:self.start[term + 1]], self.gives[self.start[term]:self.start[term + 1]]
            if not opened:
                seen = has[doc]
                doc, gives = doc[seen], gives[seen]
            score[doc] += gives
            if opened and len(doc):
                has[doc] = True
                partial = score[has]
                if len(partial) >= k:
                    least = max(least, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
        at = np.flatnonzero(score > 0)
        if len(at) > k:
            at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
        at = at[np.lexsort((self.id[at], -score[at]))[:k]]
        return list(zip(score[at].tolist(), self.id[at].tolist(), strict=True))


def best(old: list[tuple[int, int]], new: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of both: highest score, then smallest id."""
    return sorted(old + new, key=lambda x: (-x[0], x[1]))[:k]


def search(docs: DataFrame, items: DataFrame, k: int = TOP, terms_a_pass: int = TERMS_A_PASS,
           block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    ship(spark)
    kind = items.schema["item_id"].dataType.simpleString()
    pairs = saved(items.select("item_id", F.explode(words(F.col("text"))).alias("term")).distinct(), "items")
    passes = max(1, -(-pairs.count() // terms_a_pass))
    found = [one_pass(docs, pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p), k, kind, block_docs)
             for p in range(passes)]
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    # a null id orders last in tasks (LAST_ID) and here
    w = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def one_pass(docs: DataFrame, pairs: DataFrame, k: int, kind: str, block_docs: int) -> DataFrame:
    """(item_id, doc_id, score): each task's best rows for the items of a pass."""
    spark = docs.sparkSession
    of_item: dict[object, list[bytes]] = {}
    for r in pairs.collect():  # about TERMS_A_PASS rows
        of_item.setdefault(r["item_id"], []).append(r["term"].encode("utf-8", "surrogatepass"))
    vocabulary = {t: i for i, t in enumerate(sorted({t for ts in of_item.values() for t in ts}))}
    documents, terms, df = statistics(docs, vocabulary)
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
    names = list(of_item)
    queries = []
    for name in names:
        at = np.array(sorted(vocabulary[t] for t in of_item[name]), dtype=np.int64)
        at = at[(df[at] > 0) & (weight[at] > 0)]
        queries.append(at[np.argsort(df[at], kind="stable")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, top = Block(weight, documents, terms, block_docs), [[] for _ in queries]

        def finish() -> None:
            block.invert()
            for i, q in enumerate(queries):
                least = top[i][-1][0] if len(top[i]) == k else 1
                if len(q) and (new := block.evaluate(q, k, least)):
                    top[i] = best(top[i], new, k)
            block.clear()

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                n, ids, tf = term_ids(text, vocabulary)
                if len(ids):
                    block.add(LAST_ID if doc_id is None else int(doc_id), n, ids, tf)
                    if block.full:
                        finish()
        if block.ids:
            finish()
        rows = [(i, d, s) for i, t in enumerate(top) for s, d in t]
        yield pd.DataFrame(rows, columns=["item", "doc_id", "score"], dtype="int64")

    if not names:
        return spark.createDataFrame([], f"item_id {kind}, doc_id long, score long")
    # the id travels as text: exact for every long
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, "item long, doc_id long, score long")
    item_ids = spark.createDataFrame(list(enumerate(names)), f"item long, item_id {kind}")
    return rows.join(F.broadcast(item_ids), "item").select(
        "item_id", F.nullif("doc_id", F.lit(LAST_ID)).alias("doc_id"), "score")


SEARCH_SQL = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {SQL_WORDS.format('text')} AS w FROM documents),
sizes AS MATERIALIZED (SELECT r, doc_id, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
totals AS MATERIALIZED (SELECT count(*)::BIGINT AS n_all, sum(n)::BIGINT AS l_all FROM sizes),
terms AS MATERIALIZED (SELECT DISTINCT item_id, x FROM (SELECT item_id, unnest({SQL_WORDS.format('text')}) AS x FROM benchmark)),
tf AS MATERIALIZED (SELECT r, x, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS x FROM docs)
  WHERE x IN (SELECT x FROM terms) GROUP BY r, x),
weights AS (SELECT x, floor(1000 * ln((2 * any_value(n_all) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, totals GROUP BY x),
scores AS (
  SELECT item_id, r, doc_id, sum(w * (({SCALE} * tf) // ({TF} * tf + {LENGTH} * ({FLOOR} + ({SHARE} * n * n_all) // l_all))))::BIGINT AS score
  FROM terms JOIN tf USING (x) JOIN weights USING (x) JOIN sizes USING (r), totals GROUP BY item_id, r, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= {TOP}"""
