"""Approximate nearest neighbours by a permutation index.

Pivot vectors (a bounded sample, by order of a hash, per dimension; about four
times the root of the row count, at least ``LEAST_PIVOTS``, at most
``MOST_PIVOTS``) see the space from different sides.  Every row is posted in the
inverted files of its ``POSTED`` nearest pivots, and represented by the order of
the first ``RANKED`` pivots by nearness.  A query visits the files of its own
nearest pivots, ranks the rows found there by the footrule distance of the
permutations (the sum of the pivots' rank differences), and reranks the best
``RERANK`` of them by the exact cosine of the original vectors.

There is one index.  Files of neighbouring pivots lie together in bundles of
about ``BLOCK_ROWS`` rows (the files' sizes are counted first; a file beyond that
is split by a hash), rows go to the bundles of their files, and a query goes only
to the bundles that hold files it visits.  A task holds one bundle at a time
and streams the queries past it; it returns k rows a query and bundle.

How many files a query visits is measured, not guessed: ``SAMPLE_QUERIES`` queries
are compared with every row in the pass that counts the files, and the least
number of files that holds ``TARGET`` of their true neighbours is taken for all;
a query whose files hold fewer than ``LEAST_FOUND`` rows visits more of them.
The share of rows touched follows from the data: it falls as the table grows
(more pivots, nearer neighbours), slowly where the vectors have no structure.

Exact repeats of a row are dropped before they are dealt, so a bundle is bounded
however often a row or an id occurs.

Defined results: vectors that are null, zero or hold a null or a non-finite
component, and rows without an id, take no part; vectors meet only those of
their own dimension; a row never meets its own id, and an id found twice counts
once, with its best score; ties go to the smaller id; fewer candidates than k
give fewer rows (so up to ``LEAST_FOUND`` rows every row is found); an empty table
gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkdeck.llm.common import hash_below, ship

LEAST_PIVOTS = 256
MOST_PIVOTS = 16_384
RANKED = 256
POSTED = 2
RERANK = 0.25
LEAST_RERANK = 256
BLOCK_ROWS = 8_192
SAMPLE_QUERIES = 256
TARGET = 0.97
LEAST_FOUND = 1_024
#: Rows of a frame handed on at once.
CHUNK = 4_096

SURVEY = "dim int, kind int, item long, vec_id long, score double, n long"
RESULT = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Not null, finite throughout, not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def pivots_for(rows: int) -> int:
    """Pivots of so many rows: about four times the root, a power of two."""
    return min(MOST_PIVOTS, max(LEAST_PIVOTS, 2 ** math.ceil(math.log2(4 * math.sqrt(max(rows, 1))))))


def sample_rows(vectors: DataFrame, sizes: dict[int, int], wanted: dict[int, int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, unit vectors) of each dimension, at most ``wanted`` of each: the
    distinct rows with the smallest hashes."""
    key = F.xxhash64("vec_id", "v")
    likely = F.lit(False)
    for dim, n in sizes.items():
        likely = likely | ((F.col("dim") == dim) & hash_below(key, wanted[dim], n))
    limit = F.lit(0)
    for dim, n in wanted.items():
        limit = F.when(F.col("dim") == dim, F.lit(n)).otherwise(limit)
    rows = vectors.where(likely).dropDuplicates(["vec_id", "v"])
    w = Window.partitionBy("dim").orderBy(F.xxhash64(key), "vec_id", "v")
    out: dict[int, list] = {}
    for r in rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= limit).orderBy("dim", "n").collect():
        out.setdefault(r["dim"], []).append((r["vec_id"], r["v"]))
    return {d: (np.array([i for i, _ in x]), _unit(np.array([v for _, v in x], dtype=np.float64))) for d, x in out.items()}


def _unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)  # first by the largest part: squares stay finite
    x = x / big
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that keep their squares in range (exact, so
    cosines do not change)."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def nearest(unit: np.ndarray, pivots: np.ndarray, n: int) -> np.ndarray:
    """(rows, n) numbers of the nearest pivots, nearest first; of all, ties by number."""
    far = -(unit @ pivots.T)
    if n >= len(pivots):
        return np.argsort(far, axis=1, kind="stable")
    some = np.argpartition(far, n - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable"), 1)


def _matrix(v: pd.Series) -> np.ndarray:
    return np.stack(v.to_numpy()).astype(np.float64)


def permutations(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) rank of each pivot by nearness; ties by pivot number."""
    order = nearest(unit, pivots, len(pivots))
    kind = np.uint8 if len(pivots) <= 256 else np.int32
    rank = np.empty(order.shape, dtype=kind)
    np.put_along_axis(rank, order, np.arange(order.shape[1], dtype=kind)[None, :], axis=1)
    return rank


class Block:
    """Inverted files and permutations of one bundle of vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, files: list, pivots: np.ndarray):
        self.ids, self.x, self.pivots = ids, x, pivots[:RANKED]
        self.unit = _unit(x)
        self.rank = permutations(self.unit, self.pivots)
        at: dict[int, list[int]] = {}
        for row, each in enumerate(files):
            for f in each:
                at.setdefault(int(f), []).append(row)
        self.files = {f: np.array(rows) for f, rows in at.items()}

    def search(self, ids: np.ndarray, x: np.ndarray, files: list, k: int, rerank: float, least: int) -> list[tuple[int, int, float]]:
        out = []
        unit = _unit(x)
        for qid, q, u, rank, visited in zip(ids, x, unit, permutations(unit, self.pivots), files, strict=True):
            found = np.zeros(len(self.ids), dtype=bool)
            for f in visited:
                if int(f) in self.files:
                    found[self.files[int(f)]] = True
            found &= self.ids != qid
            at = np.flatnonzero(found)
            if not len(at):
                continue
            keep = max(least, int(np.ceil(rerank * len(at))))
            if keep < len(at):
                other = self.rank[at]
                far = (np.maximum(other, rank) - np.minimum(other, rank)).sum(1, dtype=np.int64)
                at = at[far <= np.partition(far, keep - 1)[keep - 1]]  # with all ties
            rough = self.unit[at] @ u
            if len(at) > k:  # whatever may be among the first k ids after rounding
                order = np.argsort(-rough, kind="stable")
                _, first = np.unique(self.ids[at][order], return_index=True)
                if len(first) > k:
                    at = at[rough >= rough[order[np.sort(first)[k - 1]]] - 1e-9]
            # one way of summing for every row, so equal vectors get equal scores
            y, q = _scaled(self.x[at]), _scaled(q)
            score = (y * q).sum(1) / (np.sqrt((y * y).sum(1)) * np.sqrt((q * q).sum()))
            order = np.lexsort((self.ids[at], -score))
            _, first = np.unique(self.ids[at][order], return_index=True)
            order = order[np.sort(first)][:k]
            out += [(int(qid), int(self.ids[i]), float(s)) for i, s in zip(at[order], score[order], strict=True)]
        return out


# ------------------------------------------------------------------- index --

def bundles(pivots: np.ndarray, counts: np.ndarray, rows: int) -> list[np.ndarray]:
    """Groups of files of neighbouring pivots, each of at most ``rows`` rows or one
    file: halved at the middle of the counts along the line of two far pivots."""
    out, left = [], [np.arange(len(pivots))]
    while left:
        part = left.pop()
        if len(part) == 1 or counts[part].sum() <= rows:
            out.append(part)
            continue
        x = pivots[part]
        a = x[np.argmin(x @ x[0])]
        along = x @ (a - x[np.argmin(x @ a)])
        part = part[np.argsort(along, kind="stable")]
        run = np.cumsum(counts[part])
        cut = min(max(1, int(np.searchsorted(run, run[-1] / 2)) + 1), len(part) - 1)
        left += [part[cut:], part[:cut]]
    return out


class Index:
    """Of one dimension: pivots, the bundle of each file, the parts of each
    bundle, and the number of files a query visits.  Bundles are numbered from
    ``start``."""

    def __init__(self, pivots: np.ndarray, counts: np.ndarray, visit: int, rows: int, start: int):
        self.pivots, self.visit, self.counts = pivots, visit, counts
        groups = bundles(pivots, counts, rows)
        self.home = np.empty(len(pivots), dtype=np.int64)
        for g, files in enumerate(groups):
            self.home[files] = g
        self.parts = np.array([max(1, -(-int(counts[files].sum()) // rows)) for files in groups])
        self.first = start + np.concatenate([[0], np.cumsum(self.parts)])

    def visited(self, order: np.ndarray) -> np.ndarray:
        """Of all files, nearest first, those a query visits."""
        enough = np.searchsorted(np.cumsum(self.counts[order]), LEAST_FOUND) + 1
        return order[:max(self.visit, int(enough))]

    def deal(self, files: np.ndarray, part: int | None) -> Iterator[tuple[int, list[int]]]:
        """(bundle, files there) of a row of hash ``part``; of a query (None), in
        every part."""
        homes = self.home[files]
        for g in np.unique(homes):
            here = files[homes == g].tolist()
            for s in range(self.parts[g]) if part is None else (part % self.parts[g],):
                yield int(self.first[g] + s), here


def survey(v: DataFrame, pivots: dict[int, np.ndarray], sample: dict[int, tuple[np.ndarray, np.ndarray]], k: int,
           posted: int, target: float) -> tuple[dict[int, np.ndarray], dict[int, int]]:
    """Rows of each file, and the files a query must visit: one pass that brings
    home one row a file and k rows a sampled query."""
    ranks = {d: permutations(u, pivots[d]).astype(np.int64) for d, (_, u) in sample.items()}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = {d: np.zeros(len(p), dtype=np.int64) for d, p in pivots.items()}
        best: dict[int, pd.DataFrame] = {}
        for b in batches:
            for dim, part in b.groupby("dim"):
                ids, unit = part["vec_id"].to_numpy(), _unit(_matrix(part["v"]))
                files = nearest(unit, pivots[dim], posted)
                counts[dim] += np.bincount(files.ravel(), minlength=len(counts[dim]))
                if dim not in sample:
                    continue
                own, u = sample[dim]
                score = u @ unit.T
                score[own[:, None] == ids[None, :]] = -np.inf
                n = min(k, len(ids))
                at = np.argpartition(-score, n - 1, axis=1)[:, :n]
                who = np.repeat(np.arange(len(u)), n)
                at = at.ravel()
                new = pd.DataFrame({"item": who, "vec_id": ids[at], "score": score[who, at],
                                    "n": ranks[dim][who[:, None], files[at]].min(1)})
                new = pd.concat([best[dim], new]) if dim in best else new
                new = new[np.isfinite(new["score"])].sort_values("score", ascending=False)
                best[dim] = new.drop_duplicates(["item", "vec_id"]).groupby("item").head(k)
        for dim, c in counts.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"dim": dim, "kind": 0, "item": at, "vec_id": 0, "score": 0.0, "n": c[at]})
        for dim, x in best.items():
            yield x.assign(dim=dim, kind=1)[["dim", "kind", "item", "vec_id", "score", "n"]]

    rows = v.select("dim", "vec_id", "v").mapInPandas(run, SURVEY).groupBy("dim", "kind", "item", "vec_id").agg(
        F.max("score").alias("score"), F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("held"), F.min("n").alias("need"))
    w = Window.partitionBy("dim", "kind", "item").orderBy(F.desc("score"), "vec_id")
    counts = {d: np.zeros(len(p), dtype=np.int64) for d, p in pivots.items()}
    needs: dict[int, list[int]] = {}
    for r in rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).collect():
        if r["kind"] == 0:
            counts[r["dim"]][r["item"]] = r["held"]
        else:
            needs.setdefault(r["dim"], []).append(r["need"])
    return counts, {d: sorted(x)[math.ceil(target * len(x)) - 1] + 1 for d, x in needs.items()}


def search(vectors: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", posted: int = POSTED,
           pivots: int | None = None, rerank: float = RERANK, block_rows: int = BLOCK_ROWS,
           block_queries: int = CHUNK, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query row.
    ``vectors`` needs vec_id and the vector column; ``is_query`` is a condition
    on vec_id; ``pivots`` are fitted to the row count if not given."""
    spark = vectors.sparkSession
    ship(spark)
    kind = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    v = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("v"))
         .where(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v")))
    sizes = v.select("dim", is_query.alias("q")).groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("q").alias("nq")).collect()  # one row per dimension
    rows = {r["dim"]: r["n"] for r in sizes}
    asked = {r["dim"]: r["nq"] for r in sizes if r["nq"]}
    seen = {d: p for d, (_, p) in sample_rows(v, rows, {d: pivots or pivots_for(n) for d, n in rows.items()}).items()}
    sample = sample_rows(v.where(is_query), asked, dict.fromkeys(asked, SAMPLE_QUERIES))
    counts, visit = survey(v, seen, sample, k, posted, target)
    index: dict[int, Index] = {}
    start = 0
    for dim, p in seen.items():
        index[dim] = Index(p, counts[dim], visit.get(dim, 0), block_rows, start)
        start = int(index[dim].first[-1])

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["bundle", "kind", "vec_id", "v", "files"]
        for b in batches:
            out = []
            for dim, part in b.groupby("dim"):
                ix = index[dim]
                unit = _unit(_matrix(part["v"]))
                order = nearest(unit, ix.pivots, posted)
                for i, x, q, h, u, near in zip(part["vec_id"], part["v"], part["q"], part["h"], unit, order, strict=True):
                    out += [(g, 0, i, x, files) for g, files in ix.deal(near, h)]
                    if q:
                        near = nearest(u[None, :], ix.pivots, len(ix.pivots))[0]
                        out += [(g, 1, i, x, files) for g, files in ix.deal(ix.visited(near), None)]
                    if len(out) >= block_queries:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
            if out:
                yield pd.DataFrame(out, columns=columns)

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle, held, block = None, [], None
        for b in batches:
            for (g, kind), part in b.groupby(["bundle", "kind"]):  # sorted: a bundle's rows, then its queries
                if g != bundle:
                    bundle, held, block = g, [], None
                if kind == 0:
                    held.append(part)
                    continue
                if block is None:
                    if not held:
                        continue
                    whole = pd.concat(held)
                    x = _matrix(whole["v"])
                    block, held = Block(whole["vec_id"].to_numpy(), x, whole["files"].tolist(), seen[x.shape[1]]), []
                found = block.search(part["vec_id"].to_numpy(), _matrix(part["v"]), part["files"].tolist(), k, rerank, LEAST_RERANK)
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    dealt = (v.dropDuplicates(["vec_id", "v"])
             .select("dim", "vec_id", "v", is_query.alias("q"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)).alias("h"))
             .mapInPandas(deal, f"bundle long, kind int, vec_id long, v {kind}, files array<int>"))
    found = dealt.repartition("bundle").sortWithinPartitions("bundle", "kind").mapInPandas(meet, RESULT)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
