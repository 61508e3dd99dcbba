"""Near-duplicate documents by BagMinHash over word shingles.

A text is the multiset of its shingles of five words.  Its similarity to another
text is the weighted Jaccard coefficient of the two multisets; texts of 0.8 or
more are linked, and linked texts (through others, too) form one class.

*Signatures.*  Every shingle owns a Poisson process over its weight axis (the
number of times it occurs), cut into dyadic levels [0,1), [1,2), [2,4), ...; a
shingle of weight w looks at log2(w) + 1 levels, not at w units.  Each point of
a process has an arrival time, a component of the signature and, within its
level, a place on the axis; it counts if its place lies under the weight, which
is the hierarchical split of a level that the weight covers in part.  A
component is its earliest counted point.  Points are made from hashes, in order
of time, until the latest component is reached, so a text costs about
(shingles + m log m) points.  Two texts agree in a component with probability
equal to their weighted Jaccard coefficient (unbiased).

*Candidates.*  ``BANDS`` bands of ``ROWS`` components: two texts of similarity
0.8 share no band with probability (1 - 0.8^ROWS)^BANDS (about 5e-6).

*Links.*  Identical texts are one node from the start (by digest).  Round 1
verifies each member of a band bucket against the bucket's hub, the member that
shares buckets with most others (in a group of edited copies, one near the
original).  Members of one component need no comparison among themselves;
round 2 verifies the pairs of members whose components still differ, except
those that an exact prefix filter on their shingles rules out.  So no link
between candidates is lost, and a group of thousands of near copies costs about
one comparison a member.  Verification is exact: the multisets are compared in
built-in array expressions.

*Scale.*  Texts never leave the scan except those in a bucket with another
text; buckets are joined, not collected; components are found by repeated
minimum-label exchange on DataFrames written to the shared folder.  Digests of
a hot text meet in partial aggregates and in joins that Spark can split.

Defined results: a null text, or one without a word, links with nothing and is
its own class (its id); a text of one to four words is one shingle; identical
texts share a class; the class id is the smallest doc_id of the class (null
only if all its ids are); repeated rows each get a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdeck.llm.common import WORD, fresh, saved, ship
from sparkdeck.llm.textnp import groups, mix, shingle_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4

_SEED_TIME, _SEED_SLOT, _SEED_PLACE, _SEED_BAND = (np.uint64(x) for x in (
    0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))


def _unit(h: np.ndarray) -> np.ndarray:
    """Hashes to numbers in (0, 1)."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _times(seed: np.uint64, k: int) -> np.uint64:
    return np.uint64(int(seed) * k % (1 << 64))


def multiset(shingles: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) and their weights, ordered by text."""
    order = np.lexsort((shingles, text))
    s, t = shingles[order], text[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    return s[at], t[at], np.diff(np.concatenate([at, [len(s)]]))


def signatures(shingles: np.ndarray, text: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """(n, m) earliest counted points, infinite for texts without shingles."""
    best = np.full((n, m), np.inf)
    flat = best.ravel()
    # one process for each shingle and level: [0,1), [1,2), [2,4), ...
    ids, owner, low, high, top = [], [], [], [], []
    level, start, width = 0, 0, 1
    left = np.arange(len(shingles))
    while len(left):
        ids.append(mix(shingles[left] + _times(_SEED_PLACE, level)))
        owner.append(text[left])
        low.append(np.full(len(left), float(start)))
        high.append(np.full(len(left), float(width)))
        top.append(weight[left].astype(np.float64))
        start += width
        width = start
        level += 1
        left = left[weight[left] > start]
    if not ids:
        return best
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    low, width_, top = np.concatenate(low), np.concatenate(high), np.concatenate(top)
    time = np.zeros(len(ids))
    point = 0
    block = 1
    while len(ids):
        for _ in range(block):
            point += 1
            h = mix(ids + _times(_SEED_TIME, point))
            time = time - np.log(_unit(h)) / (width_ * m)
            slot = (mix(h ^ _SEED_SLOT) % np.uint64(m)).astype(np.int64)
            counts = low + width_ * _unit(mix(h ^ _SEED_PLACE)) < top if point == 1 or (width_ > 1).any() else slice(None)
            np.minimum.at(flat, (owner * m + slot)[counts], time[counts])
        latest = best.max(axis=1)
        go = time < latest[owner]
        if not go.all():
            ids, owner, low, width_, top, time = ids[go], owner[go], low[go], width_[go], top[go], time[go]
        block = min(16, block + 1) if len(ids) < 4096 else 1
    return best


def band_keys(best: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands) 64-bit keys; the band number is part of the key."""
    v = best.view(np.uint64).reshape(len(best), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _SEED_BAND, (len(best), bands)).copy()
    for r in range(rows):
        key = mix(key + v[:, :, r] * np.uint64(0xD6E8FEB86659FD93))
    return key


def text_bands(texts: list[str | None], shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> list[list[int] | None]:
    """Band keys of each text; None without a word."""
    out: list[list[int] | None] = []
    for a, b in groups(texts):
        s, t = shingle_hashes(*word_hashes(texts[a:b]), shingle)
        s, t, w = multiset(s, t)
        keys = band_keys(signatures(s, t, w, b - a, bands * rows), bands, rows).view(np.int64)
        has = np.bincount(t, minlength=b - a) > 0
        out += [k.tolist() if ok else None for k, ok in zip(keys, has, strict=True)]
    return out


def text_multisets(texts: list[str | None], shingle: int = SHINGLE) -> list[list[int]]:
    """Each text's multiset as a set: the j-th occurrence of a shingle is an
    element of its own (first occurrences are the shingles themselves)."""
    out: list[list[int]] = []
    for a, b in groups(texts):
        s, t = shingle_hashes(*word_hashes(texts[a:b]), shingle)
        d, td, w = multiset(s, t)
        nth = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
        e = np.repeat(d, w)
        e = np.where(nth > 0, mix(e + nth.astype(np.uint64) * _SEED_SLOT), e).view(np.int64)
        ends = np.searchsorted(np.repeat(td, w), np.arange(b - a + 1))
        out += [e[x:y].tolist() for x, y in zip(ends[:-1], ends[1:], strict=True)]
    return out


# ------------------------------------------------------------------ stages --

def _digest(text: Column) -> Column:
    """16 bytes that stand for a text; null for one without a word."""
    return F.when(text.rlike(WORD), F.unhex(F.md5(text)))


def banded(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(digest, keys) of every row of ``docs`` (digest, text) with a word."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys = text_bands(b["text"].tolist(), shingle, bands, rows)
            has = [k is not None for k in keys]
            yield pd.DataFrame({"digest": b["digest"][has], "keys": [k for k in keys if k is not None]})

    return docs.where(F.col("digest").isNotNull()).mapInPandas(run, "digest binary, keys array<bigint>")


def multisets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(digest, bag) for rows (digest, text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"digest": b["digest"], "bag": text_multisets(b["text"].tolist(), shingle)})

    return docs.mapInPandas(run, "digest binary, bag array<bigint>")


def verified(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose multisets have at least the similarity."""
    j = (pairs.join(bags.select(F.col("digest").alias("a"), F.col("bag").alias("x")), "a")
         .join(bags.select(F.col("digest").alias("b"), F.col("bag").alias("y")), "b"))
    both, nx, ny = F.size(F.array_intersect("x", "y")), F.size("x"), F.size("y")
    j = j.where((F.least(nx, ny) >= similarity * F.greatest(nx, ny)) & (both >= similarity * (nx + ny - both)))
    return j.select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node of its
    component.  Large-star and small-star steps until nothing changes; every
    step is a join and an aggregation of the links, written out."""
    both = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = saved(both, "links")
    while True:
        # large star: every larger neighbour of a node links to its smallest neighbour
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = near.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its smaller neighbours link to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v")))).where("u <> v").distinct()
        new = saved(small, "links")
        same = new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty()
        edges = new
        if same:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def duplicate_roots(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """(node, root) over the digests of ``docs`` (digest, text): every text with
    a link to a different text, and the smallest digest of its class."""
    keyed = saved(banded(docs, shingle, bands, rows), "bands")
    each = keyed.select("digest", F.explode("keys").alias("key"))
    shared = (each.groupBy("key").agg(F.min("digest").alias("one"), F.max("digest").alias("other"))
              .where("one <> other").select("key"))
    members = saved(each.join(shared, "key").distinct(), "members")
    # a text that meets many others is near the middle of its group
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    met = members.join(sizes, "key").groupBy("digest").agg(F.sum("n").alias("met"))
    hubs = members.join(met, "digest").groupBy("key").agg(F.max_by("digest", F.struct("met", "digest")).alias("hub"))
    first = saved(members.join(hubs, "key").where("digest <> hub")
                  .select(F.col("hub").alias("a"), F.col("digest").alias("b")).distinct(), "first")
    texts = docs.join(members.select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text"))
    bags = saved(multisets(texts, shingle), "bags")
    links = saved(verified(first, bags, similarity), "pairs")
    roots = saved(components(links), "roots")
    more = saved(verified(open_pairs(members, roots, bags, similarity).join(first, ["a", "b"], "left_anti"), bags, similarity), "pairs")
    if more.isEmpty():
        return roots
    return components(links.union(more))


def open_pairs(members: DataFrame, roots: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of texts of different components that share a bucket and
    may reach the similarity; none that does is missing.

    Of each bucket, all but its largest component ask.  Texts that ask meet
    the others of open buckets by an exact prefix filter: with elements ordered
    rare first, a pair of the similarity s needs ``o = s / (1 + s) * (|a| + |b|)``
    common elements, so its first common one lies within ``|a| - o`` and
    ``|b| - o`` of the starts."""
    m = (members.join(roots, F.col("digest") == F.col("node"), "left")
         .select("key", "digest", F.coalesce("root", "digest").alias("root")))
    parts = m.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    biggest = (parts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("big"), F.count(F.lit(1)).alias("parts"))
               .where("parts > 1").select("key", "big"))
    open_ = saved(m.join(biggest, "key").groupBy("digest", "root").agg(F.max(F.col("root") != F.col("big")).alias("asks")), "open")
    element = open_.join(bags, "digest").select("digest", "root", "asks", F.size("bag").alias("n"), F.explode("bag").alias("e"))
    often = element.groupBy("e").agg(F.count(F.lit(1)).alias("often"))
    ranked = element.join(often, "e").groupBy("digest", "root", "asks", "n").agg(
        F.array_sort(F.collect_list(F.struct("often", "e"))).alias("bag"))
    # no pair needs more than s * |a| common elements from the larger side
    prefix = saved(ranked.select("digest", "root", "asks", "n", F.posexplode(F.transform(F.slice(
        "bag", F.lit(1), F.col("n") - F.ceil(similarity * F.col("n") - 1e-9).cast("int") + 1), lambda x: x["e"])).alias("i", "e")), "prefix")
    x = prefix.where("asks").select("e", F.col("digest").alias("x"), F.col("root").alias("rx"), F.col("n").alias("nx"), F.col("i").alias("ix"))
    y = prefix.select("e", F.col("digest").alias("y"), F.col("root").alias("ry"), F.col("n").alias("ny"), F.col("i").alias("iy"), "asks")
    need = F.ceil(similarity / (1 + similarity) * (F.col("nx") + F.col("ny")) - 1e-9)
    close = F.least("nx", "ny") >= similarity * F.greatest("nx", "ny")
    met = (x["e"] == y["e"]) & (F.col("rx") != F.col("ry")) & (~F.col("asks") | (F.col("x") < F.col("y"))) & close \
        & (F.col("nx") - F.col("ix") >= need) & (F.col("ny") - F.col("iy") >= need)
    return x.join(y, met).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def prepared(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("digest", _digest(F.col("text")))


def classes(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Per document row: doc_id, class_id (smallest doc_id of its class),
    is_duplicate (its class has another text or another row)."""
    ship(docs.sparkSession)
    base = prepared(docs)
    roots = duplicate_roots(base.select("digest", "text"), shingle, similarity)
    # digests stand for texts; a row without one stands for itself
    own = base.select("doc_id", "digest")
    named = own.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    named = named.join(roots, F.col("digest") == F.col("node"), "left").select(
        "digest", F.coalesce("root", "digest").alias("root"), "least", "n")
    whole = named.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_rows"))
    labels = named.select("digest", "root").join(whole, "root").select("digest", "class_id", "class_rows")
    rows = own.where(F.col("digest").isNotNull()).join(labels, "digest").select(
        "doc_id", "class_id", (F.col("class_rows") > 1).alias("is_duplicate"))
    alone = own.where(F.col("digest").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(False).alias("is_duplicate"))
    return rows.unionByName(alone)


def keep_one(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` (all columns) with one row of each class: that of its smallest
    (doc_id, digest).  Rows without a word all stay."""
    ship(docs.sparkSession)
    roots = duplicate_roots(prepared(docs).select("digest", "text"), shingle, similarity)
    digest = _digest(F.coalesce(F.col("text"), F.lit("")))
    own = prepared(docs).where(F.col("digest").isNotNull())
    # one line per text: its smallest id (null only where there is no other)
    least = own.groupBy("digest").agg(F.min("doc_id").alias("id"))
    first = (least.join(roots, F.col("digest") == F.col("node"), "left")
             .select(F.coalesce("root", "digest").alias("root"), F.struct(F.col("id").isNull().alias("none"), "id", "digest").alias("s"))
             .groupBy("root").agg(F.min("s").alias("s")))
    id_, own_ = fresh("id", docs.columns), fresh("digest", docs.columns)
    best = first.select(F.col("s.id").alias(id_), F.col("s.digest").alias(own_))
    kept = docs.join(best, (digest == F.col(own_)) & F.col("doc_id").eqNullSafe(F.col(id_)), "left_semi")
    # rows repeated with the id and the text of the row that stays
    once = kept.withColumn(own_, digest).dropDuplicates(["doc_id", own_]).drop(own_)
    return once.unionByName(docs.where(digest.isNull()))
