"""Near-duplicate vectors by a forest of random-projection trees.

*Forest.*  A tree splits the vectors by their projection on a random direction,
one direction a level, at the median of the node; vectors within a margin of
the median go to both sides (spill).  Directions come from a seed; medians from
a bounded sample of ``SAMPLE`` vectors.  A tree is as deep as the number of
vectors asks for: nodes that hold few sampled vectors lend theirs to the levels
below, each of which splits at their median along its own direction.  The
depth is the one with the fewest comparisons a row, and the number of trees
follows from it: a pair at the threshold shares no leaf with a probability of
about ``MISS`` at most.  Where splitting does not pay (vectors hardly farther
apart than the threshold), the depth is 0 and all pairs are compared in blocks.

*Leaves.*  All pairs of a leaf are compared by matrix products and the cosine is
verified in double precision.  A pair that shares several leaves is counted in
the one with the smallest number only, which both rows' own lists of leaves
tell; so links are counted, never emitted, and a leaf yields one count a row
and the edges of a spanning forest.  A leaf beyond ``LEAF_ROWS`` is dealt into
blocks that are compared two by two in tasks of their own: nothing is capped.

*Hot groups.*  Equal vectors are one row with a weight.  A group of near copies
that holds a large share of all rows shows in the sample: its members there
give a centre, and rows within half the threshold's angle of it (its ball) are
linked to each other by the triangle inequality, without a comparison.  Members
of a ball leave the forest.  Rows outside that are near enough to reach a
member are compared with the ball's members in blocks.

*Union.*  Components by minimum-label exchange on the edges (``components``);
the label is the smallest id itself, so no large component meets in one task.

Driver state: the sample, the trees' medians and the centres, all bounded by
parameters; one row for each dimension.

Defined results: every row gets a row; vectors that are null, zero or hold a
null or a non-finite component, and rows without an id, link with nothing (0
links, component and ``kept`` by their own id; a null id is not kept); vectors
meet only those of their own dimension; rows of equal vectors are links of each
other, also when they repeat an id; an empty table gives no rows.  Other
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from sparkdeck.llm.ann import _scaled, _unit, usable
from sparkdeck.llm.common import hash_below, saved, ship
from sparkdeck.llm.neardup import components

THRESHOLD = 0.95
#: Most rows of a leaf compared at once (beyond: in blocks of that size).
LEAF_ROWS = 2_048
#: Cost of a row's copy in one more leaf or block, in comparisons (it is shuffled).
COPY_COST = 2_048
SAMPLE = 16_384
#: Chance that a pair of exactly the threshold is never in one leaf.
MISS = 1e-5
#: Sampled vectors below which a node's sample serves all levels under it.
LEAST_SAMPLE = 16
#: Vectors looked at for hot groups, and members there that make a centre.
HOT_SAMPLE, HOT_LEAST = 1_024, 4
#: Leaves beyond ``LEAF_ROWS`` that are broadcast; more are joined.
BROADCAST_LEAVES = 100_000
#: Copies of a vector's result that its repeated rows spread over.
SALTS = 16
SEED = 20_240_512
#: Kept off the exact limits where only an inequality is used.
SLACK = 1e-6


class Forest:
    """Directions and medians of the trees for vectors of one dimension."""

    def __init__(self, sample: np.ndarray, rows: int, threshold: float, miss: float, depth: int | None = None):
        dim = sample.shape[1]
        # a pair at the threshold is this far apart along a random direction
        apart = math.sqrt(max(0.0, 2 - 2 * threshold) / dim)
        self.margin = apart / 2
        spread = max(float(np.sqrt(np.mean(sample.var(axis=0)))) if len(sample) else 1.0, 1e-9)
        # chance that a split parts such a pair: the density at the median times what
        # its distance exceeds the spill by (normal on both counts)
        excess = 2 * apart * (math.exp(-0.5) / math.sqrt(2 * math.pi) - 0.5 * math.erfc(1 / math.sqrt(2)))
        part = min(0.5, excess / (math.sqrt(2 * math.pi) * spread))
        grows = 1 + math.erf(self.margin / (spread * math.sqrt(2)))  # copies a level

        def trees(d: int) -> int:
            lost = 1 - (1 - part) ** d
            return 1 if lost == 0 else max(1, math.ceil(math.log(miss) / math.log(lost)))

        def cost(d: int) -> float:
            leaf = rows * (grows / 2) ** d
            # a leaf beyond LEAF_ROWS costs a copy for every block; half of that
            # leaves room for uneven leaves
            return trees(d) * grows ** d * (leaf + COPY_COST * max(1.0, 2 * leaf / LEAF_ROWS))

        self.depth = min(range(40), key=cost) if depth is None else depth
        self.trees = trees(self.depth)
        rng = np.random.default_rng(SEED + dim)
        self.directions = rng.standard_normal((self.trees, self.depth, dim))
        if self.depth:
            self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True)
        self.fit(sample)

    def fit(self, sample: np.ndarray) -> None:
        """Medians: ``fitted`` levels with one for each node, then one for each
        level below a node of the last fitted level."""
        self.fitted = min(self.depth, max(0, int(math.log2(max(1, len(sample)) / LEAST_SAMPLE))))
        self.upper, self.lower = [], []
        for t in range(self.trees):
            along = sample @ self.directions[t].T
            node = np.zeros(len(sample), dtype=np.int64)
            levels = []
            for level in range(self.fitted):
                cut = self._medians(along[:, level], node, 1 << level)
                levels.append(cut)
                node = 2 * node + (along[:, level] > cut[node])
            self.upper.append(levels)
            self.lower.append([self._medians(along[:, level], node, 1 << self.fitted) for level in range(self.fitted, self.depth)])

    @staticmethod
    def _medians(values: np.ndarray, node: np.ndarray, nodes: int) -> np.ndarray:
        order = np.lexsort((values, node))
        start = np.searchsorted(node[order], np.arange(nodes + 1))
        n = np.diff(start)
        middle = np.minimum(start[:-1] + n // 2, max(0, len(values) - 1))
        return np.where(n > 0, values[order][middle], 0.0) if len(values) else np.zeros(nodes)

    def leaves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf number) of every leaf a row lies in; numbers differ
        between trees."""
        rows, found = [], []
        for t in range(self.trees):
            along = unit @ self.directions[t].T
            row, node = np.arange(len(unit)), np.zeros(len(unit), dtype=np.int64)
            for level in range(self.depth):
                if level < self.fitted:
                    cut = self.upper[t][level][node]
                else:
                    cut = self.lower[t][level - self.fitted][node >> (level - self.fitted)]
                off = along[row, level] - cut
                left, right = off <= self.margin, off > -self.margin
                row = np.concatenate([row[left], row[right]])
                node = np.concatenate([2 * node[left], 2 * node[right] + 1])
            rows.append(row)
            found.append(node * self.trees + t)
        return np.concatenate(rows), np.concatenate(found)


def centres(sample: np.ndarray, threshold: float, least: int = HOT_LEAST) -> np.ndarray:
    """Unit centres of the groups that show in a sample: greedily the vector
    with most others within the threshold, and the mean of those."""
    near = sample @ sample.T >= threshold
    free = np.ones(len(sample), dtype=bool)
    out: list[np.ndarray] = []
    while True:
        count = (near & free[None, :]).sum(1) * free
        if not len(count) or count.max() < least:
            break
        group = near[int(count.argmax())] & free
        free &= ~group
        centre = sample[group].mean(0)
        centre /= np.linalg.norm(centre)
        # centres apart from each other by more than the threshold's angle
        if not out or max(centre @ c for c in out) < threshold:
            out.append(centre)
    return np.array(out).reshape(-1, sample.shape[1])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of matching rows, every pair summed in the same way."""
    x, y = _scaled(x), _scaled(y)
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (in x, in y) of the pairs with at least the threshold's cosine:
    a matrix product, and the sum of products itself where that is close."""
    rough = _unit(x) @ _unit(y).T
    i, j = np.nonzero(rough >= threshold - 1e-9)
    close = np.flatnonzero(rough[i, j] < threshold + 1e-9)
    if len(close):
        keep = np.ones(len(i), dtype=bool)
        keep[close] = cosines(x[i[close]], y[j[close]]) >= threshold
        i, j = i[keep], j[keep]
    return i, j


def met_before(leaf: int, lists: list[np.ndarray], i: np.ndarray, j: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """Whether the rows of each pair share a leaf of a smaller number."""
    kept = [x[x < leaf] for x in lists]
    table = np.full((len(kept), max(map(len, kept))), -1, dtype=np.int64)
    for r, x in enumerate(kept):
        table[r, :len(x)] = x
    out = np.zeros(len(i), dtype=bool)
    for s in range(0, len(i), step):
        one, two = table[i[s:s + step]], table[j[s:s + step]]
        for column in two.T:
            out[s:s + step] |= ((one == column[:, None]) & (column >= 0)[:, None]).any(1)
    return out


def lowest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the smallest place that the pairs connect it to."""
    root = np.arange(n)
    while True:
        old = root.copy()
        least = np.minimum(root[i], root[j])
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if (root == old).all():
            return root


#: A vector's node: (smallest id, key).  A count of links, or (``other``) an edge.
RESULT = "least long, key long, other_least long, other long, n long"


def compare(left: pd.DataFrame, right: pd.DataFrame | None, threshold: float, leaf: int | None) -> pd.DataFrame:
    """Link counts, and edges that connect what is linked, between two blocks or
    within one.  ``leaf``: pairs that share an earlier one are left to it."""
    a = left if right is None else pd.concat([left, right], ignore_index=True)
    weight = a["w"].to_numpy()
    x = np.stack(a["v"].to_numpy()).astype(np.float64)
    n = len(left)
    if right is None:
        i, j = linked(x, x, threshold)
        i, j = i[i < j], j[i < j]
    else:
        i, j = linked(x[:n], x[n:], threshold)
        j = j + n
    if leaf is not None and len(i):
        new = ~met_before(leaf, a["leaves"].tolist(), i, j)
        i, j = i[new], j[new]
    counts = (np.bincount(i, weight[j], len(a)) + np.bincount(j, weight[i], len(a))).astype(np.int64)
    root = lowest(i, j, len(a))
    at, off = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(a)))
    both = np.concatenate([at, off])
    key, least = a["key"].to_numpy()[both], a["least"].to_numpy()[both]
    nothing = [None] * len(at)
    return pd.DataFrame({
        "least": least, "key": key,
        "other_least": pd.array(nothing + a["least"].to_numpy()[root[off]].tolist(), dtype="Int64"),
        "other": pd.array(nothing + a["key"].to_numpy()[root[off]].tolist(), dtype="Int64"),
        "n": np.concatenate([counts[at], np.zeros(len(off), dtype=np.int64)])})


def compare_leaves(rows: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """Counts and edges within every leaf of ``rows`` (dim, least, key, w, v,
    leaves).  A leaf is a group; one beyond ``block_rows`` is dealt into blocks
    by a hash of the key, and each pair of blocks is a group."""
    each = rows.select("dim", F.explode("leaves").alias("leaf"), "least", "key", "w", "v", "leaves")
    large = saved(each.groupBy("dim", "leaf").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block_rows)
                  .select("dim", "leaf", F.ceil(F.col("rows") / block_rows).cast("int").alias("blocks")), "leaves")
    bounded = large.count() <= BROADCAST_LEAVES
    dealt = each.join(F.broadcast(large) if bounded else large, ["dim", "leaf"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    # a block meets every block of its leaf, itself included
    met = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("one", F.least("block", "with")).withColumn("two", F.greatest("block", "with"))
    group = ["dim", "leaf", "one", "two"]

    def run(b: pd.DataFrame) -> pd.DataFrame:
        one, two, leaf = int(b["one"].iloc[0]), int(b["two"].iloc[0]), int(b["leaf"].iloc[0])
        if one == two:
            return compare(b, None, threshold, leaf)
        return compare(b[b["block"] == one], b[b["block"] == two], threshold, leaf)

    met = met.select(*group, "block", "least", "key", "w", "v", "leaves")
    # after a join by leaf, the pairs of blocks would stay together in one task
    return (met if bounded else met.repartition(*group)).groupBy(*group).applyInPandas(run, RESULT)


def compare_balls(members: DataFrame, outside: DataFrame, threshold: float, block_rows: int) -> DataFrame:
    """Counts and edges between the members of each ball and the rows near it
    (both: dim, ball, least, key, w, v), block by block."""
    members_n, outside_n = (r.groupBy("dim", "ball").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias(n))
                            for r, n in ((members, "mb"), (outside, "ob")))
    both = F.broadcast(members_n.join(outside_n, ["dim", "ball"]))  # a row a centre at most
    key = ["dim", "ball", "m", "o"]

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        return (rows.join(both, ["dim", "ball"]).withColumn(own, F.pmod(F.xxhash64("key"), F.col(f"{own}b")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}b") - 1)))
                # new names of the columns: both sides come from one table
                .select(*[F.col(c).alias(c) for c in (*key, "least", "key", "w", "v")]))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return compare(a, b, threshold, None) if len(a) and len(b) else pd.DataFrame(
            {c.split()[0]: pd.array([], dtype="Int64") for c in RESULT.split(", ")})

    return dealt(members, "m", "o").groupBy(*key).cogroup(dealt(outside, "o", "m").groupBy(*key)).applyInPandas(run, RESULT)


def sampled(vectors: DataFrame, wanted: int) -> dict[int, np.ndarray]:
    """Unit vectors of at most ``wanted`` rows of each dimension, those with the
    smallest hashes."""
    out = {}
    for r in vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect():  # a row a dimension
        few = vectors.where((F.col("dim") == r["dim"]) & hash_below(F.col("key"), wanted, r["n"]))
        x = [s["v"] for s in few.orderBy(F.xxhash64("key"), "key").limit(wanted).select("v").collect()]
        out[r["dim"]] = _unit(np.array(x, dtype=np.float64))
    return out


def classes(vectors: DataFrame, threshold: float = THRESHOLD, vector: str = "embedding", leaf_rows: int = LEAF_ROWS,
            sample_rows: int = SAMPLE, hot_sample: int = HOT_SAMPLE, hot_least: int = HOT_LEAST, miss: float = MISS,
            depth: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id
    and the vector column).  ``depth`` fixes that of the trees."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("v"))
    takes_part = F.coalesce(F.col("vec_id").isNotNull() & usable(F.col("v").cast("array<double>")), F.lit(False))
    # two hashes name a vector; -0.0 and 0.0 are one value
    zero = F.lit(0).cast(rows.schema["v"].dataType.elementType)
    named = (rows.where(takes_part).withColumn("v", F.transform("v", lambda x: x + zero))
             .withColumn("h1", F.xxhash64(F.lit(1), "v")).withColumn("h2", F.xxhash64(F.lit(2), "v")))
    distinct = saved(named.groupBy("h1", "h2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("w"), F.first("v").alias("v"))
                     .withColumn("key", F.monotonically_increasing_id()).withColumn("dim", F.size("v")), "vectors")
    hot = {d: centres(x, threshold, hot_least) for d, x in sampled(distinct, hot_sample).items()}
    if any(map(len, hot.values())):
        placed = saved(in_balls(distinct, hot, threshold), "placed")
    else:
        placed = distinct.withColumn("ball", F.lit(None).cast("int")).withColumn("near", F.array().cast("array<int>"))

    free = placed.where(F.col("ball").isNull())
    left = {r["dim"]: r["n"] for r in free.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a dimension
    forests = {d: Forest(x, left[d], threshold, miss, depth) for d, x in sampled(free, sample_rows).items()}
    found = compare_leaves(saved(in_leaves(free, forests), "routed"), threshold, leaf_rows)
    if any(map(len, hot.values())):
        members = placed.where(F.col("ball").isNotNull())
        columns = ["dim", "ball", "least", "key", "w", "v"]
        # a pair of balls is compared once, with the later one outside
        outside = (placed.withColumn("at", F.explode("near")).where(F.col("ball").isNull() | (F.col("at") < F.col("ball")))
                   .withColumn("ball", F.col("at")).select(*columns))
        found = found.unionByName(compare_balls(members.select(*columns), outside, threshold, leaf_rows))
        # within a ball all are linked; a star connects them
        whole = members.groupBy("dim", "ball").agg(F.min(F.struct("least", "key")).alias("hub"), F.sum("w").alias("all"))
        inside = members.select("dim", "ball", "least", "key", "w").join(F.broadcast(whole), ["dim", "ball"])
        none, nothing = F.lit(None).cast("long"), F.lit(0).cast("long")
        found = (found.unionByName(inside.select("least", "key", none.alias("other_least"), none.alias("other"), (F.col("all") - F.col("w")).alias("n")))
                 .unionByName(inside.where(F.col("key") != F.col("hub.key")).select(
                     "least", "key", F.col("hub.least").alias("other_least"), F.col("hub.key").alias("other"), nothing.alias("n"))))
    found = saved(found, "links")

    counts = found.where("other IS NULL").groupBy("key").agg(F.sum("n").alias("n"))
    node = F.struct("least", "key")
    roots = components(found.where("other IS NOT NULL").select(
        node.alias("a"), F.struct(F.col("other_least").alias("least"), F.col("other").alias("key")).alias("b")))
    each = saved(distinct.select("key", "h1", "h2", "least", "w").join(counts, "key", "left")
                 .join(roots.select(F.col("node.key").alias("key"), F.col("root.least").alias("lowest")), "key", "left")
                 .select("h1", "h2", "least", "w", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"),
                         F.coalesce("lowest", "least").alias("component_id")), "each")
    once = each.where("w = 1").select(F.col("least").alias("vec_id"), "n_links", "component_id")
    # rows of one vector are spread over copies of its result
    salted = each.where("w > 1").select("h1", "h2", "n_links", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    copies = (named.select("vec_id", "h1", "h2", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int").alias("salt"))
              .join(salted, ["h1", "h2", "salt"]).select("vec_id", "n_links", "component_id"))
    alone = rows.where(~takes_part).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (once.unionByName(copies).unionByName(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def in_balls(vectors: DataFrame, hot: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """``vectors`` with ``ball`` (the centre within half the threshold's angle,
    the nearest, if any) and ``near`` (other centres within one and a half: a
    row farther off reaches no member)."""
    angle = math.acos(threshold)
    inner, outer = math.cos(angle / 2 - SLACK), math.cos(min(math.pi, 1.5 * angle + SLACK))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ball, near = [None] * len(b), [[]] * len(b)
            for dim, at in b.groupby("dim").indices.items():
                if len(c := hot[int(dim)]):
                    cos = _unit(np.stack(b["v"].iloc[at].to_numpy()).astype(np.float64)) @ c.T
                    for p, row in zip(at, cos, strict=True):
                        best = int(row.argmax())
                        ball[p] = best if row[best] >= inner else None
                        near[p] = [int(x) for x in np.flatnonzero(row >= outer) if x != ball[p]]
            yield b.assign(ball=pd.array(ball, dtype="Int32"), near=near)

    added = [StructField("ball", IntegerType()), StructField("near", ArrayType(IntegerType()))]
    return vectors.mapInPandas(run, StructType([*vectors.schema.fields, *added]))


def in_leaves(vectors: DataFrame, forests: dict[int, Forest]) -> DataFrame:
    """``vectors`` (dim, least, key, w, v) with the list of their leaves."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, at in b.groupby("dim").indices.items():
                part = b.iloc[at]
                row, leaf = forests[int(dim)].leaves(_unit(np.stack(part["v"].to_numpy()).astype(np.float64)))
                order = np.lexsort((leaf, row))
                ends = np.searchsorted(row[order], np.arange(len(part) + 1))  # every row has a leaf
                yield part.assign(leaves=np.split(leaf[order], ends[1:-1]))

    v = vectors.select("dim", "least", "key", "w", "v")
    return v.mapInPandas(run, StructType([*v.schema.fields, StructField("leaves", ArrayType(LongType()))]))
