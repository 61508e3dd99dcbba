"""Near-duplicate vectors against a comparison of all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdeck.llm import embedding_dedup as dedup

INF, NAN = float("inf"), float("nan")


def plain(rows, threshold=0.95):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    ok = [i for i, (v, x) in enumerate(rows)
          if v is not None and x is not None and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    links, root = [0] * len(rows), list(range(len(rows)))
    for dim in {len(rows[i][1]) for i in ok}:
        at = [i for i in ok if len(rows[i][1]) == dim]
        x = np.array([rows[i][1] for i in at], dtype=np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= threshold
        np.fill_diagonal(near, True)
        label = np.array(at)
        while True:
            new = np.array([label[n].min() for n in near])
            if (new == label).all():
                break
            label = new
        for i, n, r in zip(at, near.sum(1) - 1, label, strict=True):
            links[i], root[i] = int(n), int(r)
    least = {}
    for i in ok:
        least[root[i]] = min(least.get(root[i], rows[i][0]), rows[i][0])
    out = []
    for i, (v, _) in enumerate(rows):
        c = least[root[i]] if i in least or root[i] in least else v
        out.append((v, links[i], c, v is not None and v == c))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def group(rng, centre, n, angle):
    """Unit vectors at about ``angle`` from a centre."""
    noise = rng.standard_normal((n, len(centre)))
    noise -= (noise @ centre)[:, None] * centre
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return np.cos(angle) * centre + np.sin(angle) * noise


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(5)

    def unit(n, d=16):
        x = rng.standard_normal((n, d))
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    c = unit(6)
    parts = [unit(300),
             group(rng, c[0], 200, 0.08),                      # a ball
             group(rng, c[0], 40, 0.30),                       # around it: some links, some not
             group(rng, c[1], 120, 0.21),                      # linked, yet in no ball
             group(rng, c[2], 3, 0.05), group(rng, c[3], 2, 0.155),
             group(rng, group(rng, c[0], 1, 0.33)[0], 90, 0.06),  # a second ball next to the first
             *[np.repeat(unit(1), n, axis=0) for n in (2, 150)]]  # equal vectors
    x = np.concatenate(parts) * rng.uniform(0.01, 50, (sum(map(len, parts)), 1))
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)), x, strict=True)]
    bad = [None, [], [0.0] * 16, [1.0, None] * 8, [NAN] * 16, [INF] + [1.0] * 15, [-0.0] * 16]
    rows += [(10_000 + i, v) for i, v in enumerate(bad)]
    rows += [(None, rows[0][1]), rows[1], rows[1], (rows[2][0], rows[3][1]), (20_000, rows[4][1])]
    rows += [(30_000, [1.0, 2.0]), (30_001, [2.0, 4.0]), (30_002, [-1.0, -2.0]), (30_003, [1e-200, 2e-200]), (30_004, [1e200, 2e200]),
             (30_005, [0.0, 1.0]), (30_006, [-0.0, 1.0])]
    return rows


def frame(spark, rows):
    return (spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
            .withColumn("w", F.lit("x")).withColumn("key", F.lit(1)).withColumn("dim", F.lit(7)))


@pytest.mark.parametrize(("depth", "leaf_rows", "hot_least"), [(None, 2048, 4), (4, 2048, 4), (4, 20, 10**6), (0, 64, 4)])
def test_classes_equal_all_pairs(spark, table, depth, leaf_rows, hot_least):
    got = dedup.classes(frame(spark, table), depth=depth, leaf_rows=leaf_rows, hot_least=hot_least, miss=1e-9)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert ordered(got.collect()) == ordered(plain(table))


def test_float_vectors_and_empty_tables(spark, table):
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in table if v is None or len(v) != 2]
    got = dedup.classes(frame(spark, rows).withColumn("embedding", F.col("embedding").cast("array<float>")), depth=3, miss=1e-9)
    assert ordered(got.collect()) == ordered(plain(rows))
    assert dedup.classes(frame(spark, table).limit(0)).isEmpty()
    assert ordered(dedup.classes(frame(spark, table[-12:-7])).collect()) == ordered(plain(table[-12:-7]))


def test_forest_keeps_pairs_together():
    """Recall of pairs at the threshold, and leaves beyond the sampled levels."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = np.concatenate([group(rng, c, 1, np.arccos(0.9501)) for c in x[:2000]])
    forest = dedup.Forest(x[-500:], 100_000, 0.95, 1e-4, depth=8)  # 500 sampled: 4 levels fitted, 4 lent
    assert (forest.fitted, len(forest.lower[0])) == (4, 4)
    lists = []
    for y in (x, near):
        row, leaf = forest.leaves(y)
        lists.append([set() for _ in y])
        for r, n in zip(row.tolist(), leaf.tolist(), strict=True):
            lists[-1][r].add(n)
    missed = sum(not a & b for a, b in zip(lists[0], lists[1], strict=False))
    assert missed <= 4
    # leaves are even: none holds many times its share
    sizes = np.unique(forest.leaves(x)[1], return_counts=True)[1]
    assert sizes.max() < 12 * 4000 / 2**8


def test_pairs_are_counted_in_their_first_leaf_only():
    lists = [np.array(x) for x in ([1, 5, 9], [5, 9], [2, 9], [])]
    i, j = np.array([0, 0, 1, 0]), np.array([1, 2, 2, 3])
    assert dedup.met_before(9, lists, i, j).tolist() == [True, False, False, False]
    assert dedup.met_before(5, lists, i, j).tolist() == [False] * 4


def test_lowest_follows_chains():
    i = np.array([7, 2, 3, 9])
    assert dedup.lowest(i, np.array([6, 3, 4, 9]), 10).tolist() == [0, 1, 2, 2, 2, 5, 6, 6, 8, 9]
