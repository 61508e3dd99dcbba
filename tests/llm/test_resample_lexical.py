"""Importance resampling and lexical search against plain Python."""

from __future__ import annotations

import collections
import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from sparkdeck.llm import lexical, resample, textnp
from tests.llm import brute

ODD = ["", None, "!!! ...", "É É éÉ", "one", "\U0001F600 word İstanbul K", "x" * 5000, "a b " * 20_000]


def features(text, longest):
    w = brute.words(text)
    return [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def plain_resample(rows, target, percent=10, least=20, longest=1, buckets=resample.BUCKETS):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = collections.Counter(bucket(f) for _, t in rows for f in features(t, longest))
    t = collections.Counter(bucket(f) for x in target for f in features(x, longest))
    ns, nt = sum(s.values()), sum(t.values())
    out = []
    for i, (doc_id, text) in enumerate(rows):
        fs = [bucket(f) for f in features(text, longest)]
        g = [math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets)))) for b in fs]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(fs), weight, score, None, len(brute.words(text)), i])
    may = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, r in enumerate(may[:len(may) * percent // 100], 1):
        r[4] = n
    return [tuple(r[:5]) for r in out]


def bag(rows):
    return collections.Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def texts():
    long = [" ".join(f"w{(i * j) % 37} Word{i % 5}" for j in range(i % 60)) for i in range(300)]
    rows = list(enumerate([*ODD, *long])) + [(None, long[59]), (None, long[59]), (20, long[119]), (20, long[119]), (21, long[58])]
    return rows


@pytest.mark.parametrize(("longest", "percent", "least"), [(1, 10, 20), (3, 37, 5), (2, 100, 0)])
def test_resample_equals_plain_python(spark, texts, longest, percent, least):
    target = ["Word3 w1 w2 w5", "w1 w2 word3", None, "", "unseen terms w1 w2"]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5).withColumn("row", F.lit("x")).withColumn("score", F.lit(2))
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(docs, wanted, percent, least, longest)
    assert bag(got.collect()) == bag(plain_resample(texts, target, percent, least, longest))


def test_resample_of_empty_tables(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    assert bag(resample.resample(docs, none).collect()) == bag(plain_resample(texts, []))
    assert resample.resample(docs.limit(0), none).isEmpty()


def test_bracket_is_validated_and_widened(spark):
    scores = spark.range(0, 20_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("score"))
    values = sorted((r["score"] for r in scores.collect()), reverse=True)
    for wanted in (1, 2000, 13_000, 20_000):
        for accuracy, slack in ((10_000, None), (10, 0.0), (2, 1e-9)):  # poor sketches and brackets too narrow
            low, high, above = resample.bracket(scores, len(values), wanted, accuracy, slack)
            inside = [v for v in values if (high is None or v <= high) and (low is None or v >= low)]
            assert above == sum(high is not None and v > high for v in values)
            assert above < wanted <= above + len(inside)
            assert inside.count(values[wanted - 1]) == values.count(values[wanted - 1])


def test_runs_over_pieces_equal_runs_of_the_whole(monkeypatch):
    text = " ".join(f"w{i % 11}é" for i in range(400))
    whole = sorted(b for _, f in resample.bucket_runs(text, 3, 997) for b in f.tolist())
    assert whole == sorted(zlib.crc32(f.encode()) % 997 for f in features(text, 3))
    monkeypatch.setattr(textnp, "PIECE", 50)
    assert sorted(b for _, f in resample.bucket_runs(text, 3, 997) for b in f.tolist()) == whole


def plain_search(rows, items, k=10):
    docs = [(d, collections.Counter(brute.words(t))) for d, t in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    total, length = len(docs), sum(n for *_, n in docs)
    df = collections.Counter(t for _, c, _ in docs for t in c)
    terms = collections.defaultdict(set)
    for item_id, text in items:
        terms[item_id] |= set(brute.words(text))
    out = []
    for item_id, ts in terms.items():
        found = []
        for doc_id, c, n in docs:
            m = 10 + (90 * n * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in ts if c[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, n, None if none else d, -s) for n, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return out


ITEMS = [(1, "word1 w3 w5 W36"), (1, "also w7"), (2, "É a B"), (3, ""), (4, None), (None, "word2 w9"), (5, "nowhere found"),
         (6, "word0 word1 word2 word3 word4 w0"), (7, "one"), (6, "word0 word1 word2 word3 word4 w0")]


@pytest.mark.parametrize(("block", "terms_a_pass", "parts"), [(16_384, 100_000, 1), (7, 100_000, 3), (1, 4, 2)])
def test_search_equals_plain_python(spark, texts, block, terms_a_pass, parts):
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(parts).withColumn("score", F.lit("x")).withColumn("term", F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(0))
    got = lexical.search(docs, items, terms_a_pass=terms_a_pass, block_docs=block)
    assert bag(got.collect()) == bag(plain_search(texts, ITEMS))


def test_search_of_empty_tables(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(docs, items.limit(0)).isEmpty()
    assert lexical.search(docs.limit(0), items).isEmpty()


def test_accumulators_stop_and_survivors_stay_exact():
    """A rare term decides: the common one opens no accumulator, yet updates those there are."""
    import numpy as np

    block = lexical.Block(np.array([5000, 1], dtype=np.int64), 1000, 10_000)
    for d in range(1000):
        block.add(d, 10, np.array([0, 1] if d < 20 else [1]), np.array([2, 1] if d < 20 else [3]))
    block.invert()
    opened = []
    has = np.zeros
    try:
        np.zeros = lambda *a, **k: opened.append(has(*a, **k)) or opened[-1]
        found = block.evaluate(np.array([0, 1]), 10, 1)
    finally:
        np.zeros = has
    assert int(opened[1].sum()) == 20
    both = 5000 * (2 * 10**9 // (2000 + 8 * 100)) + 10**9 // (1000 + 8 * 100)
    assert found == [(both, d) for d in range(10)]
