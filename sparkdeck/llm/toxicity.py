"""Toxicity scores from a factorization machine over hashed terms.

A text is the set of its words, hashed into ``BUCKETS`` terms.  The machine's
logit is ``w0 + sum w_i + sum_{i<j} <v_i, v_j>`` over the terms present: the
factors ``v`` let two terms (an insult and the mention of a group, say) count
for more together than their weights do alone, in time linear in the terms.

Training reads labels of rows not held out, at most ``train_rows`` ids and as
many rows, by order of a hash of the id and, within, of the text (a documented
bound), and of these as many whole rows, in the order of a hash, as hold
``TRAIN_TERMS`` terms; equal rows of an id count once; Spark tasks turn their
texts into terms and one task fits the weights by AdaGrad on minibatches.

Which terms get weights: those that depend on the label by a chi-square test,
and those of pairs that do.  A pair is tested on what an additive fit of the
first leaves over (its residuals, summed over the texts that hold both terms,
against their variance), so terms that say nothing alone but much together are
found.  Pairs are taken of the ``PAIR_TERMS`` terms in most training texts (those
in over nine tenths left out); terms in fewer than ``MIN_ROWS`` texts get no weight.

The model (a few hundred thousand numbers, whatever the corpus) goes to every
task; scoring is a scalar pandas UDF over whole texts, without a shuffle.

Defined results: a null or empty text has no terms and gets the score of the
bias alone; several labels of one id count as toxic if any is; with labels of
one class only, or none, every score is that class's (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkdeck.llm.common import hash_below, held_out, saved, ship
from sparkdeck.llm.textnp import groups, word_hashes

BITS = 18
BUCKETS = 1 << BITS
FACTORS = 4
TRAIN_ROWS = 20_000
MIN_ROWS = 8
#: Least chi-square of a term against the label (1 degree of freedom): terms
#: that say nothing about it would only let the machine learn rows by heart.
MIN_CHI_SQUARE = 12.0
#: Terms whose pairs are tested, and the least chi-square of a pair: one of
#: two million independent pairs exceeds it by chance once in thirty fits.
PAIR_TERMS, MIN_PAIR_CHI_SQUARE = 2_048, 36.0
#: Least variance of a pair's residuals (the test needs a few labels of either kind).
MIN_PAIR_VARIANCE = 2.0
#: Terms (with repeats between rows) of all training rows together.
TRAIN_TERMS = 8_000_000
STEPS, BATCH = 3000, 256
STEP, L2_WEIGHT, L2_FACTOR = 0.3, 2e-3, 5e-2
THRESHOLD = 0.7


def text_terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of each text and where each text's terms start."""
    words, offsets = word_hashes(texts)
    text = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(offsets))
    pair = np.unique((text << BITS) | (words >> np.uint64(64 - BITS)).astype(np.int64))
    return (pair & (BUCKETS - 1)).astype(np.int32), np.searchsorted(pair >> BITS, np.arange(len(texts) + 1))


class Machine:
    """Weights of the terms that have any (sorted ids), their factors, a bias."""

    def __init__(self, terms: np.ndarray, bias: float, weight: np.ndarray, factor: np.ndarray):
        self.bias = bias
        self.slot = np.zeros(BUCKETS, dtype=np.int32)  # slot 0 has no weight
        self.slot[terms] = np.arange(1, len(terms) + 1)
        self.weight, self.factor = weight, factor

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for a, b in groups(texts):
            ids, at = text_terms(texts[a:b])
            used = self.slot[ids]
            upto = np.concatenate([[0], np.cumsum(used > 0)])[at]
            used = used[used > 0]
            out[a:b] = 1 / (1 + np.exp(-np.clip(self._logits(used, upto), -40, 40)))
        return out

    def used(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' terms that have weights, and where each row starts."""
        found = [(x := self.slot[r])[x > 0] for r in rows]
        return np.concatenate(found), np.concatenate([[0], np.cumsum([len(f) for f in found])])

    def _logits(self, used: np.ndarray, at: np.ndarray) -> np.ndarray:
        return logits(self.bias, self.weight, self.factor, used, at)[0]


def _sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    run = np.concatenate([np.zeros((1, x.shape[1])), np.cumsum(x, axis=0, dtype=np.float64)])
    return run[at[1:]] - run[at[:-1]]


def logits(bias: float, w: np.ndarray, v: np.ndarray, used: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    f = v[used]
    s = _sums(f, at)
    return bias + _sums(w[used][:, None], at)[:, 0] + 0.5 * ((s * s).sum(1) - _sums((f * f).sum(1)[:, None], at)[:, 0]), s


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Machine:
    """A machine over the terms that matter alone or in pairs."""
    none = np.empty(0, np.int32)
    if not len(labels) or labels.min() == labels.max():
        always = len(labels) and labels[0] == 1
        return Machine(none, 30.0 if always else -30.0, np.zeros(1), np.zeros((1, FACTORS)))
    flat = np.concatenate(rows) if rows else none
    seen = np.bincount(flat, minlength=BUCKETS).astype(float)
    bad = np.bincount(flat, np.repeat(labels, [len(r) for r in rows]), BUCKETS)
    n, n1 = len(labels), labels.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = n * (bad * n - seen * n1) ** 2 / (seen * (n - seen) * n1 * (n - n1))
    few = seen < min(MIN_ROWS, max(1, n // 50))
    alone = np.flatnonzero(~few & ((chi >= MIN_CHI_SQUARE) | (seen == n)))
    often = np.flatnonzero(~few & (seen <= 0.9 * n))
    often = np.sort(often[np.argsort(-seen[often], kind="stable")[:PAIR_TERMS]])
    additive = descend(rows, labels, alone, seed, paired=None)
    paired = pair_terms(rows, labels, additive, often)
    if not len(paired):
        return descend(rows, labels, alone, seed, paired=none)
    return descend(rows, labels, np.union1d(alone, paired), seed, paired)


def pair_terms(rows: list[np.ndarray], labels: np.ndarray, additive: Machine, often: np.ndarray) -> np.ndarray:
    """Terms of ``often`` in a pair that the additive fit's residuals depend on."""
    m = len(often)
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[often] = np.arange(m)
    off, spread = np.zeros((m, m), dtype=np.float32), np.zeros((m, m), dtype=np.float32)
    for i in range(0, len(rows), 1024):
        some = rows[i:i + 1024]
        used, at = additive.used(some)
        p = 1 / (1 + np.exp(-np.clip(additive._logits(used, at), -40, 40)))
        x = np.zeros((len(some), m), dtype=np.float32)
        for r, terms in enumerate(some):
            q = place[terms]
            x[r, q[q >= 0]] = 1
        off += x.T @ (x * (labels[i:i + 1024] - p).astype(np.float32)[:, None])
        spread += x.T @ (x * np.maximum(p * (1 - p), 1e-3).astype(np.float32)[:, None])
    np.fill_diagonal(off, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        strong = (off * off >= MIN_PAIR_CHI_SQUARE * spread) & (spread >= MIN_PAIR_VARIANCE)
    return often[strong.any(1)]


def descend(rows: list[np.ndarray], labels: np.ndarray, terms: np.ndarray, seed: int, paired: np.ndarray | None) -> Machine:
    """AdaGrad on the logistic loss with L2 penalties.  ``paired``: terms whose
    factors start large and are hardly penalised; None fits no factors at all."""
    slot = np.zeros(BUCKETS, dtype=np.int32)
    slot[terms] = np.arange(1, len(terms) + 1)
    rows = [(x := slot[r])[x > 0] for r in rows]
    n, k, rng = len(terms) + 1, FACTORS, np.random.default_rng(seed)
    bias = float(np.log(labels.mean() / (1 - labels.mean())))
    w, v = np.zeros(n), rng.normal(0, 0.01, (n, k))
    penalty = np.full((n, 1), L2_FACTOR)
    if paired is None:
        v[:] = 0
    else:
        v[slot[paired]] *= 20
        penalty[slot[paired]] = L2_WEIGHT
    gw2, gv2, gb2 = np.full(n, 1e-6), np.full((n, k), 1e-6), 1e-6
    for _ in range(max(5, -(-STEPS * BATCH // len(rows)))):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            pick = order[i:i + BATCH]
            used = np.concatenate([rows[j] for j in pick])
            at = np.concatenate([[0], np.cumsum([len(rows[j]) for j in pick])])
            z, s = logits(bias, w, v, used, at)
            g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[pick]
            each = np.repeat(g, np.diff(at)) / len(pick)
            here = np.unique(used)
            gw = np.bincount(used, each, n)[here] + L2_WEIGHT * w[here] / len(pick)
            gw2[here] += gw * gw
            w[here] -= STEP * gw / np.sqrt(gw2[here])
            if paired is not None:
                text = np.repeat(np.arange(len(pick)), np.diff(at))
                dv = each[:, None] * (s[text] - v[used])
                gv = np.stack([np.bincount(used, dv[:, f], n)[here] for f in range(k)], axis=1) + penalty[here] * v[here] / len(pick)
                gv2[here] += gv * gv
                v[here] -= 0.3 * STEP * gv / np.sqrt(gv2[here])
            gb2 += g.mean() ** 2
            bias -= STEP * g.mean() / np.sqrt(gb2)
    return Machine(terms.astype(np.int32), bias, w, v)


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, label) of labelled rows that are not held out."""
    usable = (labels.select(F.col("doc_id").alias("__id"), F.col(label).alias("__label"))
              .where(F.col("__id").isNotNull() & F.col("__label").isin(0, 1) & ~held_out(F.col("__id"))))
    one = (usable.where(hash_below(F.col("__id"), train_rows, usable.count()))
           .groupBy("__id").agg(F.max("__label").alias("__label"))
           .orderBy(F.xxhash64("__id"), "__id").limit(train_rows))
    # at most `train_rows` ids and labels: bounded, so they go to every task
    rows = (docs.select("doc_id", "text").join(F.broadcast(one), F.col("doc_id") == F.col("__id"))
            .select("__id", F.coalesce("text", F.lit("")).alias("text"), F.col("__label").cast("int").alias("label"))
            .withColumn("__digest", F.sha2("text", 256)))
    # an id with many texts does not make more rows than the bound
    keys = (rows.select("__id", "__digest").distinct()
            .orderBy(F.xxhash64("__id", "__digest"), "__id", "__digest").limit(train_rows))
    kept = rows.join(F.broadcast(keys), ["__id", "__digest"], "left_semi")
    return kept.dropDuplicates(["__id", "__digest"]).select("text", "label")


def train(rows: DataFrame, train_terms: int = TRAIN_TERMS) -> Machine:
    """Fits a machine on rows (text, label), on as many of them as hold
    ``train_terms`` terms."""
    ship(rows.sparkSession)

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = b["text"].tolist()
            for x, y in groups(texts):
                ids, at = text_terms(texts[x:y])
                yield pd.DataFrame({"label": b["label"].iloc[x:y].to_numpy(),
                                    "terms": [ids[i:j].astype("<i4").tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]})

    def fitted(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["label", "terms"], kind="stable")  # the same fit in whatever order rows arrive
        m = fit([np.frombuffer(t, dtype="<i4") for t in b["terms"]], b["label"].to_numpy(dtype=float))
        used = np.flatnonzero(m.slot).astype("<i4")
        return pd.DataFrame({"ids": [used.tobytes()], "bias": [m.bias], "weight": [m.weight.astype("<f8").tobytes()],
                             "factor": [m.factor.astype("<f8").tobytes()]})

    # one task fits: its input is bounded by the rows' bound and that of their terms
    listed = saved(rows.mapInPandas(terms, "label int, terms binary").withColumn("h", F.xxhash64("terms", "label")), "terms")
    upto = F.sum(F.octet_length("terms") / 4).over(Window.orderBy("h").rangeBetween(Window.unboundedPreceding, 0))
    last = listed.select("h", upto.alias("n")).where(F.col("n") <= train_terms).agg(F.max("h")).first()[0]  # numbers of bounded rows
    kept = listed.where(F.col("h") <= last) if last is not None else listed.limit(1)
    got = (kept.select("label", "terms").groupBy(F.lit(1).alias("one"))
           .applyInPandas(fitted, "ids binary, bias double, weight binary, factor binary").collect())
    if not got:
        return fit([], np.empty(0))
    r = got[0]
    return Machine(np.frombuffer(r["ids"], dtype="<i4"), r["bias"], np.frombuffer(r["weight"], dtype="<f8"),
                   np.frombuffer(r["factor"], dtype="<f8").reshape(-1, FACTORS))


def score(text: Column, machine: Machine) -> Column:
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(machine.scores(texts.tolist()))

    return run(text)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per document row: doc_id, held_out, score, predicted."""
    machine = train(training_rows(docs, labels, train_rows=train_rows))
    d = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), machine).alias("score"))
    return d.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` (all columns) that score under the threshold."""
    machine = train(training_rows(docs, labels, train_rows=train_rows))
    return docs.where(score(F.col("text"), machine) < threshold)
