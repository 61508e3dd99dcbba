"""Language identification by error-correcting output codes.

Each language has a codeword of +1/-1 bits.  One binary classifier per bit
weighs the byte n-grams (1 to 4 bytes, hashed) of the letters of a text by the
log-odds between the languages whose bit is +1 and those whose bit is -1, each
language counting alike; its margin is the mean weight over the text's
n-grams.  Decoding is loss-weighted: the loss of a language is the sum over bits
of exp(-bit * margin), weighted by how often that bit's classifier was right on
training texts of that language; the nearest codeword wins.  A text whose two
best languages lie close is flagged ambiguous.

Training reads only text and non-null lang of rows not held out.  It takes
at most ``rows_per_language`` distinct texts of each of the ``LANGUAGES`` most
frequent languages (ties by name), chosen by a hash of the text, documented
bounds however often a row repeats and however many languages there are; their
n-grams are counted and their bits judged by Spark tasks, and only the counts
(languages x buckets) reach the driver.
Prediction is a scalar pandas UDF over whole texts: no shuffle.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or when nothing could be learned; with a single learned language every text
with a letter gets it; ties go to the first language in name order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkdeck.llm.common import held_out, ship
from sparkdeck.llm.textnp import PIECE

UNKNOWN = "und"
BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
ROWS_PER_LANGUAGE = 2000
#: Languages learned, the most frequent: bounds codewords and counts.
LANGUAGES = 256
SMOOTHING = 0.5
#: Margins are multiplied by this before the exponential loss.
SHARPNESS = 2.0
#: Score below which a prediction is flagged.
AMBIGUOUS_BELOW = 0.6

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a"):ord("z") + 1] = _LETTER[128:] = True


def code_matrix(k: int) -> np.ndarray:
    """Codewords (rows) of k languages: the exhaustive code for up to 7
    languages, else random bits with the best smallest distance of 50 draws."""
    if k <= 1:
        return np.ones((k, 1), dtype=np.int8)
    if k <= 7:
        bits = 2 ** (k - 1) - 1
        rows = [np.ones(bits, dtype=np.int8)]
        for i in range(1, k):
            run = 2 ** (k - 1 - i)
            rows.append(np.array([-1 if (j // run) % 2 == 0 else 1 for j in range(bits)], dtype=np.int8))
        return np.array(rows)
    bits = int(np.ceil(10 * np.log2(k)))
    best, far = None, -1
    for seed in range(50):
        m = np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), size=(k, bits))
        if (np.abs(m.sum(0)) == k).any():
            continue
        d = min(int((m[i] != m[j]).sum()) for i in range(k) for j in range(i))
        if d > far:
            best, far = m, d
    return best


def _gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams of the letters of a whole text; runs of other
    characters count as one blank.  None without a letter."""
    if not text or not any(map(str.isalpha, text)):
        return None
    raw = b" " + text.lower().encode("utf-8", "surrogatepass") + b" "
    total = np.zeros(BUCKETS)
    for at in range(0, len(raw), PIECE):  # pieces overlap by three bytes
        a = np.frombuffer(raw[max(0, at - 3):at + PIECE], dtype=np.uint8)
        letter = _LETTER[a]
        a = np.where(letter, a, np.uint8(32))
        a = a[letter | np.concatenate([[True], letter[:-1]])].astype(np.uint32)
        h = np.zeros(len(a), dtype=np.uint32)
        for n in ORDERS:
            if len(a) < n:
                break
            h = h[:len(a) - n + 1] * np.uint32(0x01000193) + a[n - 1:] + np.uint32(n)
            b = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)
            total += np.bincount(b, minlength=BUCKETS)
    return total


class Model:
    """Languages, codewords, n-gram weights per bit, decoding weights."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = code_matrix(len(languages))
        p = counts + SMOOTHING
        p = p / p.sum(1, keepdims=True)
        weights = []
        for bit in self.code.T:
            up, down = p[bit > 0], p[bit < 0]
            weights.append(np.log(up.mean(0)) - np.log(down.mean(0)) if len(up) and len(down) else np.zeros(BUCKETS))
        self.weights = np.array(weights, dtype=np.float32).T.copy()
        self.trust = np.full(self.code.shape, 1.0 / self.code.shape[1])

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return (counts.astype(np.float32) @ self.weights) / np.float32(counts.sum())

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (self.trust * np.exp(np.clip(-SHARPNESS * self.code * margins, -30, 30))).sum(1)
        share = np.exp(-(loss - loss.min()) * len(self.languages))
        share /= share.sum()
        best = int(np.argmin(loss))
        return self.languages[best], float(share[best]), bool(share[best] < AMBIGUOUS_BELOW)


def training_sample(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, languages: int = LANGUAGES) -> DataFrame:
    """(lang, text) of at most so many distinct texts of each of the most
    frequent languages, never held out: those with the smallest hashes."""
    d = docs.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    key = F.xxhash64("text")
    # distinct texts are only estimated, for a first cut with room to spare
    frequent = (d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(key).alias("texts"))
                .orderBy(F.desc("n"), "lang").limit(languages)
                .select("lang", F.least(F.lit(1.0), F.lit(4.0 * rows_per_language) / F.greatest("texts", F.lit(1))).alias("share")))
    place = (F.shiftrightunsigned(key, 11).cast("double") / F.lit(2.0 ** 53))
    likely = d.join(F.broadcast(frequent), "lang").where(place < F.col("share"))  # one row a language, at most ``languages``
    w = Window.partitionBy("lang").orderBy(key, "text")
    return (likely.select("lang", "text").dropDuplicates(["lang", "text"]).withColumn("place", F.row_number().over(w))
            .where(F.col("place") <= rows_per_language).select("lang", "text"))


def train(sample: DataFrame) -> Model | None:
    """Fits a model on rows (lang, text); None without a usable row."""
    ship(sample.sparkSession)
    held = sample = sample.select("lang", "text").persist()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"], strict=True):
                if (c := _gram_counts(text)) is not None:
                    sums[lang] = sums[lang] + c if lang in sums else c
        if sums:
            yield pd.DataFrame({"lang": list(sums), "counts": [s.astype("<f8").tobytes() for s in sums.values()]})

    try:
        # the sample is bounded, so a few tasks hold it (dealt out after the scan)
        sample = sample.repartition(16)
        rows = sample.mapInPandas(count, "lang string, counts binary").toLocalIterator()
        sums: dict[str, np.ndarray] = {}
        for r in rows:
            c = np.frombuffer(r["counts"], dtype="<f8")
            sums[r["lang"]] = sums.get(r["lang"], 0) + c
        if not sums:
            return None
        languages = sorted(sums)
        model = Model(languages, np.array([sums[x] for x in languages]))

        def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            right = {x: np.zeros(model.code.shape[1]) for x in languages}
            seen = dict.fromkeys(languages, 0)
            for b in batches:
                for lang, text in zip(b["lang"], b["text"], strict=True):
                    if (c := _gram_counts(text)) is not None:
                        right[lang] += np.sign(model.margins(c)) == model.code[languages.index(lang)]
                        seen[lang] += 1
            yield pd.DataFrame({"lang": languages, "seen": [seen[x] for x in languages], "right": [right[x].tolist() for x in languages]})

        right, seen = np.zeros(model.code.shape), np.zeros(len(languages))
        for r in sample.mapInPandas(judge, "lang string, seen long, right array<double>").collect():
            right[languages.index(r["lang"])] += r["right"]
            seen[languages.index(r["lang"])] += r["seen"]
        trust = (right + 1) / (seen[:, None] + 2)
        model.trust = trust / trust.sum(1, keepdims=True)
        return model
    finally:
        held.unpersist()


def predict(text: Column, model: Model | None) -> Column:
    """struct(lang, score, ambiguous) of a text column."""

    @F.pandas_udf("lang string, score double, ambiguous boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for t in texts:
                c = _gram_counts(t) if model else None
                out.append(model.decode(model.margins(c)) if c is not None else (UNKNOWN, 0.0, True))
            yield pd.DataFrame(out, columns=["lang", "score", "ambiguous"])

    return run(text)


def identify(docs: DataFrame, model: Model | None = None, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred, score, ambiguous."""
    ship(docs.sparkSession)
    model = model or train(training_sample(docs, rows_per_language))
    d = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text"), model).alias("p"))
    return d.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
                    F.col("p.ambiguous").alias("ambiguous"))
