"""Language identification and toxicity: held-out accuracy and odd inputs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdeck.llm import langid, toxicity
from sparkdeck.llm.common import held_out, table
from tests.conftest import SF001

ODD = [(1, "", "en"), (2, None, "en"), (3, "123 !!", "fr"), (None, "the and of", None), (4, "a" * 50_000, None), (4, "é", None)]


def test_codewords_differ():
    for k in range(2, 12):
        m = langid.code_matrix(k)
        assert m.shape[0] == k and len({tuple(r) for r in m}) == k
        assert all(abs(int(c.sum())) < k for c in m.T)


def test_language_on_held_out_rows(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text", "lang").withColumn("p", F.lit(1)).withColumn("share", F.lit(2))
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n = got.count()
    assert n > 250 and got.where("lang = lang_pred").count() >= 0.98 * n
    assert got.where("score < 0 or score > 1").isEmpty()


def test_language_of_odd_texts(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text", "lang")
    model = langid.train(langid.training_sample(docs, 50))
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string")
    rows = langid.identify(odd, model).collect()
    assert len(rows) == len(ODD)
    by = {(r["doc_id"], r["lang_pred"]) for r in rows}
    assert {(1, "und"), (2, "und"), (3, "und")} <= by and all(p in model.languages + ["und"] for _, p in by)
    assert {r["lang_pred"] for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    one = langid.identify(odd.withColumn("lang", F.lit("xx"))).where("doc_id is null").collect()
    assert one[0]["lang_pred"] == "xx"
    assert langid.identify(odd.limit(0), model).isEmpty()


def test_language_rows_are_bounded_by_distinct_texts_and_languages(spark):
    held = {r["i"] for r in spark.range(3000).select(F.col("id").alias("i"), held_out(F.col("id")).alias("h")).where("h").collect()}
    ids = [i for i in range(3000) if i not in held]
    rows = [(ids[0], "the same row again", "en")] * 400 + [(i, f"text {i}", "en") for i in ids[:300]]
    rows += [(i, f"texte {i}", f"l{i % 40:02d}") for i in ids[300:1000]] + [(ids[1], None, "en"), (ids[2], "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.training_sample(docs, 20, 8).groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("text").alias("d")).collect()
    assert len(got) == 8 and "en" in {r["lang"] for r in got}
    assert all(r["n"] == r["d"] <= 20 for r in got) and {r["n"] for r in got if r["lang"] == "en"} == {20}
    assert langid.training_sample(docs.limit(0)).isEmpty()


def test_decoding_equals_a_plain_version(spark):
    texts = ["the cat and the dog", "der hund und die katze", "le chat et le chien", "el gato y el perro", "\u00e9t\u00e9 12!?", "a"]
    sample = spark.createDataFrame([("en", texts[0]), ("de", texts[1]), ("fr", texts[2]), ("es", texts[3])], "lang string, text string")
    model = langid.train(sample)
    assert model.languages == ["de", "en", "es", "fr"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", langid.predict(F.col("text"), model).alias("p"))
    got = {r["i"]: r["p"] for r in rows.collect()}
    for i, text in enumerate(texts):
        raw = []
        for c in b" " + text.lower().encode() + b" ":  # runs of other bytes are one blank
            c = c if ord("a") <= c <= ord("z") or c >= 128 else 32
            if c != 32 or not raw or raw[-1] != 32:
                raw.append(c)
        grams = []
        for n in langid.ORDERS:
            for at in range(len(raw) - n + 1):
                h = 0
                for j in range(n):
                    h = (h * 0x01000193 + raw[at + j] + j + 1) % 2**32
                grams.append(h * 0x9E3779B1 % 2**32 >> 17)
        margin = [sum(float(model.weights[g, b]) for g in grams) / len(grams) for b in range(model.code.shape[1])]
        loss = [sum(model.trust[k, b] * np.exp(-langid.SHARPNESS * model.code[k, b] * m) for b, m in enumerate(margin)) for k in range(4)]
        share = np.exp(-4 * (np.array(loss) - min(loss)))
        share /= share.sum()
        best = int(np.argmin(loss))
        assert got[i]["lang"] == model.languages[best]
        assert abs(got[i]["score"] - share[best]) < 1e-4 and got[i]["ambiguous"] == (got[i]["score"] < langid.AMBIGUOUS_BELOW)


def test_training_never_sees_held_out_rows(spark):
    docs = table(spark, SF001, "documents")
    seen = langid.training_sample(docs.withColumn("text", F.concat(F.col("text"), F.lit(" #"), F.col("doc_id").cast("string"))))
    ids = seen.select(F.regexp_extract("text", r"#(\d+)$", 1).cast("long").alias("doc_id"))
    assert ids.where(held_out(F.col("doc_id"))).isEmpty() and not ids.isEmpty()
    labels = table(spark, SF001, "labels")
    marked = docs.withColumn("text", F.col("doc_id").cast("string"))
    rows = toxicity.training_rows(marked, labels).select(F.col("text").cast("long").alias("doc_id"))
    assert rows.where(held_out(F.col("doc_id"))).isEmpty() and not rows.isEmpty()
    assert toxicity.training_rows(marked, labels, train_rows=10).count() == 10


def test_training_rows_are_bounded_whatever_the_ids(spark):
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    ids = labels.where(~held_out(F.col("doc_id"))).orderBy("doc_id").limit(20).select("doc_id")
    hot = ids.limit(1).crossJoin(spark.range(500)).select("doc_id", F.concat(F.lit("text "), F.col("id") % 100).alias("text"))
    docs = ids.select("doc_id", F.lit("plain").alias("text")).unionAll(hot)
    rows = toxicity.training_rows(docs, labels)
    assert rows.count() == 120 and rows.where("text = 'plain'").count() == 20  # repeats count once
    assert toxicity.training_rows(docs, labels, train_rows=50).count() <= 50


def test_pairs_count_for_more_than_their_terms():
    rng = np.random.default_rng(0)
    fill = [f"w{i}" for i in range(30)]
    texts, y = [], []
    for _ in range(1500):
        a, b = (bool(x) for x in rng.random(2) < 0.5)
        texts.append(" ".join([*rng.choice(fill, 6), *["insult"] * a, *["group"] * b]))
        y.append(float(a and b))
    ids, at = toxicity.text_terms(texts)
    m = toxicity.fit([ids[i:j] for i, j in zip(at[:-1], at[1:], strict=True)], np.array(y))
    both, one, other, none = m.scores(["insult group", "insult", "group", ""])
    assert both >= 0.7 and max(one, other, none) < 0.5
    assert np.allclose(m.scores(["Insult, GROUP!", None]), [both, none])
    # the logit equals the pairwise sum written out
    t, _ = toxicity.text_terms(["insult group w1 w2"])
    s = m.slot[t][m.slot[t] > 0]
    z = m.bias + m.weight[s].sum() + sum(m.factor[i] @ m.factor[j] for k, i in enumerate(s) for j in s[k + 1:])
    assert np.isclose(m.scores(["insult group w1 w2"])[0], 1 / (1 + np.exp(-z)))


def test_toxicity_query_on_labels(spark):
    docs, labels = table(spark, SF001, "documents"), table(spark, SF001, "labels")
    got = toxicity.score_documents(docs.withColumn("score", F.lit("x")), labels.withColumn("text", F.lit("y")))
    j = got.join(labels, "doc_id")
    assert got.count() == docs.count() and got.where("score < 0 or score > 1 or predicted <> int(score >= 0.7)").isEmpty()
    flagged = j.where("predicted = 1")
    assert flagged.count() >= 10 and flagged.where("toxic = 1").count() >= 0.95 * flagged.count()
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.where("predicted = 0").count()


def test_toxicity_without_labels_or_classes(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in ODD] + [(i, "plain text") for i in range(10, 20)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, none).where("score > 0.01").isEmpty()
    clean = docs.select("doc_id", F.lit(0).alias("toxic"))
    assert toxicity.score_documents(docs, clean).where("score > 0.01").isEmpty()
    odd = spark.createDataFrame([(None, 1), (11, None), (12, 7)], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, odd).where("predicted = 1").isEmpty()
    assert toxicity.score_documents(docs.limit(0), clean).isEmpty()


def _rows(texts):
    ids, at = toxicity.text_terms(texts)
    return [ids[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]


def _insult_and_group(n, label, seed=0):
    rng = np.random.default_rng(seed)
    fill = [f"w{i}" for i in range(40)]
    a, b = rng.random(n) < 0.5, rng.random(n) < 0.5
    texts = [" ".join([*rng.choice(fill, 6), *["insult"] * int(x), *["group"] * int(y)]) for x, y in zip(a, b, strict=True)]
    return texts, label(a, b).astype(float)


def test_pairs_whose_terms_say_nothing_alone_are_learnt():
    """Either alone is toxic, both or none are not: no additive weights do it."""
    texts, y = _insult_and_group(4000, np.logical_xor)
    m = toxicity.fit(_rows(texts), y)
    both, one, other, none = m.scores(["insult group w1", "insult w1", "group w1", "w1 w2"])
    assert max(both, none) < 0.1 and min(one, other) > 0.9
    held, z = _insult_and_group(1000, np.logical_xor, seed=1)
    assert ((m.scores(held) >= 0.5) == z).mean() > 0.98
    # the machine beats its own additive part
    additive = toxicity.Machine(np.flatnonzero(m.slot), m.bias, m.weight, np.zeros_like(m.factor))
    assert ((additive.scores(held) >= 0.5) == z).mean() < 0.8


def test_no_pairs_are_found_in_noise():
    texts, _ = _insult_and_group(3000, np.logical_and)
    y = (np.random.default_rng(3).random(3000) < 0.3).astype(float)
    rows = _rows(texts)
    flat = toxicity.descend(rows, y, np.empty(0, np.int64), 7, None)
    assert not len(toxicity.pair_terms(rows, y, flat, np.unique(np.concatenate(rows))))
    assert np.allclose(toxicity.fit(rows, y).scores(texts[:50]), y.mean(), atol=0.15)


def test_training_terms_are_bounded(spark):
    rows = spark.range(300).select(F.concat_ws(" ", F.lit("word"), F.col("id"), F.col("id") + 1000).alias("text"), (F.col("id") % 2).cast("int").alias("label"))
    whole, part = toxicity.train(rows), toxicity.train(rows, train_terms=90)
    assert (whole.bias, part.bias) != (None, None) and part.scores(["word"])[0] != whole.scores(["word"])[0]
    assert toxicity.train(rows, train_terms=1).scores(["word"])[0] in (pytest.approx(0, abs=1e-9), pytest.approx(1, abs=1e-9))
