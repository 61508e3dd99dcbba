"""The pipeline: its stages, their order, and what each does to the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from sparkdeck.llm import decontaminate, neardup, toxicity
from sparkdeck.llm.common import table
from tests.conftest import SF0001
from tests.llm import brute


def test_stages_in_order_and_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "packing"]
    names = __spark_entry__.queries()
    assert "pipeline" in names and [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)] == [1] * 10


def test_each_stage_takes_effect(spark):
    docs = table(spark, SF0001, "documents").withColumn("found", F.lit("clash")).withColumn("__id", F.lit(0))
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, seen, SF0001).cache()
        assert new.columns == docs.columns, name
        before, after = seen.select("doc_id", "text").collect(), new.select("doc_id", "text").collect()
        ids = {r["doc_id"] for r in after}
        if name == "toxicity":
            scores = toxicity.score_documents(seen, table(spark, SF0001, "labels"))
            assert ids == {r["doc_id"] for r in scores.where("predicted = 0").collect()}
        elif name == "near_dedup":
            assert ids == set(brute.near_classes([(r["doc_id"], r["text"]) for r in before]))
        elif name == "decontamination":
            items = [tuple(r) for r in table(spark, SF0001, "benchmark").select("item_id", "text").collect()]
            hits = brute.contamination([r["text"] for r in before], items)
            assert ids == {r["doc_id"] for r, h in zip(before, hits, strict=True) if not h[1]}
        else:
            assert ids == {r["doc_id"] for r in before}
            old = {r["doc_id"]: r["text"] for r in before}
            for r in after:
                assert brute.secrets(r["text"])[1] == []
                if r["text"] != old[r["doc_id"]]:
                    assert "[SECRET]" in r["text"]
            assert new.where(F.col("n_chars") != F.length("text")).isEmpty()
        seen = new
    last = corpus_pipeline.STAGES[-1][1](spark, seen, SF0001)
    assert {r["doc_id"] for r in last.select("doc_id").distinct().collect()} == {r["doc_id"] for r in seen.select("doc_id").collect()}


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "some words", "en", None, 10)]
    docs = spark.createDataFrame(rows, table(spark, SF0001, "documents").schema)
    for name, stage in corpus_pipeline.STAGES:
        for d in (docs, docs.limit(0)):
            got = stage(spark, d, SF0001)
            if name == "packing":
                assert {r["doc_id"] for r in got.collect()} == {r["doc_id"] for r in d.collect()}
            else:
                assert got.columns == docs.columns and got.count() == d.count(), name
