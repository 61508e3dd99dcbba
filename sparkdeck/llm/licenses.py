"""License scan: base phrases, and an exact set-similarity join with templates.

Base: places where a phrase's words stand consecutively in a text.  Method: a
text block (sentence or paragraph) carries a template's label when it holds at
least ``threshold`` of the template's distinct words.  Blocks are found by a
prefix-filtered join:

* words are ordered by how many documents hold them (over all documents),
  rare first; only template words can add to an overlap, so a block is its
  template words in that order;
* prefix filter: with a needed overlap ``o = ceil(threshold * |T|)``, the pair
  must share a word within the first ``|T| - o + 1`` words of the template and
  the first ``|B| - o + 1`` of the block;
* length filter: ``|B| >= o``; positional filter: at the first shared word, in
  places i and j, ``1 + min(|T| - i, |B| - j) >= o``;
* the pairs left are verified by the whole intersection.

Plan: one aggregation of template-word document counts (at most one row per
template word reaches the driver), then one pass: blocks of documents that hold
any prefix word are exploded, joined with the prefix index (broadcast: its rows
are words of ``templates``, at most ``MAX_INDEX``; otherwise Spark chooses) and
grouped per document with one marker row per document.

Defined results: a null text is empty; a text without words has no labels and
score 0; repeated rows each get a row; ties change nothing (sets); a template
without words matches nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdeck.llm.common import SQL_WORDS, literal_array, words

# The base phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Sentences of public license notices and the labels they give.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction."),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "You may not use this file except in compliance with the License."),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an AS IS BASIS, without warranties or conditions of any kind, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation."),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]

THRESHOLD = 0.9
#: Sentence ends and blank lines part the blocks; a line break alone does not.
BLOCK_ENDS = r"[.!?]+[ \t\n\x0B\f\r]+|\n[ \t\n\x0B\f\r]*\n"
MAX_INDEX = 100_000


def template_sets(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(template, label, tokens): distinct words of each template."""
    rows = [(i, label, text) for i, (label, text) in enumerate(templates)]
    t = spark.createDataFrame(rows, "template int, label string, text string")
    return t.select("template", "label", F.array_distinct(words(F.col("text"))).alias("tokens"))


def document_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each vocabulary word occurs, over all documents."""
    held = F.array_intersect(literal_array(vocabulary, "string"), words(F.col("text")))
    rows = docs.select(F.explode(held).alias("token")).groupBy("token").count().collect()  # one per vocabulary word
    return {r["token"]: r["count"] for r in rows}


def prefix_index(sets: list[tuple[int, str, list[str]]], order: dict[str, int], threshold: float) -> list[tuple]:
    """(token, place, template, label, size, need, tokens) of every prefix word
    of every template, its words in the global order."""
    out = []
    for template, label, tokens in sets:
        ranked = sorted(tokens, key=order.__getitem__)
        need = math.ceil(threshold * len(ranked) - 1e-9)
        out += [(ranked[i], i, template, label, len(ranked), need, ranked) for i in range(len(ranked) - need + 1) if need > 0]
    return out


def _phrase_starts(w: Column, phrase: str) -> Column:
    """0-based starts of the phrase's words in ``w``."""
    parts = phrase.split(" ")
    first = F.array_position(w, parts[0])
    at = F.sequence(F.lit(1), F.size(w) - len(parts) + 1)

    def here(i: Column) -> Column:
        ok = F.element_at(w, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            ok = ok & (F.element_at(w, i + k) == p)
        return ok

    return (F.when((F.size(w) >= len(parts)) & (first > 0), F.transform(F.filter(at, here), lambda i: i - 1))
            .otherwise(F.array().cast("array<int>")))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the best containment; 1 with a base phrase)."""
    spark = docs.sparkSession
    sets = [(r["template"], r["label"], r["tokens"]) for r in template_sets(spark, templates).collect() if r["tokens"]]
    vocabulary = sorted({t for _, _, tokens in sets for t in tokens})
    held = document_counts(docs, vocabulary)
    ranked = sorted(vocabulary, key=lambda t: (held.get(t, 0), t))
    index = prefix_index(sets, {t: i for i, t in enumerate(ranked)}, threshold)
    order = literal_array(ranked, "string")
    rare = literal_array(sorted({row[0] for row in index}), "string")
    least = min((row[5] for row in index), default=1)

    base = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("w", words(F.col("text")))
    base = base.withColumn("cand", F.arrays_overlap("w", rare))
    none = F.array().cast("array<int>")
    starts = F.concat(none, *[_phrase_starts(F.col("w"), p) for p, _ in phrases])
    named = F.array_distinct(F.concat(F.array().cast("array<string>"), *[
        F.when(F.size(_phrase_starts(F.col("w"), p)) > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
        for p, label in phrases]))
    maybe = F.arrays_overlap("w", literal_array([p.split(" ")[-1] for p, _ in phrases], "string"))
    d = base.select(
        "uid", "doc_id", F.size("w").alias("n_words"),
        F.when(maybe, starts).otherwise(none).alias("starts"),
        F.when(maybe, named).otherwise(F.array().cast("array<string>")).alias("named"),
        F.when(F.col("cand"), F.concat(F.array(F.lit("")), F.split("text", BLOCK_ENDS))).otherwise(F.array(F.lit("")))
        .alias("blocks"))
    at = d.select("uid", "doc_id", "n_words", "starts", "named", F.posexplode("blocks").alias("block", "txt"))
    b = at.withColumn("tokens", F.when(F.col("block") > 0, F.array_intersect(order, words(F.col("txt"))))
                      .otherwise(F.array().cast("array<string>")))
    # length filter for the smallest template; its own one follows per template
    b = b.where((F.col("block") == 0) | (F.size("tokens") >= least))
    e = b.select("uid", "doc_id", "n_words", "starts", "named", "block", "tokens",
                 F.posexplode_outer("tokens").alias("j", "token"))
    e = e.where((F.col("block") == 0) | (F.col("j") <= F.size("tokens") - least))
    idx = spark.createDataFrame(index or [("", 0, 0, "", 0, 0, [])],
                                "token string, i int, template int, label string, size int, need int, words array<string>")
    idx = idx.withColumnRenamed("token", "key")
    idx = F.broadcast(idx) if len(index) <= MAX_INDEX else idx
    n = F.size("tokens")
    room = F.least(F.col("size") - F.col("i"), n - F.col("j"))
    # a marker gets a key of its own, no word holds a space
    probe = F.coalesce(F.col("token"), F.concat(F.lit(" "), F.col("uid").cast("string")))
    j = e.join(idx, (probe == F.col("key")) & (F.col("j") <= n - F.col("need")) & (n >= F.col("need"))
               & (room >= F.col("need")), "left")
    overlap = F.size(F.array_intersect("tokens", "words"))
    part = F.when((overlap >= F.col("need")) & F.col("key").isNotNull(), overlap / F.col("size"))
    g = (j.withColumn("part", part).where((F.col("block") == 0) | F.col("part").isNotNull())
         .groupBy("uid").agg(F.max_by("doc_id", F.col("block") == 0).alias("doc_id"), F.max("n_words").alias("n_words"),
                             F.max_by("starts", F.col("block") == 0).alias("starts"),
                             F.max_by("named", F.col("block") == 0).alias("named"),
                             F.collect_set(F.when(F.col("part").isNotNull(), F.col("label"))).alias("more"),
                             F.max("part").alias("part")))
    hit = F.size("starts") > 0
    return g.select("doc_id", F.col("n_words").cast("long").alias("n_words"), F.size("starts").cast("long").alias("n_base"),
                    F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
                    F.array_join(F.array_sort("named"), ",").alias("base_labels"),
                    F.array_join(F.array_sort(F.array_union("named", "more")), ",").alias("labels"),
                    F.when(hit, F.lit(1.0)).otherwise(F.coalesce("part", F.lit(0.0))).alias("score"))


def scan_sql(templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES,
             threshold: float = THRESHOLD) -> str:
    """DuckDB: the same result over ``documents``, every block against every template."""
    text = lambda s: "'" + s.replace("'", "''") + "'"
    listed = ", ".join(f"({i}, {text(label)}, {text(t)})" for i, (label, t) in enumerate(templates))
    places = []
    for phrase, label in phrases:
        parts = phrase.split(" ")
        same = " AND ".join(f"w[i + {k}] = {text(p)}" for k, p in enumerate(parts))
        places.append(f"SELECT rid, i - 1 AS place, {text(label)} AS label FROM p WHERE {same}")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS txt, {SQL_WORDS.format('text')} AS w FROM documents),
t AS (SELECT id, label, list_distinct({SQL_WORDS.format('body')}) AS tokens FROM (VALUES {listed}) AS v(id, label, body)),
p AS (SELECT rid, w, unnest(range(1, CAST(len(w) + 1 AS BIGINT))) AS i FROM d),
h AS ({' UNION ALL '.join(places)}),
base AS (SELECT rid, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS named FROM h GROUP BY rid),
b AS (SELECT rid, list_distinct({SQL_WORDS.format('block')}) AS tokens
      FROM (SELECT rid, unnest(string_split_regex(txt, '{BLOCK_ENDS}')) AS block FROM d)),
m AS (SELECT b.rid, t.label, len(list_intersect(b.tokens, t.tokens)) / len(t.tokens) AS part
      FROM b, t WHERE len(list_intersect(b.tokens, t.tokens)) >= ceil({threshold} * len(t.tokens) - 1e-9)),
more AS (SELECT rid, list(DISTINCT label) AS labels, max(part) AS part FROM m GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base,
       CAST(base.lo AS BIGINT) AS first_word, CAST(base.hi AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(base.named), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.named, []), coalesce(more.labels, [])))), ','), '') AS labels,
       CAST(CASE WHEN base.n > 0 THEN 1.0 ELSE coalesce(more.part, 0.0) END AS DOUBLE) AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN more USING (rid)
"""
