"""Secret scan: three patterns plus a log-likelihood ratio of two Markov models.

The patterns find *assign* (a credential name, a sign, a value), *access* (key
ids) and *hex* (long hexadecimal runs), leftmost and without overlap per kind.
The method adds *markov*: a run of key characters is a secret when a character
Markov model of random strings explains it better than one of ordinary
identifiers, by a log-likelihood ratio over ``MIN_RATIO``.  Of a run that
overlaps spans of the patterns, the pieces outside them are scored, each on its
own and whatever its length.

Both models are first-order over folded characters and are trained with Spark
aggregations from labelled samples (``token``, ``is_random``); ``corpus_samples``
takes them from the corpus: values that the patterns found are random strings,
other long words are ordinary identifiers.  Only the folded bigram counts
(at most 2 x 66^2 rows) reach the driver.

Everything runs in built-in expressions: a text is marked once per kind with
``regexp_replace`` (private-use delimiters, linear in the text), split, and the
code-point offsets follow from the lengths of the parts.  No shuffle.

Defined results: a null text is empty and has no spans; repeated rows each get
a row; offsets are code points, the end exclusive; equal starts are ordered
assign, access, hex, markov.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdeck.llm.common import fresh, literal_array

# The patterns of the three base kinds, in the order of kinds.
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ["assign", "access", "hex", "markov"]
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

# Minimum lengths folded into the pattern where matches are maximal runs (a
# run is kept or dropped whole, so the shorter runs need not be visited).
ACCESS_LONG = r"AKIA[A-Z0-9]{16,}"
HEX_LONG = r"[0-9a-f]{24,}"

#: Runs of key characters looked at by the models, and the needed ratio in nats.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
MIN_RATIO = 12.0
#: Documents (expected number) whose words and pattern values train the models.
SAMPLE_DOCS = 4000
#: At most so many training tokens of either label.
SAMPLE_TOKENS = 50_000

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
OPEN, STAND_IN = "\uE000", "\uE001"
SPAN = "array<struct<start:int,end:int,txt:string>>"


#: Elements that one fold appends to an array; longer arrays are folded in
#: blocks, since each append copies what there is.  Even: parts and matches
#: alternate.
BLOCK = 256


def let(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def in_blocks(values: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` elements."""
    last = F.greatest(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))


def before_each(blocks: Column, measure, join) -> Column:
    """For each block, ``join`` (a sum or a maximum) of the measures of those before it."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(blocks, zero, lambda acc, b: F.struct(
        join(acc["at"], measure(b)).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")), lambda acc: acc["all"])


def find_spans(text: Column, pattern: str) -> Column:
    """(start, end, txt) of all leftmost non-overlapping matches.  ``text``
    must not hold the delimiter (see ``safe_text``)."""
    parts = F.split(F.regexp_replace(text, pattern, f"{OPEN}$0{OPEN}"), OPEN, -1)
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.length(x)
        one = F.array(F.struct(acc["at"].alias("start"), end.alias("end"), x.alias("txt"))).cast(SPAN)
        return F.struct(end.alias("at"), (acc["i"] + 1).alias("i"),
                        F.when(acc["i"] % 2 == 1, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def moved(block: Column, by: Column) -> Column:
        return F.transform(block["out"], lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["txt"].alias("txt")))

    def whole(blocks: Column) -> Column:  # offsets within a block, then those of the blocks
        return F.flatten(F.zip_with(blocks, before_each(blocks, lambda b: b["at"], lambda a, b: a + b), moved))

    folded = F.transform(in_blocks(parts), lambda b: F.aggregate(b, zero, step))
    return F.when(text.rlike(pattern), let(folded, whole)).otherwise(F.array().cast(SPAN))


def safe_text(text: Column) -> Column:
    """The text with the delimiter replaced by another private-use character
    (neither occurs in a pattern, so no match and no offset changes)."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit(OPEN), F.lit(STAND_IN))


def base_spans(text: Column) -> dict[str, Column]:
    assign = F.filter(find_spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["txt"], ASSIGN, 2)) >= MIN_VALUE)
    return {"assign": assign, "access": find_spans(text, ACCESS_LONG), "hex": find_spans(text, HEX_LONG)}


# ----------------------------------------------------------------- models --

def corpus_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> DataFrame:
    """(token, is_random) from about ``sample_docs`` documents chosen by a hash
    of id and text: values of the patterns, and words of 8 or more letters."""
    share = max(1, docs.count() // sample_docs)
    t = (docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0)
         .select(safe_text(F.col("text")).alias("t")))
    spans = base_spans(F.col("t"))
    values = F.concat(F.transform(spans["assign"], lambda s: F.regexp_extract(s["txt"], ASSIGN, 2)),
                      F.transform(spans["access"], lambda s: s["txt"]), F.transform(spans["hex"], lambda s: s["txt"]))
    words = F.filter(F.split("t", r"[^A-Za-z_-]+"), lambda w: (F.length(w) >= 8) & (F.length(w) <= 64))
    def some(tokens: Column, is_random: bool) -> DataFrame:
        return (t.select(F.explode(tokens).alias("token")).distinct().orderBy(F.xxhash64("token"), "token")
                .limit(sample_tokens).withColumn("is_random", F.lit(is_random)))

    return some(values, True).unionByName(some(words, False))


def fold(c: Column) -> Column:
    """1-based index of a character in the alphabet, 0 for any other."""
    return F.instr(F.lit(ALPHABET), c)


def train(samples: DataFrame, smoothing: float = 1.0) -> list[float]:
    """Log-likelihood ratio (random over identifier) of each folded bigram, row
    by row of a (|alphabet|+1)^2 table.  Without samples of a label its model
    is uniform over the alphabet."""
    t = samples.where(F.length("token") > 1).select("is_random", F.transform(F.split("token", ""), fold).alias("p"))
    grams = t.select("is_random", F.explode(F.zip_with(
        F.slice("p", F.lit(1), F.size("p") - 1), F.slice("p", F.lit(2), F.size("p") - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("g"))
    rows = grams.groupBy("is_random", "g.a", "g.b").count().collect()  # at most 2 x 68^2
    k = len(ALPHABET) + 1
    counts = {True: [[smoothing] * k for _ in range(k)], False: [[smoothing] * k for _ in range(k)]}
    for r in rows:
        counts[r["is_random"]][r["a"]][r["b"]] += r["count"]
    out = []
    for a in range(k):
        total = {y: sum(counts[y][a]) for y in (True, False)}
        out += [math.log(counts[True][a][b] / total[True]) - math.log(counts[False][a][b] / total[False]) for b in range(k)]
    return out


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a token under the two models, in nats: one pass
    over its characters."""
    k = len(ALPHABET) + 1
    at = literal_array([round(x, 6) for x in model], "double")
    zero = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    places = F.transform(F.split(token, ""), fold)
    return F.aggregate(places, zero, lambda acc, i: F.struct(
        i.alias("last"), (acc["sum"] + F.when(acc["last"] >= 0, F.element_at(at, acc["last"] * k + i + 1)).otherwise(0.0)).alias("sum")),
        lambda acc: acc["sum"])


# ------------------------------------------------------------------- scan --

def _tagged(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))


def outlined(spans: Column) -> Column:
    """Spans in blocks, each with its least start and greatest end."""
    return F.transform(in_blocks(spans), lambda b: F.struct(
        F.array_min(F.transform(b, lambda s: s["start"])).alias("start"), F.array_max(F.transform(b, lambda s: s["end"])).alias("end"), b.alias("spans")))


def outside(s: Column, blocks: Column) -> Column:
    """The pieces of a span that no span of ``blocks`` (``outlined``, ordered by
    start) covers."""
    def piece(start: Column, end: Column) -> Column:
        txt = F.substring(s["txt"], start - s["start"] + 1, end - start)
        return F.array(F.struct(start.alias("start"), end.alias("end"), txt.alias("txt"))).cast(SPAN)

    def step(acc: Column, b: Column) -> Column:
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"),
                        F.when(acc["at"] < b["start"], F.concat(acc["out"], piece(acc["at"], b["start"]))).otherwise(acc["out"]).alias("out"))

    def meets(b: Column) -> Column:
        return (b["start"] < s["end"]) & (s["start"] < b["end"])

    over = F.flatten(F.transform(F.filter(blocks, meets), lambda b: F.filter(b["spans"], meets)))
    zero = F.struct(s["start"].alias("at"), F.array().cast(SPAN).alias("out"))
    rest = F.aggregate(over, zero, step, lambda acc: F.when(
        acc["at"] < s["end"], F.concat(acc["out"], piece(acc["at"], s["end"]))).otherwise(acc["out"]))
    return F.when(F.size(over) > 0, rest).otherwise(F.array(s).cast(SPAN))


def with_spans(docs: DataFrame, model: list[float], out: str = "found", min_ratio: float = MIN_RATIO) -> DataFrame:
    """Adds ``out``: a struct of ``base`` and ``all``, arrays of (start, rank,
    end) ordered by start and kind."""
    t = F.col(f"{out}.t")
    d = docs.withColumn(out, F.struct(safe_text(F.col("text")).alias("t")))
    spans = base_spans(t)
    base = F.concat(*[_tagged(spans[k], k) for k in KINDS[:3]])
    d = d.withColumn(out, F.struct(t.alias("t"), F.array_sort(base).alias("base")))
    base = F.col(f"{out}.base")
    d = d.withColumn(out, F.struct(t.alias("t"), base.alias("base"), outlined(base).alias("blocks")))
    pieces = F.flatten(F.transform(find_spans(t, TOKEN), lambda s: outside(s, F.col(f"{out}.blocks"))))
    extra = F.filter(pieces, lambda s: ratio(s["txt"], model) >= min_ratio)
    return d.withColumn(out, F.struct(base.alias("base"), F.array_sort(F.concat(base, _tagged(extra, "markov"))).alias("all")))


def _written(spans: Column) -> Column:
    names = literal_array(KINDS, "string")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, model: list[float] | None = None) -> DataFrame:
    """Per document row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    model = train(corpus_samples(docs)) if model is None else model
    d = with_spans(docs.select("doc_id", "text"), model)
    count = lambda kind: F.size(F.filter(F.col("found.base"), lambda s: s["rank"] == KINDS.index(kind))).cast("long")
    return d.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                    F.sha2(_written(F.col("found.base")), 256).alias("base_sha256"), _written(F.col("found.all")).alias("spans"))


def redact(docs: DataFrame, model: list[float] | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` (all columns) with every span, overlapping ones merged,
    replaced by ``mark`` in ``text``; texts without spans are unchanged."""
    model = train(corpus_samples(docs)) if model is None else model
    name = fresh("found", docs.columns)
    d = with_spans(docs, model, name)
    spans = F.col(f"{name}.all")
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        gap = text.substr(acc["at"] + 1, s["start"] - acc["at"])
        fresh = s["start"] >= acc["at"]
        return F.struct(F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"),
                        F.greatest(acc["at"], s["end"]).alias("at"))

    def whole(blocks: Column) -> Column:
        # each block starts where the spans before it end
        ends = lambda b: F.array_max(F.transform(b, lambda s: s["end"]))
        pieces = F.zip_with(blocks, before_each(blocks, ends, F.greatest), lambda b, at: F.aggregate(
            b, F.struct(F.lit("").alias("out"), at.alias("at")), step, lambda acc: acc["out"]))
        rest = text.substr(F.array_max(F.flatten(F.transform(blocks, lambda b: F.transform(b, lambda s: s["end"])))) + 1, F.length(text))
        return F.concat(F.array_join(pieces, ""), rest)

    cleaned = F.when(F.size(spans) > 0, let(in_blocks(spans), whole)).otherwise(text)
    return d.withColumn("text", cleaned).drop(name)
