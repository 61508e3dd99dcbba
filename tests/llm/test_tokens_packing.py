"""Token counts and packing against the libraries themselves."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdeck.llm import packing, tokens
from sparkdeck.llm.queries import tokenizer_path
from tests.conftest import SF0001

ODD = ["", None, " ", "\n", "a  b\n c\t", "▁▁a▁b", "<s></s><unk><0x0A>", "é é \U0001F600 \x00\x7f\x85", "x" * 20_000, "ab " * 20_000,
       "<|endoftext|> İ ΣΑΣ ﬁ 12 it's...", "…“quoted” — dash"]


def odd_rows(spark):
    rng = random.Random(3)
    chars = " \n\t▁aeB's<|endoftext|>ÉéßÄ1234ĀſΣ.,\"th-_…İ́"
    texts = ODD + ["".join(rng.choice(chars) for _ in range(rng.randrange(50))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(None, "no id"), (4, texts[4])]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").withColumn("length", F.lit(1))


def test_token_counts_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    rows, docs = odd_rows(spark)
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    for data, frame in ((rows, docs), (real, spark.createDataFrame(real, "doc_id long, text string"))):
        want = sorted((str(i), len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t in data)
        got = tokens.count_tokens(frame, tokenizer_path("piece_bpe_32k.model")).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == want
    assert tokens.count_tokens(docs.limit(0), tokenizer_path("piece_bpe_32k.model")).isEmpty()


def test_whole_tokens_are_proved_and_the_memo_is_bounded(monkeypatch):
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        c = tokens.Counter(f.read())
    assert len(c.whole) > 25_000
    assert all(len(c.sp.encode("\n" + p)) == 3 for p in random.Random(1).sample(list(c.whole), 300))
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 3)
    texts = [f"zqx{i} vwk{i} zqx{i}" for i in range(50)]
    assert c.counts(texts) == [len(x) for x in c.sp.encode(texts)]
    assert len(c.memo) <= len(c.whole) + 3 + 3


def check_pieces(pieces, texts, library, size=2048):
    """Every id of every document in exactly one piece; gapless sequences."""
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(texts)
    for i, ps in by_doc.items():
        ids = np.array(library.encode(texts[i] or "", add_special_tokens=False).ids + [1], dtype="<u4")
        at = 0
        for p in sorted(ps, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding, sum(p["length"] for p in pieces)


def test_packing_round_trip_and_padding(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = [r for r in odd_rows(spark)[0] if r[0] is not None][:len(ODD) + 300]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(9)).repartition(3)
    check_pieces(packing.pack(docs, tokenizer_path("word_bpe_49k.json")).collect(), dict(rows), library)
    real = spark.read.parquet(f"{SF0001}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in real.collect()}
    padding, used = check_pieces(packing.pack(real, tokenizer_path("word_bpe_49k.json"), buffer_tokens=20_000).collect(), texts, library)
    assert padding < 0.02 * used
    assert packing.pack(real.limit(0), tokenizer_path("word_bpe_49k.json")).isEmpty()
    null_ids = spark.createDataFrame([(None, "a b"), (None, None), (2**60 + 1, "c")], "doc_id long, text string")
    got = packing.pack(null_ids, tokenizer_path("word_bpe_49k.json")).collect()
    assert {r["doc_id"] for r in got} == {2**60 + 1, None} and sum(r["length"] for r in got) == 3 + 1 + 2


def cost(ends, penalty, size):
    total, at = 0, 0
    for e in ends:
        n = e - at
        total += (0 if n & (n - 1) == 0 else size - n) + penalty[e]
        at = e
    return total


@pytest.mark.parametrize("seed", range(6))
def test_windows_are_optimal(seed):
    rng = random.Random(seed)
    size = 16
    at, penalty = [], {}
    p = 0
    for _ in range(rng.randrange(1, 14)):
        p += rng.randrange(1, 9)
        at.append(p)
        penalty[p] = rng.choice([0, 1, 3])
    got = packing.best_windows(at, [penalty[x] for x in at], size)

    def all_ways(start, k):
        if k == len(at):
            yield []
        for j in range(k, len(at)):
            if at[j] - start <= size:
                for rest in all_ways(at[j], j + 1):
                    yield [at[j], *rest]

    assert got[-1] == at[-1]
    assert cost(got, penalty, size) == min(cost(w, penalty, size) for w in all_ways(0, 0))


def test_long_texts_in_pieces_give_the_same(monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice("ab \n▁.é'") for _ in range(5000))
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        c = tokens.Counter(f.read())
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        e = packing.ChunkEncoder(f.read())
    plain = text.replace("▁", " ")
    whole = len(c.sp.encode(text)), e._encode(plain), e._encode("short one")
    monkeypatch.setattr(tokens, "PIECE_CHARACTERS", 37)
    monkeypatch.setattr(packing, "PIECE_CHARACTERS", 37)
    assert c.count(text) == whole[0]
    assert [x.tolist() for x in e.encode_all([plain, "short one", "", plain])] == [whole[1], whole[2], [], whole[1]]


def test_ids_are_the_librarys_when_memos_are_tiny(monkeypatch):
    """Every chunk is dropped and learnt again, or recalled from the old half."""
    tokenizer = open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8").read()
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 3)
    monkeypatch.setattr(packing, "CALL_PRETOKENS", 4)
    e = packing.ChunkEncoder(tokenizer)
    texts = ["one, two (three) it's one. two", "", "Three two's 42 " + "x" * 200 + " one", "ciónllaras über-one two... three!"] * 3
    for t in texts * 2:
        (ids,) = e.encode_all([t])
        assert ids.tolist() == e.library.encode(t, add_special_tokens=False).ids
    assert all("x" * 200 not in half for half in (e.young, e.old))
    assert [x.tolist() for x in e.encode_all(texts)] == [e.library.encode(t, add_special_tokens=False).ids for t in texts]
