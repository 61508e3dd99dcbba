"""Exact token counts with a whole-token shortcut.

A SentencePiece BPE model merges pieces of its vocabulary only.  Two facts are
proved once per model, on the driver (``analyse``):

* no vocabulary string holds a word-start mark after another character, and no
  string holds a line break: so no merge crosses the start of a run of marks or
  a line break, and a text's tokens are those of its pre-tokens (a run of marks
  with the characters that follow it);
* which vocabulary strings encode alone, as a pre-token, to one token.

A pre-token in that set counts one without any merging; the library merges only
the rest, and their counts are kept in a bounded memo per worker.  A model
without these properties (other algorithm, normalisation, user-defined pieces)
is handed whole texts.

The result is a scalar pandas UDF over the text column: no shuffle, one row in,
one row out.  Texts are taken whole, whatever their length.  Defined results: a
null or empty text has 0 bytes and 0 tokens; repeated rows each get a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdeck.llm.common import ship

MARK = "▁"
#: Sure boundary used to encode a pre-token that has no leading mark.
BREAK = "\n"
#: A worker's memo is emptied beyond so many entries or characters.
MEMO_ENTRIES, MEMO_CHARACTERS = 500_000, 16_000_000
#: Characters of unseen pre-tokens given to the library at once.
CALL_CHARACTERS = 20_000
#: Pre-token: a run of marks and what follows it, or characters after a break.
PRETOKEN = re.compile(f"{MARK}+[^{MARK}{BREAK}]*|[^{MARK}{BREAK}]+")
BOUNDARY = re.compile(f"[^{MARK}](?={MARK})|{BREAK}")
PIECE_CHARACTERS = 1_000_000

_WORKERS: dict[bytes, "Counter"] = {}


def analyse(model: bytes) -> dict | None:
    """What the shortcut needs, or None if the model does not allow it."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    plain = "a  b" + BREAK + "c "
    identity = sp.encode(plain, out_type=str)
    shown = [x.replace(MARK, " ") if not re.fullmatch(r"<0x[0-9A-F]{2}>", x) else chr(int(x[3:5], 16)) for x in identity]
    if "".join(shown) != " " + plain or any(re.search(f"[^{MARK}]{MARK}", p) or BREAK in p for p in pieces):
        return None
    if any(sp.is_unused(i) for i in range(sp.get_piece_size())) or sp.encode(BREAK, out_type=str) != [MARK, "<0x0A>"]:
        return None
    alone = [p for p in pieces if PRETOKEN.fullmatch(p)]
    encoded = sp.encode([BREAK + p for p in alone], out_type=int)
    whole = [p for p, ids in zip(alone, encoded, strict=True) if len(ids) == 3]
    return {"whole": whole, "tokens": len(pieces)}


def pieces(marked: str) -> Iterator[str]:
    """A marked text in parts of about ``PIECE_CHARACTERS`` that end where a
    pre-token ends, so that the list of pre-tokens in memory is bounded."""
    at = 0
    while len(marked) - at > PIECE_CHARACTERS and (m := BOUNDARY.search(marked, at + PIECE_CHARACTERS)):
        yield marked[at:m.end()]
        at = m.end()
    yield marked[at:]


class Counter:
    """Counts tokens of texts with one model (one per worker process)."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        found = analyse(model)
        self.whole = dict.fromkeys(found["whole"], 1) if found else None
        self.memo, self.held = dict(self.whole or {}), 0
        self.break_id = self.sp.encode(BREAK)[-1]

    def merge(self, pretokens: list[str]) -> None:
        """Adds the counts of unseen pre-tokens to the memo.  Breaks part them,
        so many go through the library at once."""
        at = 0
        while at < len(pretokens):
            end, size = at, 0
            while end < len(pretokens) and size < CALL_CHARACTERS:
                size += len(pretokens[end])
                end += 1
            ids = np.array(self.sp.encode(BREAK + BREAK.join(pretokens[at:end]) + BREAK))
            stops = np.flatnonzero(ids == self.break_id)
            self.memo.update(zip(pretokens[at:end], (np.diff(stops) - 1).tolist(), strict=True))
            self.held += size
            at = end

    def counts(self, texts: list[str]) -> list[int]:
        if self.whole is None:
            return [len(ids) for ids in self.sp.encode(texts, num_threads=1)] if texts else []
        return [self.count(text) for text in texts]

    def count(self, text: str) -> int:
        if not text:
            return 0
        # the model marks the start of the text and every blank
        return text.count(BREAK) + sum(map(self._tokens, pieces(MARK + text.replace(" ", MARK))))

    def _tokens(self, marked: str) -> int:
        found = PRETOKEN.findall(marked)
        try:
            return sum(map(self.memo.__getitem__, found))
        except KeyError:
            if len(self.memo) > len(self.whole) + MEMO_ENTRIES or self.held > MEMO_CHARACTERS:
                self.memo, self.held = dict(self.whole), 0
            self.merge([p for p in set(found) if p not in self.memo])
            return sum(map(self.memo.__getitem__, found))


def counter(model: bytes) -> Counter:
    if model not in _WORKERS:
        _WORKERS[model] = Counter(model)
    return _WORKERS[model]


def token_count(text: Column, model: bytes) -> Column:
    """Number of tokens of a text column under a SentencePiece model."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(model)
        for texts in batches:
            yield pd.Series(c.counts(texts.tolist()), dtype="int64")

    return count(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """Per document row: doc_id, n_bytes, n_tokens, over_limit."""
    with open(model_path, "rb") as f:
        model = f.read()
    ship(docs.sparkSession)
    d = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                    token_count(F.col("text"), model).alias("n_tokens"))
    return d.withColumn("over_limit", F.col("n_tokens") > limit)
