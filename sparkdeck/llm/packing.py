"""Order-preserving packing of token streams into fixed-length sequences.

The documents of a scan partition are one stream of token ids (each document
ends with ``end_id``).  Sequences are consecutive windows of the stream; a
window may be cut after a document, after a sentence or, inside a sentence of
more than ``HARD_STEP`` tokens, every ``HARD_STEP`` tokens.  A window of n
tokens costs its padding (``size - n``; none where n is a power of two) plus
the penalty of the cut that ends it.  The dynamic program

    best[j] = penalty(j) + min over cuts i, 0 < p(j) - p(i) <= size, of
              best[i] + padding(p(j) - p(i))

takes the minimum of ``best[i] + p(i)`` over a sliding window with a monotone
queue, and looks at the cuts a power of two away one by one.  The last window
of a partition, if it is not full, is split into power-of-two windows.

Memory: documents stream through; the program runs whenever ``BUFFER_TOKENS``
tokens are held, emits its windows but the last and carries the rest on, so a
partition of any size needs one buffer plus its longest document.  No shuffle;
sequence ids combine the partition number and a counter.

Token ids are exactly the library's.  White space parts the pre-tokens of the
word tokenizer, so the ids of a chunk between blanks do not depend on its
neighbours, and are those of its pre-tokens.  A worker keeps pre-tokens, and
chunks made of known ones, in a bounded memo; when it is full, the half not used
lately goes.  The library sees only pre-tokens that it does not hold.  This holds
for texts of printable ASCII, common white space and Latin letters with
one-character lower case; any other text goes through the library whole.

Defined results: a null or empty text is the end id alone; every row is packed,
repeated ones too; an empty table gives no piece.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdeck.llm.common import ship
from sparkdeck.llm.textnp import runs

SIZE = 2048
END_ID = 1
HARD_STEP = 24
#: Cost, in padding tokens, of cutting at the end of a document, of a sentence,
#: or inside a sentence.
DOCUMENT_PENALTY, SENTENCE_PENALTY, HARD_PENALTY = 0, 1, 8
BUFFER_TOKENS = 64 * SIZE
#: Entries of one half of the memo; longer strings are not kept.
MEMO_ENTRIES, KEPT_CHARACTERS = 600_000, 48
#: Characters of texts looked up at once: their words stay in the CPU's caches.
GROUP_CHARACTERS = 1 << 15
#: Unseen pre-tokens given to the library at once.
CALL_PRETOKENS = 2_000

# The pre-token pattern and the word-end mark of the word tokenizer.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"
SENTENCE_ENDS = [".", "!", "?", "...", '."', '!"', '?"', ".)"]

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Anything but printable ASCII, tab, line feed, carriage return and Latin
#: letters whose lower case is one letter (not U+0130, U+0149, U+01F0).
UNSAFE = re.compile("[^\t\n\r -~À-ÖØ-öø-įı-ňŊ-ſ]")
BLANK = re.compile(r"\s")
PIECE_CHARACTERS = 1_000_000

_WORKERS: dict[str, "ChunkEncoder"] = {}


def pieces(text: str) -> Iterator[str]:
    """A long text in parts of about ``PIECE_CHARACTERS``, cut at white space."""
    at = 0
    while len(text) - at > PIECE_CHARACTERS and (m := BLANK.search(text, at + PIECE_CHARACTERS)):
        yield text[at:m.start()]
        at = m.end()
    yield text[at:]


def _places(values: list) -> list[int]:
    """Where a list holds None."""
    out, at = [], -1
    try:
        while True:
            at = values.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


class ChunkEncoder:
    """Ids of whole texts with one tokenizer (one per worker process)."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        ends = [i for token, i in self.library.get_vocab().items() if token.endswith(WORD_END)]
        self.is_end = np.zeros(max(ends, default=0) + 2, dtype=bool)
        self.is_end[ends] = True
        # ids (little-endian) by string: what is used moves to the young half
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.blank_parts = self._blank_parts()

    def _blank_parts(self) -> bool:
        """Whether chunks between blanks encode alone: tried on a probe (the
        word tokenizer drops white space; others keep it in their pieces)."""
        probe = "It's one-two, thr33 \n\t x  ...y's"
        alone = [i for c in probe.split() for i in self._encode(c)]
        return (alone == self._encode(probe) and not any(" " in s for s in self.special)
                and sum(self.is_end[min(i, len(self.is_end) - 1)] for i in alone) == len(PRETOKEN.findall(probe.lower())))

    def _encode(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _merge(self, pretokens: list[str]) -> dict[str, bytes]:
        """Ids of unseen pre-tokens, many in one call: each ends in one word-end
        id, where the ids fall apart."""
        out: dict[str, bytes] = {}
        for at in range(0, len(pretokens), CALL_PRETOKENS):
            some = pretokens[at:at + CALL_PRETOKENS]
            ids = np.array(self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self.is_end[np.minimum(ids, len(self.is_end) - 1)]) + 1
            if len(ends) != len(some) or ends[-1] != len(ids):
                raise ValueError("the tokenizer does not end every pre-token with a word-end id")
            raw, places = ids.tobytes(), [0, *(4 * ends).tolist()]
            out.update(zip(some, [raw[x:y] for x, y in pairwise(places)], strict=True))
        return out

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks that the young half does not hold."""
        young, old, known = self.young, self.old, {}
        new: dict[str, None] = {}
        made: list[tuple[str, list[str]]] = []
        for c in chunks:
            if (ids := old.get(c)) is not None:
                known[c] = young[c] = ids
            elif c.isalpha():  # letters alone are one pre-token
                new[c] = None
            else:
                made.append((c, PRETOKEN.findall(c)))
        often = []  # chunks made of what was known before
        for c, parts in made:
            unseen = False
            for p in parts:
                if p not in young and p not in known:
                    if (ids := old.get(p)) is not None:
                        known[p] = ids
                    else:
                        new[p] = None
                        unseen = True
            if not unseen and len(c) <= KEPT_CHARACTERS:
                often.append(c)
        if new:
            merged = self._merge(list(new))
            known.update(merged)
            long = [p for p in merged if len(p) > KEPT_CHARACTERS]
            young.update(merged)
            for p in long:
                del young[p]
        for c, parts in made:
            known[c] = b"".join([known.get(p) or young[p] for p in parts])
        for c in often:
            young[c] = known[c]
        return known

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out = []
        for t in texts:
            # special strings in a text are matched before anything else is
            # done, so a text with one is handed over whole
            safe = self.blank_parts and not UNSAFE.search(t) and not any(s in t for s in self.special)
            out.append(t.lower() if safe else np.array(self._encode(t), dtype="<u4"))
        short = [t for t in out if isinstance(t, str) and len(t) <= PIECE_CHARACTERS]
        found = iter(self._of_chunks([t.split() for t in short]))
        return [t if isinstance(t, np.ndarray) else next(found) if len(t) <= PIECE_CHARACTERS
                else np.concatenate([self._of_chunks([p.split()])[0] for p in pieces(t)]) for t in out]

    def _of_chunks(self, chunks: list[list[str]]) -> list[np.ndarray]:
        if len(self.young) > MEMO_ENTRIES:
            self.old, self.young = self.young, {}
        held = self.young.get
        found = [list(map(held, c)) for c in chunks]
        holes = [_places(ids) for ids in found]
        if unseen := {c[i] for c, at in zip(chunks, holes, strict=True) for i in at}:
            learnt = self._learn(unseen)
            for c, ids, at in zip(chunks, found, holes, strict=True):
                for i in at:
                    ids[i] = learnt[c[i]]
        return [np.frombuffer(b"".join(ids), dtype="<u4") for ids in found]


def encoder(tokenizer: str) -> ChunkEncoder:
    if tokenizer not in _WORKERS:
        _WORKERS[tokenizer] = ChunkEncoder(tokenizer)
    return _WORKERS[tokenizer]


def cut_places(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions (token counts before the cut) in a stream and their
    penalties.  ``doc_ends``: where its documents end; ``ends_sentence``: by id."""
    stops = np.flatnonzero(ends_sentence[ids]) + 1
    at = np.union1d(stops, doc_ends)
    penalty = np.full(len(at), SENTENCE_PENALTY, dtype=np.int64)
    penalty[np.searchsorted(at, doc_ends)] = DOCUMENT_PENALTY
    start = np.concatenate([[0], at[:-1]])
    more = (at - start - 1) // HARD_STEP  # cuts inside a long sentence
    if more.any():
        first = np.cumsum(more) - more
        hard = np.repeat(start, more) + HARD_STEP * (np.arange(more.sum()) - np.repeat(first, more) + 1)
        order = np.argsort(np.concatenate([at, hard]), kind="stable")
        penalty = np.concatenate([penalty, np.full(len(hard), HARD_PENALTY, dtype=np.int64)])[order]
        at = np.concatenate([at, hard])[order]
    return at, penalty


def best_windows(at: list[int], penalty: list[int], size: int = SIZE) -> list[int]:
    """Ends of the cheapest windows from 0 to the last position of ``at``
    (increasing, gaps of at most ``size``)."""
    pos = [0, *at]
    # windows of a power of two: (end, start) of those that lie between two cuts
    places = np.array(pos, dtype=np.int64)
    ends, starts = [], []
    for w in (1 << k for k in range(size.bit_length()) if (1 << k) < size):
        i = np.searchsorted(places, places - w)
        k = np.flatnonzero((places >= w) & (places[i] == places - w))
        ends.append(k)
        starts.append(i[k])
    ends, starts = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(ends, kind="stable")
    starts = starts[order].tolist()
    until = np.searchsorted(ends[order], np.arange(len(pos) + 1), side="right").tolist()
    best, back = [0], [0]
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best + position, index), both increasing
    done = until[0]
    for k, (p, extra) in enumerate(zip(at, penalty, strict=True), 1):
        low = p - size
        while pos[queue[0][1]] < low:
            queue.popleft()
        value, source = queue[0]
        value += size - p
        if until[k] > done:
            for i in starts[done:until[k]]:
                if best[i] < value:
                    value, source = best[i], i
            done = until[k]
        value += extra
        best.append(value)
        back.append(source)
        key = value + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, k))
    out, i = [], len(at)
    while i:
        out.append(pos[i])
        i = back[i]
    return out[::-1]


def power_windows(start: int, end: int, size: int) -> list[int]:
    """Ends of windows of power-of-two lengths from start to end, longest first."""
    out = []
    while start < end:
        step = min(size, 1 << ((end - start).bit_length() - 1))
        start += step
        out.append(start)
    return out


class Stream:
    """Documents of one partition waiting to be packed."""

    def __init__(self, size: int, sequence: int, ends_sentence: np.ndarray):
        self.size, self.sequence, self.ends_sentence = size, sequence, ends_sentence
        self.docs: list[tuple[object, np.ndarray, int]] = []  # id, ids, first token not packed yet
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0))
        self.held += len(ids)

    def pack(self, last: bool) -> list[tuple]:
        """Pieces of all complete windows; of everything if ``last``."""
        if not self.held:
            return []
        waiting = [ids[done:] for _, ids, done in self.docs]
        at, penalty = cut_places(np.concatenate(waiting), np.cumsum([len(w) for w in waiting]), self.ends_sentence)
        ends = best_windows(at.tolist(), penalty.tolist(), self.size)
        # the last windows have not seen what follows: leave the rest to the next run
        if not last:
            ends = ends[:-2]
        elif (n := ends[-1] - (ends[-2] if len(ends) > 1 else 0)) & (n - 1):
            ends = ends[:-1] + power_windows(ends[-1] - n, ends[-1], self.size)
        return self._pieces(ends)

    def _pieces(self, ends: list[int]) -> list[tuple]:
        out, d, base = [], 0, 0  # base: stream position of document d's first token not packed
        start = 0
        for end in ends:
            at = start
            while at < end:
                doc_id, ids, done = self.docs[d]
                n = min(end - at, len(ids) - done)
                piece = ids[done:done + n]
                out.append((doc_id, done, n, zlib.crc32(piece.tobytes()), len(ids), self.sequence, at - start))
                at += n
                if done + n == len(ids):
                    d += 1
                else:
                    self.docs[d] = (doc_id, ids, done + n)
            start = end
            self.sequence += 1
        self.docs = self.docs[d:]
        self.held -= start
        return out


def _groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of runs of rows: only these texts are Python objects, the
    rest of a batch stays in Arrow's buffer."""
    for batch in batches:
        doc_ids, texts = batch.columns
        for x, y in runs(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), GROUP_CHARACTERS):
            yield doc_ids.slice(x, y - x).to_pylist(), [t or "" for t in texts.slice(x, y - x).to_pylist()]


def _batch(pieces: list[tuple]) -> pa.RecordBatch:
    """Pieces as columns."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pieces, strict=True)], names=names)


def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end_id: int = END_ID,
         buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  ``docs`` needs doc_id and text."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        last = {i for x in SENTENCE_ENDS for i in enc.library.encode(x, add_special_tokens=False).ids[-1:]} | {end_id}
        ends_sentence = np.zeros(max(*last, enc.library.get_vocab_size()) + 1, dtype=bool)
        ends_sentence[list(last)] = True
        stream = Stream(size, TaskContext.get().partitionId() << 33, ends_sentence)
        end = np.array([end_id], dtype="<u4")
        for ids, texts in _groups_of(batches):
            out: list[tuple] = []
            for doc_id, found in zip(ids, enc.encode_all(texts), strict=True):
                stream.add(doc_id, np.append(found, end))
                if stream.held >= buffer_tokens:
                    out += stream.pack(False)
            if out:
                yield _batch(out)
        if out := stream.pack(True):
            yield _batch(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
