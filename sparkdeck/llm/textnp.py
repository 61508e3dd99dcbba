"""Word and shingle hashes of many texts at once, in numpy.

A batch of texts is one byte array.  Words are runs of ASCII letters, digits
and bytes of non-ASCII characters after lower-casing A-Z; a word's hash comes
from differences of one running polynomial sum over the bytes (modulo 2^64),
so no Python object is made per word.  Texts are cut into pieces of at most
``PIECE`` bytes at word boundaries, which bounds the arrays, not the texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[ord("0"):ord("9") + 1] = _WORD[ord("a"):ord("z") + 1] = _WORD[128:] = True
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (all bits depend on all bits)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE + 1024)
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = []
        for b in (_BASE, inverse):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0][:n], _POWERS[1][:n]


def _hash_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start byte, hash) of each word of a byte string."""
    a = _LOWER[np.frombuffer(raw, dtype=np.uint8)]
    word = _WORD[a]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(a) + 1)
    run = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:len(a)], out=run[1:])
    return start, mix((run[end] - run[start]) * down[start])


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Cuts a long byte string after separators."""
    at = 0
    while len(raw) - at > PIECE:
        a = np.frombuffer(raw, dtype=np.uint8, offset=at, count=min(PIECE, len(raw) - at))
        gaps = np.flatnonzero(~_WORD[_LOWER[a]])
        end = at + int(gaps[-1]) + 1 if len(gaps) else None
        if end is None:  # a word longer than a piece: up to its end
            rest = np.frombuffer(raw, dtype=np.uint8, offset=at)
            gaps = np.flatnonzero(~_WORD[_LOWER[rest]])
            end = at + int(gaps[0]) + 1 if len(gaps) else len(raw)
        yield raw[at:end]
        at = end
    yield raw[at:]


def groups(texts: list[str | None], size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive runs (from, to) of texts of about ``size`` characters."""
    return runs((len(t or "") for t in texts), size)


def runs(lengths: Iterable[int], size: int) -> Iterator[tuple[int, int]]:
    """Consecutive runs (from, to) of texts of these lengths."""
    at, held, i = 0, 0, -1
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield at, i
            at, held = i, 0
        held += n + 1
    if at <= i:
        yield at, i + 1


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, offsets): words of text i are
    ``hashes[offsets[i]:offsets[i + 1]]``.  A null text has no words."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    if sum(map(len, raws)) + len(raws) <= 2 * PIECE:
        start, h = _hash_bytes(b"\0".join(raws) + b"\0")
        ends = np.cumsum([len(r) + 1 for r in raws]) if raws else np.empty(0, np.int64)
        return h, np.concatenate([[0], np.searchsorted(start, ends)]).astype(np.int64)
    parts, counts = [], []
    for r in raws:
        own = [_hash_bytes(p)[1] for p in _pieces(r)] if r else []
        parts += own
        counts.append(sum(map(len, own)))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within each text, and the text of each.  A
    text of fewer words, but not none, is one shingle."""
    n = np.diff(offsets)
    text = np.repeat(np.arange(len(n)), n)
    total = len(words)
    if not total:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    acc = np.zeros(total, dtype=np.uint64)
    left = offsets[1:][text] - np.arange(total)  # words from here to the text's end
    with np.errstate(over="ignore"):
        factor = 1
        for j in range(min(k, total)):
            factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
            step = words * np.uint64(factor)
            acc[:total - j] += np.where(left[:total - j] > j, step[j:], np.uint64(0))
        acc = mix(acc + np.minimum(left, k).astype(np.uint64))
    first = np.arange(total) == offsets[:-1][text]
    keep = (left >= k) | (first & (left < k))
    return acc[keep], text[keep]


#: Byte table: A-Z to a-z, separators to a blank, every other byte to itself.
_WORD_OR_BLANK = bytes(int(_LOWER[b]) if _WORD[_LOWER[b]] else 32 for b in range(256))


def split_words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order, as lists for pieces of about ``PIECE``
    bytes (UTF-8, A-Z in lower case); a null text has none."""
    for piece in _pieces((text or "").encode("utf-8", "surrogatepass")):
        yield piece.translate(_WORD_OR_BLANK).split()
