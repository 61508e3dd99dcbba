"""Plain Python statements of the contracts, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOW = str.maketrans(UPPER, UPPER.lower())
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall((text or "").translate(LOW))


def contamination(texts, items):
    """(n_words, n_hit, n_items, sha) of each text."""
    grams = collections.defaultdict(set)
    for item_id, text in items:
        w = words(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            grams[tuple(w[i:i + k])].add(item_id)
    out = []
    for t in texts:
        w, hit, ids = words(t), set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                if (g := tuple(w[i:i + k])) in grams:
                    hit.update(range(i, i + k))
                    ids |= {str(x) for x in grams[g] if x is not None}
        out.append((len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()))
    return out


def near_classes(rows, similarity=0.8, k=5):
    """Class id of each (id, text) by comparing every pair that shares a shingle."""
    bags, index = [], collections.defaultdict(list)
    for i, (_, t) in enumerate(rows):
        w = words(t)
        bags.append(collections.Counter(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else collections.Counter())
        for s in bags[-1]:
            index[s].append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    size = [sum(b.values()) for b in bags]
    for i, b in enumerate(bags):
        shared = collections.Counter()
        for s, n in b.items():
            for j in index[s]:
                if j < i:
                    shared[j] += min(n, bags[j][s])
        for j, n in shared.items():
            if n >= similarity * (size[i] + size[j] - n):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(rows))]


PATTERNS = {
    "assign": re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def secrets(text):
    """(counts, base spans) of a text."""
    text, found, n = text or "", [], collections.Counter()
    for rank, (kind, p) in enumerate(PATTERNS.items()):
        for m in p.finditer(text):
            if (len(m.group(2)) >= 6) if kind == "assign" else (len(m.group()) >= (20 if kind == "access" else 24)):
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
                n[kind] += 1
    return n, [s for *_, s in sorted(found)]
