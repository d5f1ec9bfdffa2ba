"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


class Union:
    def __init__(self, n):
        self.parent = list(range(n))

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        self.parent[self.find(a)] = self.find(b)


def shingles(text, n=5):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def jaccard_components(rows):
    """[(doc_id, n_shingles, component_id)] of [(doc_id, text)]; ids may be None (last)."""
    sets = [shingles(t) for _, t in rows]
    u = Union(len(rows))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                u.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = u.find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), least.get(u.find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def remove_repeats(rows, window=50):
    """[(doc_id, n_words, n_removed, kept_sha256)]; null ids are larger than any."""
    rank = lambda d: (1 << 63) - 1 if d is None else d
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, rank(d)), rank(d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < rank(d):
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def base_rules(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    covered = set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered.update((i, i + 1, i + 2))
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), failed)


def connected(edges):
    """node -> least node of its component."""
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for start in sorted(near):
        if start in out:
            continue
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = start
                todo += near[x]
    return out
