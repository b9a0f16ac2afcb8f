"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    t = text or ""
    return WORD.findall(t.translate(LOWER) if lower else t)


def repeats(docs, window=50):
    """doc_id -> (n_words, n_removed, digest) for rows of unique ids."""
    first: dict[tuple, int] = {}
    toks = {i: words(t) for i, t in docs}
    for i, w in toks.items():
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in toks.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def shingles(text, k):
    w = words(text, True)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(docs, k, percent):
    sets = {i: shingles(t, k) for i, t in docs}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if not small or 100 * small < percent * large:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    comp = components(ids, links)
    return {i: (len(sets[i]), comp[i]) for i in ids}


def fold(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m
