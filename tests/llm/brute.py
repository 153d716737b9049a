"""Plain-Python versions of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import defaultdict

LOW = {i: i + 32 for i in range(65, 91)}


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def shingles(text, k):
    w = spaced(text)
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def forest(n):
    return list(range(n))


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def union(parent, a, b):
    a, b = sorted((find(parent, a), find(parent, b)))
    parent[b] = a


def near_groups(texts, k, num, den):
    """Component number of every text."""
    sets = [shingles(t, k) for t in texts]
    index = defaultdict(list)
    parent = forest(len(texts))
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in index[g]:
                shared[j] += 1
            index[g].append(i)
        for j, n in shared.items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                union(parent, i, j)
    return sets, [find(parent, i) for i in range(len(texts))]


def contamination(texts, items):
    """(words, hit words, sorted item ids) of every text; items: (id, text)."""
    windows = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[i:i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w, hit, ids = alnum(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                found = windows.get(tuple(w[i:i + size]))
                if found:
                    ids |= found
                    hit.update(range(i, i + size))
        out.append((len(w), len(hit), sorted(ids)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
