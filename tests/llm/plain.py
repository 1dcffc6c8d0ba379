"""Brute-force versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(words, n):
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []


def simhash(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups(nodes, linked):
    """Node -> representative, for links that linked(a, b) says."""
    nodes = list(nodes)
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def quality_counts(text):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def benchmark_hits(docs, items, least=0.8):
    import regex

    word = regex.compile(r"[\p{L}\p{N}]+")

    def five(text):
        w = word.findall((text or "").lower())
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    bags = {i: Counter(s) for i, t in items.items() if (s := five(t))}
    where = defaultdict(set)
    for i, bag in bags.items():
        for s in bag:
            where[s].add(i)
    found = {}
    for d, text in docs.items():
        s = five(text)
        for i in set().union(*[where[x] for x in s if x in where]):
            m, best = bags[i].total(), None
            for a in range(len(s) - m + 1):
                common = (Counter(s[a : a + m]) & bags[i]).total()
                if common / (2 * m - common) >= least and (best is None or common / (2 * m - common) > best[0]):
                    best = (common / (2 * m - common), a)
            if best:
                found[d, i] = best
    return found
