"""Brute-force counterparts that several tests share."""

from collections import defaultdict


def size(text):
    return len((text or "").encode().split())


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def near_components(rows, k, percent):
    """Sets of rows reachable from each other by pairs of sets at or above the threshold; every pair is tested."""
    by_set = defaultdict(set)
    for row in rows:
        by_set[shingle_set(row[1], k)].add(row)
    by_set.pop(frozenset(), None)
    kinds = list(by_set)
    parent = {s: s for s in kinds}

    def root(s):
        while parent[s] != s:
            s = parent[s]
        return s

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if len(a & b) * 100 >= percent * len(a | b):
                parent[root(a)] = root(b)
    out = defaultdict(set)
    for s in kinds:
        out[root(s)] |= by_set[s]
    return list(out.values())
