"""Plain Python counterparts, for small fixtures."""

from __future__ import annotations

import itertools
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text, lower=True):
    raw = (text or "").encode()
    return WORD.findall(raw.lower() if lower else raw)


def shingle_set(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_components(texts: dict, k: int, percent: int) -> dict:
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    holders: dict = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {p for held in holders.values() for p in itertools.combinations(sorted(held), 2)}
    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return components(texts, linked)
