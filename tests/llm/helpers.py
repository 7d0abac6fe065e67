"""Small tables and brute-force versions for the tests of this folder."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_frame(spark, rows):
    """``rows`` of (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k):
    w = words(lower(text))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def linked_components(rows, k, percent=80):
    """doc_id -> smallest reachable id, by comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {i: find(i) for i in parent}


def repeat_words(w):
    count = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    return len({j for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)})


def by_id(rows, key="doc_id"):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out
