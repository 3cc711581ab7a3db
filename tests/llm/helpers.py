"""Small tables with the awkward cases, and plain versions of the operators."""

from __future__ import annotations

import re
from itertools import combinations

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, **fixed):
    """Documents numbered from zero; ``fixed`` replaces other columns."""
    rows = [
        (i, t, fixed.get("lang", "en"), fixed.get("source", f"src{i % 3}"), len(t or ""))
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def words(text):
    return WORD.findall(text or "")


def shingles(text, size=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = words(lowered)
    if not found:
        return set()
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def components(ids, links):
    """The smallest id that each id is connected with."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {i: root(i) for i in ids}


def similar_pairs(sets):
    """Pairs of ids whose sets have a Jaccard similarity of 0.8 or more."""
    return [
        (a, b)
        for (a, x), (b, y) in combinations(sets.items(), 2)
        if x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
