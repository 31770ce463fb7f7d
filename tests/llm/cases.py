"""A small table with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import re
from collections import defaultdict

CLASHING = "size n slot shard kept name sha key block pos left rate target copies score predicted ids pii digest sig rule verdict a b doc comp".split()
LONG = " ".join(f"word{i % 5000}x{i}" for i in range(40_000))


def documents(spark, rows=None):
    """(doc_id, text, lang, source, n_chars) and columns named like the operators' own."""
    if rows is None:
        rows = [
            (1, "one two three four five six seven", "s1"),
            (2, "one two three four five six seven", "s2"),
            (None, "one two three four five six seven", "s1"),
            (1, "one two three four five six seven", "s1"),
            (3, None, "s1"),
            (4, "", None),
            (5, " \n\t ", None),
            (6, LONG, "s3"),
            (7, LONG + " end", "s3"),
            (8, "Ärger É ONE Two", ""),
            (9, "word", "s2"),
            (10, None, None),
            (None, None, None),
        ]
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    table = [(i, t, s, "en", len(t or "")) for i, t, s in rows]
    df = spark.createDataFrame(table, schema)
    return df.selectExpr("*", *[f"'{c}' AS `{c}`" for c in CLASHING])


def words(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(lower))


def shingles(text, width):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def near_components(texts, width, percent=80):
    """doc_id -> smallest doc_id reachable, by comparing all documents that share a shingle."""
    sets = {d: shingles(t, width) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for d, s in sets.items():
        met = set().union(*(holders[x] for x in s)) if s else set()
        for other in met:
            if 100 * len(s & sets[other]) >= percent * len(s | sets[other]):
                a, b = root(d), root(other)
                parent[max(a, b)] = min(a, b)
        for x in s:
            holders[x].add(d)
    return {d: root(d) for d in sets}, {d: len(s) for d, s in sets.items()}
