"""The conversation trie, line dedup and the filter audit against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import documents
from pyspark.sql import functions as F

from tabloom.llm import audit, linededup, trie
from tabloom.llm.cuckoo import CuckooFilter
from tabloom.llm.parentheses import Parentheses

SPACE = "[^\x20\x09-\x0d]+"


# ---- balanced parentheses ----------------------------------------------------------
@pytest.mark.parametrize("down", [0.2, 0.5, 0.7, 0.95])
def test_find_close_on_random_trees(down):
    rng = random.Random(down)
    bits, level = [1], 1
    while len(bits) < 3000:
        step = 1 if level == 1 or rng.random() < down else 0
        level += 1 if step else -1
        bits.append(step)
    bits += [0] * level
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    tree = Parentheses(np.array(bits))
    assert tree.find_close(tree.opens).tolist() == [want[k] for k in sorted(want)]


def test_a_parenthesis_that_stays_open_is_an_error():
    with pytest.raises(ValueError):
        Parentheses(np.array([1, 1, 0])).find_close(np.array([0]))


# ---- trie --------------------------------------------------------------------------
def turn_digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute_paths(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, turn_digest(role, text), (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return paths


def brute_nodes(paths):
    members = defaultdict(set)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].add(c)
    out = set()
    for p, who in members.items():
        below = [q for q in members if q[: len(p)] == p]
        inner = {q[:-1] for q in members if q}
        saved = sum((len(members[q]) - 1) * len(re.findall(SPACE, q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(p))
        out.add((
            min(who), len(p), min(members[p[:-1]]) if p else None, len(who), sum(len(q) == len(p) + 1 for q in below),
            sum(q not in inner for q in below), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def conversations(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "1 AS shard", "2 AS words", "'x' AS path", "'y' AS digest", "3 AS h", "4 AS base")


def random_conversations(seed, n, kinds):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.randint(1, 6)):
            text = rng.choice(["one two", "three", "", None, "a b c d"][:kinds]) if t < 4 else f"own {rng.randint(0, 3)}"
            rows.append((c, t, rng.choice(["user", "user", None]), text))
    return rows


@pytest.mark.parametrize("n, kinds", [(120, 2), (60, 5), (3, 5)])
def test_nodes_against_brute_force(spark, n, kinds):
    rows = random_conversations(n, n, kinds)
    got = trie.nodes(trie.rebuilt_paths(trie.turn_lists(conversations(spark, rows)))).collect()
    want = brute_nodes(brute_paths(rows))
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_awkward_conversations(spark):
    """No conv_id, ties, repeated rows, missing turns, turnless conversations, very many equal ones, a long one."""
    rows = [(c, t, "user", f"turn {t}") for c in range(100, 180) for t in range(5)]  # equal but for their heads
    rows += [(None, 0, "user", "nobody's")] * 5
    rows += [(7, None, "user", "first"), (7, 1, "user", "b"), (7, 1, "user", "a"), (7, 1, "user", "a"), (7, None, None, None)]
    rows += [(c, 0, None, None) for c in range(21, 40)]  # their base is absent: some have no turns left
    rows += [(-5, 0, "user", "below zero"), (-5, 1, "user", "again"), (500, 0, "user", "word " * 50_000)]
    rows += [(501, t, "user", str(t)) for t in range(300)]
    paths = brute_paths(rows)
    assert any(not p for p in paths.values())
    got = trie.nodes(trie.rebuilt_paths(trie.turn_lists(conversations(spark, rows))), turns_per_shard=40).collect()
    assert {tuple(r) for r in got} == brute_nodes(paths) and len(got) == len(brute_nodes(paths))


def test_no_conversations(spark):
    assert trie.nodes(trie.rebuilt_paths(trie.turn_lists(conversations(spark, [])))).count() == 0


def test_encoded_shards_are_balanced_and_hold_every_node(spark):
    rows = random_conversations(5, 80, 3)
    paths = trie.plain_paths(trie.turn_lists(conversations(spark, rows)))
    for r in trie.encoded(paths).collect():
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8))[: 2 * r["nodes"]].astype(int)
        level = np.cumsum(2 * bits - 1)
        assert bits.sum() == r["nodes"] and level[-1] == 0 and (level[:-1] > 0).all()


# ---- cuckoo filter and line index --------------------------------------------------
def test_cuckoo_filter_finds_all_and_forgets_all():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    filter_ = CuckooFilter.for_keys(2_000)  # too small by far: further segments are made
    filter_.insert(keys)
    assert filter_.contains(keys).all() and len(filter_.segments) > 1
    other = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert filter_.contains(other).mean() < 0.01
    again = CuckooFilter.from_bytes(filter_.to_bytes(), filter_.buckets)
    assert again.remove(keys[:12_000]) == 0
    assert again.contains(keys[12_000:]).all() and again.contains(keys[:12_000]).mean() < 0.01
    assert again.remove(keys[12_000:]) == 0
    assert not any(s.any() for s in again.segments)


def test_cuckoo_filter_with_equal_fingerprints():
    keys = np.full(30, 12345, np.uint64)
    filter_ = CuckooFilter.for_keys(100)
    filter_.insert(keys)
    assert filter_.remove(keys[:29]) == 0 and filter_.contains(keys[:1]).all()
    assert filter_.remove(keys[:1]) == 0 and not filter_.contains(keys[:1]).any()
    assert filter_.remove(keys[:1]) == 1


def brute_lines(rows, held=None):
    """(doc_id, kept text, lines, dropped) of each row, by the lines of `held`."""
    key = lambda line: linededup.line_key(line.encode()).decode()
    holders = defaultdict(set)
    for d, text in held if held is not None else rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(d)
    out = []
    for d, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            ids = [h for h in holders[key(line)] if h is not None]
            if not (len(key(line)) >= 10 and d in holders[key(line)] and ids and (d is None or d > min(ids))):
                kept.append(line)
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def line_documents(seed, n):
    rng = random.Random(seed)
    pool = [f"Line number {k} of many" for k in range(12)] + ["short", "", "  PADDED line of words\t", "padded LINE of words", "é" * 9, "é" * 10]
    return [(k, "\n".join(rng.choices(pool, k=rng.randint(0, 9)) + [f"a line of document {k}"])) for k in range(n)]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def result(index, df):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in index.dedup(df).collect()), key=repr)


def test_lines_stay_right_through_insertions_and_deletions(spark, tmp_path):
    rows = line_documents(3, 60)
    index = linededup.LineIndex(spark, str(tmp_path / "lines"), shards=4)
    for part in (rows[40:], rows[:10], rows[10:40]):
        index.insert(table(spark, part))
    assert result(index, table(spark, rows)) == brute_lines(rows)
    version = index.save()
    before = sorted(map(tuple, index.counts().collect()))
    gone = [(k,) for k in range(0, 60, 3)] + [(None,), (999,)]
    index.delete(spark.createDataFrame(gone, "doc_id long"))
    rest = [r for r in rows if r[0] % 3]
    assert result(index, table(spark, rest)) == brute_lines(rest)
    index.insert(table(spark, [r for r in rows if r[0] % 3 == 0]))  # deleted and inserted again: as before
    assert sorted(map(tuple, index.counts().collect())) == before
    assert result(index, table(spark, rows)) == brute_lines(rows)
    old = linededup.LineIndex.load(spark, str(tmp_path / "lines"), version)
    assert result(old, table(spark, rows)) == brute_lines(rows)
    index.delete(table(spark, rows))
    assert index.counts().where("refs <> 0").isEmpty()
    assert all(not any(r["blob"]) for r in index.filters().collect())  # every fingerprint is gone
    assert result(index, table(spark, rows)) == brute_lines(rows, [])


def test_filters_know_every_counted_key(spark, tmp_path):
    index = linededup.LineIndex(spark, str(tmp_path / "lines"), shards=3)
    index.insert(table(spark, line_documents(4, 20)))
    index.insert(table(spark, line_documents(5, 30)))
    filters = {r["shard"]: CuckooFilter.from_bytes(r["blob"], r["buckets"]) for r in index.filters().collect()}
    for r in index.counts().collect():
        assert filters[r["k1"] % 3].contains(np.array([r["k1"]]).view(np.uint64)).all() and r["refs"] > 0


def test_awkward_lines(spark, tmp_path):
    docs = documents(spark).withColumns({"n_lines": F.lit("x"), "gone": F.lit(1), "tag": F.lit(2), "k1": F.lit(3)})
    index = linededup.LineIndex(spark, str(tmp_path / "lines"))
    index.insert(docs)
    clean = index.dedup(docs)
    assert clean.columns == [*[c for c in docs.columns if c != "n_lines"], "n_lines", "n_dropped"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in clean.collect()), key=repr)
    assert got == brute_lines(rows)
    none = linededup.LineIndex(spark, str(tmp_path / "none"))
    none.insert(docs.limit(0))
    assert none.dedup(docs.limit(0)).count() == 0 and none.dedup(docs).where("n_dropped > 0").isEmpty()


# ---- filter audit ------------------------------------------------------------------
TEXTS = [
    "", " ", "a", "A b a", " lead and trail ", "É É é", "日本 語 日本", "x#y 50% a&b", "\t\n\x0b\x0c\r", "tab\tand no-break",
    "w" * 300 + " " + "w" * 300 + " " + "w" * 299 + "v", "one two " * 500, "😀 😀 ok", "\x1c\x85  ", "aaaaaaaa aaaaaaaab aaaaaaaa",
]


def brute_measures(text):
    words = re.findall(SPACE, text)
    return (len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)))


@pytest.mark.parametrize("window", [1, 3, 7, 64, 1 << 20])
def test_measures_whatever_the_window(monkeypatch, window):
    monkeypatch.setattr(audit, "WINDOW", window)
    found = audit.measures(pa.array(TEXTS), audit.byte_classes())
    assert list(zip(*(x.tolist() for x in found), strict=True)) == [brute_measures(t) for t in TEXTS]


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(audit, "mix", lambda x: x * audit.U64(0) + audit.U64(5))  # every word has the same hash
    words = [f"{k}" for k in range(150)] + ["long" * 100 + str(k % 3) for k in range(9)]
    text = " ".join(words * 2)
    found = audit.measures(pa.array([text, text[5:]]), audit.byte_classes())
    assert [x.tolist() for x in found][1] == [brute_measures(text)[1], brute_measures(text[5:])[1]]


def test_measure_keeps_columns_and_rows(spark):
    docs = documents(spark).withColumn("words", F.lit("clash"))
    got = audit.measure(docs)
    assert got.columns == [*[c for c in docs.columns if c not in ("text", "words")], *audit.MEASURES]
    want = sorted((r["doc_id"], *brute_measures(r["text"] or "")) for r in docs.where("doc_id is not null").collect())
    assert sorted(tuple(r) for r in got.where("doc_id is not null").select("doc_id", *audit.MEASURES).collect()) == want
    assert audit.measure(docs.limit(0)).count() == 0


def brute_audit(rows, labels):
    smallest = {}
    for d, t, _ in rows:
        if d is not None:
            smallest[t or ""] = min(d, smallest.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    parts = defaultdict(list)
    for d, t, s in rows:
        words, distinct, capitals, points, symbols = brute_measures(t or "")
        fails = {
            "A": words < 200, "B": 100 * distinct < 50 * words, "C": 100 * capitals > 2 * points, "D": symbols > 0,
            "E": d is not None and smallest[t or ""] < d,
        }
        parts[s or ""].append(({k for k, v in fails.items() if v}, d in good, d in toxic))
    out, shares = [], defaultdict(int)
    for part, docs in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, 1):
                here = [x for x in left if letter in x[0]]
                left = [x for x in left if letter not in x[0]]
                failing = sum(letter in x[0] for x in docs)
                shares[part, letter] += len(here)
                out.append([part, "".join(order), step, len(left), len(here), failing - len(here),
                            sum(x[0] == {letter} for x in docs), sum(x[1] for x in here), sum(x[2] for x in here)])
    return sorted((*r, shares[r[0], r[1][r[2] - 1]]) for r in out)


def test_audit_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(TEXTS + ["Word $ " * 150, "many words here " * 100, None]), rng.choice(["a", "b", "", None])) for k in range(150)]
    rows += [(None, "", "a"), (None, "a", "c"), (3, "", "a"), (3, "", "a")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 150, 2)] + [(4, 1, 1), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.selectExpr("*", "1 AS part", "2 AS sha", "3 AS mask", "4 AS first", "5 AS n", "true AS repeats")
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, audit.audit(docs, said).collect())) == brute_audit(rows, labels)
    assert audit.audit(docs.limit(0), said).count() == 0
    assert audit.audit(docs, said.limit(0)).where("good_lost + toxic_lost > 0").isEmpty()


def test_other_filters_and_parts(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "a", "s"), (3, "", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    filters = [audit.Filter("x", F.col("words") < 2), audit.Filter("y", F.col("words") < 1)]
    rows = {(r["filter_order"], r["step"]): r for r in audit.audit(docs, labels, filters).collect()}
    assert len(rows) == 4 and rows["xy", 1]["removed"] == 2 and rows["xy", 2]["redundant"] == 1
    assert rows["yx", 2]["shapley"] == 3 and rows["yx", 1]["shapley"] == 1
