import random
import zlib

import pyarrow as pa
import pytest
from cases import documents, near_components, shingles, words
from pyspark.sql import functions as F

from tabloom.llm import neardup, quality
from tabloom.llm.textbytes import Words, shingle_sets


def test_words_of_a_batch():
    texts = ["a b", "", " A  b\tc ", None, "x" * 5000 + " y", "é É\x0bz", "a b"]
    w = Words(pa.array(texts))
    assert w.counts.tolist() == [len(words(t)) for t in texts]
    flat = [x for t in texts for x in words(t)]
    by_hash = {}
    for x, h in zip(flat, w.hashes.tolist(), strict=True):
        assert by_hash.setdefault(x, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


def test_windows_do_not_change_the_words(monkeypatch):
    from tabloom.llm import textbytes

    r = random.Random(1)
    texts = [" ".join("".join(r.choice("abcé") for _ in range(r.randint(1, 30))) for _ in range(r.randint(0, 60))) for _ in range(80)]
    whole = Words(pa.array(texts))
    monkeypatch.setattr(textbytes, "WINDOW", 16)
    cut = Words(pa.array(texts).slice(0))
    assert (whole.hashes == cut.hashes).all() and (whole.text == cut.text).all() and (whole.starts == cut.starts).all()
    part = Words(pa.array(texts).slice(20, 30))
    assert (part.hashes == whole.hashes[(whole.text >= 20) & (whole.text < 50)]).all()


@pytest.mark.parametrize("width", [1, 2, 5])
def test_set_sizes(width):
    texts = ["a b a b a b", "", "a", "a b", "A B", "a b c d e f g", None, "x x x x x x"]
    text, _ = shingle_sets(Words(pa.array(texts)), width)
    assert [int((text == i).sum()) for i in range(len(texts))] == [len(shingles(t, width)) for t in texts]


def test_agreement_is_seldom_missed():
    t = neardup.agreement(64, 80)
    assert 30 <= t <= 40 and neardup.agreement(64, 100) == 64


def corpus(seed=7):
    """Unrelated texts, exact copies, chains of near copies, a hot passage and a large group of near copies."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    fresh = lambda n: [r.choice(vocabulary) for _ in range(n)]
    texts = [fresh(r.randint(3, 120)) for _ in range(250)]
    passage = fresh(60)
    texts += [fresh(r.randint(0, 60)) + passage for _ in range(120)]
    base = fresh(100)
    for _ in range(150):
        t = list(base)
        for _ in range(r.randint(1, 6)):
            t[r.randrange(100)] = r.choice(vocabulary)
        texts.append(t)
    chain = fresh(80)
    for i in range(40):
        chain = list(chain)
        chain[i * 2 % 80] = f"new{i}"
        texts.append(chain)
    texts += [texts[3]] * 30 + [[], ["one"], ["one"], ["two"]]
    r.shuffle(texts)
    return {i: " ".join(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("width", [2, 5])
def test_components_against_all_pairs(spark, width):
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    want, sizes = near_components(texts, width)
    for r in neardup.near_duplicates(docs, words=width).collect():
        assert (r["component_id"], r["n_shingles"]) == (want[r["doc_id"]], sizes[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_pairs_between_components_are_found(spark, monkeypatch):
    """If no link to a pivot counted, the pairs beside the pivots must still give all links."""
    real, calls = neardup._Index.links, []

    def links(self, overlaps):
        calls.append(overlaps)
        return real(self, overlaps).limit(0) if len(calls) == 1 else real(self, overlaps).unionByName(real(self, calls[0]).where("a % 7 = 0"))

    monkeypatch.setattr(neardup._Index, "links", links)
    texts = corpus(8)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want, _ = near_components(texts, 2)
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, words=2).collect()}
    assert found == want and len(calls) == 2


def template(n, shared=150, own=50, seed=5):
    """Documents that are three quarters one template, and a few near copies of some of them."""
    r = random.Random(seed)
    words_ = [f"t{k}" for k in range(shared)]
    every = int(9 * n**0.5)  # so that a pair of words stands in about as many documents whatever their number
    tails = [[f"w{r.randrange(every)}" for _ in range(own)] for _ in range(n)]
    texts = {k: words_ + t for k, t in enumerate(tails)}
    for k in range(0, n, 50):
        texts[n + k] = texts[k][:-3] + ["other", "last", "words"]
    return {k: " ".join(t) for k, t in texts.items()}


def formed(spark, monkeypatch, texts):
    """(pairs that were formed before any set was looked at, component of each document)."""
    counts, real = [], neardup._Index.candidates

    def counted(self, rows):
        out = neardup.written(real(self, rows), "counted")
        counts.append(out.count())
        return out

    monkeypatch.setattr(neardup._Index, "candidates", counted)
    monkeypatch.setattr(neardup, "_common_at_most", lambda name: F.lit(10**9))  # count what the bits would rule out, too
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, words=2).collect()}
    monkeypatch.undo()
    return sum(counts), found


def test_documents_around_one_template_do_not_all_meet(spark, monkeypatch):
    few, many = template(500), template(2000)
    (a, found), (b, _) = (formed(spark, monkeypatch, t) for t in (few, many))
    want = near_components(few, 2)[0]
    assert found == want
    docs = spark.createDataFrame(list(few.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, words=2).collect()} == want
    # not the square (125 000 and 2 million): four times the documents, about four times the pairs
    assert 0 < a < 20 * len(few) and b < 6 * a


def test_awkward_documents(spark):
    docs = documents(spark)
    rows = neardup.near_duplicates(docs, words=2).collect()
    assert len(rows) == docs.count()
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert {r["component_id"] for r in rows if r["doc_id"] in (6, 7)} == {6}
    alone = [3, 4, 5, 8, 9, 10]
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in rows if r["doc_id"] in alone)
    kept = neardup.keep_one(docs, words=2)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 1, 3, 4, 5, 6, 8, 9, 10]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0 and neardup.keep_one(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    r = random.Random(3)
    order = list(range(60))
    r.shuffle(order)
    links = list(zip(order, order[1:], strict=False)) + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 200), (300, 300)]
    found = {x["doc"]: x["component"] for x in neardup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {d: 0 for d in range(60)} | {d: 100 for d in range(100, 150)} | {200: 200, 201: 200}
    assert found == want


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    ranker = quality.fit(docs, labels)
    found = {r["doc_id"]: r for r in quality.classify(docs.select("doc_id", "text"), ranker).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    tested = [r for r in labels.collect() if held_out(r["doc_id"])]
    assert len(tested) > 50
    assert sum(found[r["doc_id"]]["predicted"] == r["quality"] for r in tested) >= 0.97 * len(tested)


def test_labels_that_are_held_out_are_not_learned(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None), (5, 0), (5, 1)], "doc_id long, quality int")
    ids = {r["doc_id"] for r in quality.training_rows(docs, labels).collect()}
    assert ids == {i for i in range(60) if not held_out(i)} - {5}


def test_awkward_documents_and_labels(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 11)], "doc_id long, quality int")
    ranker = quality.fit(docs, labels)
    rows = quality.classify(docs, ranker)
    assert rows.count() == docs.count() and rows.where("score between 0 and 1").count() == docs.count()
    assert quality.classify(docs.limit(0), ranker).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert {r["score"] for r in quality.classify(docs, quality.fit(docs, none)).collect()} == {0.5}


def test_every_labelled_document_is_read_and_paired(spark):
    docs = spark.range(30_000).selectExpr("id as doc_id", "concat('w', id) as text")
    labels = spark.range(30_000).selectExpr("id as doc_id", "cast(id % 3 = 0 as int) as quality")
    rows = quality.training_rows(docs, labels.where(~quality.is_held_out()))
    want = labels.where(~quality.is_held_out()).count()
    assert rows.count() == want > 19_000
    more = spark.range(24_000).selectExpr("id as doc_id", "cast(id % 4 = 0 as int) as quality", "array(cast(id as double)) as f")
    met = quality.preference_pairs(more.unionByName(more.selectExpr("doc_id + 24000", "quality", "array(f[0] + 24000)").toDF(*more.columns)), 1)
    assert met.count() == 36_000  # each of the larger side once
    whole = sum(i if i % 4 == 0 else 0 for i in range(48_000)) * 3 - sum(i for i in range(48_000) if i % 4)
    assert met.selectExpr("sum(f[0])").first()[0] == whole  # and each of the smaller side three times


def test_no_text_is_shuffled_and_measured_rows_give_the_same_scores(spark, monkeypatch):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 11)], "doc_id long, quality int")
    plans = []
    keep = quality.written

    def seen(df, label="table"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    monkeypatch.setattr(quality, "written", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = quality.measured(docs)
        ranker = quality.fit(docs, labels)
        assert quality.fit(rows, labels) == ranker
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plans and not any("text" in line for p in plans for line in p.splitlines() if "Exchange" in line)
    assert not any("Exchange" in p and "MapInArrow" in p for p in plans)
    whole, short = quality.classify(docs, ranker), quality.classify_measured(rows, ranker)
    columns = ["doc_id", "score", "predicted"]
    assert sorted(map(str, whole.select(columns).collect())) == sorted(map(str, short.select(columns).collect()))


def test_tables_go_when_nothing_reads_them_any_more(spark):
    import os

    from tabloom import session

    root = os.path.dirname(session.scratch_path(spark, "x").removeprefix("file:"))
    before = set(os.listdir(root))
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = neardup.near_duplicates(docs, words=2)
    left = {f.split("-")[0] for f in set(os.listdir(root)) - before}
    want, _ = near_components(texts, 2)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == want
    assert left == {"sized", "moved"}  # what the result is read from
