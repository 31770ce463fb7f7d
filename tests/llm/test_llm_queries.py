"""Every query of the operators on the smallest tables: against its SQL, or against brute force."""

import hashlib
import math
from collections import Counter

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from cases import near_components
from check_queries import rows_of
from tokenizers import Tokenizer

from tabloom.llm import mixing, queries, sharding, warc
from tabloom.plans.registry import TABLES


@pytest.fixture(scope="module")
def con(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, folder, con, name):
    df = queries.QUERIES[name](spark, folder)
    result = con.execute(queries.ORACLES[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_tokens(spark, folder, texts, library):
    for r in queries.op3(spark, folder).collect():
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digests(library, texts[r["doc_id"]])


def test_links(spark, folder, texts):
    want, sizes = near_components(texts, 2)
    for r in queries.op6(spark, folder).collect():
        assert (r["component_id"], r["n_shingles"]) == (want[r["doc_id"]], sizes[r["doc_id"]])


def test_shards(spark, folder, texts):
    rows = queries.op5(spark, folder).collect()
    loads, places = Counter(), {}
    for r in rows:
        loads[r["shard"]] += r["size"]
        places.setdefault(r["shard"], []).append(r["slot"])
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["law"] == "bytes"
    assert len(rows) == len(texts) and set(places) <= set(range(16))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards_after_an_edit_of_the_map(spark, folder, texts):
    rows = queries.op5(spark, folder).collect()
    assert {(r["version"], r["edited_version"]) for r in rows} == {(1, 2)} and len(rows) == len(texts)
    weight, first, places = Counter(), {}, {}
    for r in rows:
        weight[r["virtual_slot"]] += r["size"]
        assert first.setdefault(r["virtual_slot"], r["shard"]) == r["shard"]
        places.setdefault(r["edited_shard"], []).append(r["edited_slot"])
    sizes = spark.createDataFrame(list(weight.items()), "virtual_slot int, bytes long")
    want = sharding.edit_map([first.get(k, 0) for k in range(sharding.SLOTS)], sizes, 17)
    assert all(r["edited_shard"] == want[r["virtual_slot"]] for r in rows) and set(places) == set(range(17))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    moved = sum(r["size"] for r in rows if r["edited_shard"] != r["shard"])
    assert 0 < moved < sum(weight.values()) / 4  # dealing all slots anew moves nearly everything


def test_rebuilt_records(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    kinds = {r["page_id"]: r for r in queries.op9(spark, folder).collect()}
    rows = queries.op9_records(spark, folder).collect()
    assert len(rows) == len(pages) == len({r["page_id"] for r in rows})
    got = {r["page_id"]: r for r in rows}
    for page in pages:
        body, kind, r = (page["html"] or "").encode(), kinds[page["page_id"]], got[page["page_id"]]
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(body)
        block = http + (b"" if kind["record_type"] == "revisit" else body)
        lines = ["WARC/1.0", f"WARC-Type: {kind['record_type']}", f"WARC-Record-ID: <urn:page:{page['page_id']}>", "WARC-Date: 2024-01-01T00:00:00Z"]
        lines += [f"WARC-Target-URI: {page['url']}"] if page["url"] is not None else []
        lines += [f"WARC-Payload-Digest: sha1:{hashlib.sha1(body).hexdigest()}"]
        if kind["record_type"] == "revisit":
            lines += [f"WARC-Refers-To: <urn:page:{kind['refers_to']}>", f"WARC-Profile: {warc.PROFILE}"]
        lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
        record = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
        assert r["lengths_agree"] and r["content_length"] == len(block)
        assert (r["record_bytes"], r["record_sha256"]) == (len(record), hashlib.sha256(record).hexdigest())


def test_a_wrong_length_is_found(spark):
    head = "WARC/1.0\r\nWARC-Type: {}\r\nWARC-Target-URI: é\r\nContent-Length: {}\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: {}\r\n\r\n"
    cases = [("response", 41, 3, True), ("response", 42, 3, False), ("response", 41, 4, False), ("revisit", 38, 3, True), ("revisit", 41, 3, False)]
    for kind, own, inner, want in cases:
        archive = spark.createDataFrame([(head.format(kind, own, inner).encode(), b"abc")], "header binary, payload binary")
        assert warc.rebuilt(archive).first()["lengths_agree"] == want


def test_pseudonyms(spark, folder, texts):
    rows = queries.op1(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        before = texts[r["doc_id"]]
        assert (r["text"] == before) == (not r["pii"])
        for s in r["pii"]:
            assert before[s["start"] : s["end"]] not in r["text"]


def test_pipeline_against_brute_force(spark, folder, texts, library):
    docs = queries.table(spark, folder, "documents")
    good = corpus_pipeline.good_quality(spark, docs, folder)
    assert good.columns == docs.columns
    bad = {r["doc_id"] for r in queries.table(spark, folder, "labels").where("quality = 0").collect()}
    kept = {r["doc_id"]: r["text"] for r in good.collect()}
    assert not bad & set(kept) and len(kept) >= len(texts) - 1.5 * len(bad) * len(texts) / queries.table(spark, folder, "labels").count()
    last = {}
    for i, t in sorted(kept.items()):
        last[t] = i
    one = corpus_pipeline.without_copies(spark, good, folder)
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == set(last.values())
    kept = {i: kept[i] for i in last.values()}
    component, _ = near_components(kept, 5)
    near = corpus_pipeline.without_near_copies(spark, one, folder)
    assert near.columns == docs.columns
    assert {r["doc_id"] for r in near.collect()} == {i for i in kept if component[i] == i}
    plan = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(near).collect()}
    mix = corpus_pipeline.mixed(spark, near, folder)
    assert mix.columns == docs.columns
    assert Counter(r["doc_id"] for r in mix.collect()) == Counter({i: n for i, n in plan.items() if n})
    out = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r["doc_id"] for r in out) == Counter({i: n for i, n in plan.items() if n})
    for r in out:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digests(library, texts[r["doc_id"]])
    assert math.isclose(len(out), sum(plan.values()))
