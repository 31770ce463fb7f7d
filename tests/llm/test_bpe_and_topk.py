import random

import numpy as np
import public_tokenizers
import pytest
from cases import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm import bpe, topk

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def test_words_against_the_library(library, vocabulary, folder, spark):
    r = random.Random(1)
    texts = [x["text"] for x in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    texts += ["", "  ", "\x1c a\x1db", "İstanbul ΟΔΟΣ é É", "a<|endoftext|>B<|startoftext|> <|ENDOFTEXT|>"]
    texts += ["</w> x</w>", "I'LL they've 123 ½ ² \x00 \x01", "ǅ ß ẞ ﬁ 한국어 日本 \U0001f600", "\x85a\xa0b​c", "a" * 5000, "ab" * 3000]
    plain, wide = "abcdefghijklmnopqrstuvwxyzéüß'0123456789!?.-_ \n\t", "aé'̧́  ΣßİЖ中🙂ﬀ"
    texts += ["".join(r.choice(plain) for _ in range(r.randint(1, 60))) for _ in range(1500)]
    texts += ["".join(r.choice(wide) for _ in range(r.randint(1, 30))) for _ in range(800)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [i.tolist() for i in vocabulary.encode_texts(texts)] == want
    assert vocabulary.failed > 0  # the slow way was needed, and not for all
    decoded = [" ".join(vocabulary.tokens[i] for i in ids) for ids in want]
    assert decoded == [library.decode(ids, skip_special_tokens=False) for ids in want]


def test_verification_finds_every_wrong_proposal(vocabulary):
    r = random.Random(2)
    words = ["".join(r.choice("abeinorst") for _ in range(r.randint(1, 12))) for _ in range(5000)] + ["a" * 64, "ab" * 32, "ab" * 40]
    one_by_one = [vocabulary._merged_long([*(vocabulary.ids[c] for c in w[:-1]), vocabulary.ids[w[-1] + "</w>"]]) for w in words]
    assert vocabulary.encode_words(words) == vocabulary.merged(words) == one_by_one


def test_memory_keeps_what_was_met_lately():
    memory = bpe.Memory(8, {"always": b"x"})
    for k in range(20):
        assert memory.unknown({f"k{k}", "hot", "always"}) <= {f"k{k}", "hot"}
        memory.young.update({f"k{k}": b"", "hot": b""})
        assert memory.unknown({"hot", f"k{k}"}) == set() and len(memory.young) + len(memory.old) <= 12


def test_long_texts_are_cut_at_white_space(vocabulary, monkeypatch, library):
    monkeypatch.setattr(bpe, "PIECE", 50)
    text = " ".join(f"word{i}" for i in range(300)) + " " * 200 + "x" * 300 + "\x1cend"
    assert [x for part in bpe.chunks_of(text) for x in bpe.pieces_of(part)] == bpe.SPACE.split(text)
    assert vocabulary.encode_texts([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_awkward_documents(spark, library):
    docs = documents(spark)
    encoded = bpe.encode(docs, PATH)
    assert encoded.columns == [c for c in docs.columns if c not in ("text", "ids")] + ["ids"]
    rows = bpe.decode(bpe.encode(docs.select("doc_id", "text", F.col("text").alias("own")), PATH).withColumn("kept_ids", F.col("ids")), PATH).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = library.encode(r["own"] or "", add_special_tokens=False).ids
        assert r["kept_ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).count() == 0
    both = bpe.encode(docs.withColumn("decoded", F.lit("clash")), PATH, decoded=True)
    alone = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert sorted(r["decoded"] for r in both.collect()) == sorted(r["decoded"] for r in alone.collect())
    assert both.columns[-2:] == ["ids", "decoded"] and both.columns.count("decoded") == 1


def brute(vectors, k, scale):
    ok = [(i, np.floor(scale * np.array(v, float))) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        if i % 50 == 0 and (i not in queries or tuple(v) < tuple(queries[i])):
            queries[i] = v
    out = set()
    for q, w in queries.items():
        scored = []
        for i, v in ok:
            n = min(len(v), len(w))
            if i != q:
                scored.append((-int(v[:n] @ w[:n]), i))
        out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k])}
    return out


@pytest.mark.parametrize("block", [3, 10_000])
def test_top_k_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=12).round(2).tolist()) for i in range(900)]
    vectors += [(1000 + i, vectors[50][1]) for i in range(40)]  # ties
    vectors += [(50, vectors[50][1]), (100, vectors[3][1]), (None, vectors[0][1]), (150, None), (2001, []), (2002, [1.0])]
    vectors += [(2003, [None] * 12), (2004, [float("nan")] * 12), (2050, [float("inf")] + [0.0] * 11), (2100, [0.0] * 12)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS rank", "'v' AS v")
    vectors = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = topk.top_k(df.repartition(5), F.col("vec_id") % 50 == 0)
    assert {tuple(r) for r in found.collect()} == brute(vectors, 5, 256.0)


def test_max_score_looks_at_fewer_postings():
    rng = np.random.default_rng(5)
    queries = np.floor(256 * rng.normal(size=(20, 64)) * (0.8 ** np.arange(64)))
    ids = np.arange(100, 8292)
    shard = np.floor(256 * rng.normal(size=(len(ids), 64)) * (0.8 ** np.arange(64)))
    best = topk.Best(20, 5)
    first = topk.search_shard(best, np.arange(20), queries, ids[:4096], shard[:4096])
    second = topk.search_shard(best, np.arange(20), queries, ids[4096:], shard[4096:])
    assert second < 0.7 * first
    scores = queries @ shard.T
    for q in range(20):
        order = np.lexsort((ids, -scores[q]))[:5]
        assert best.ids[q].tolist() == ids[order].tolist() and best.scores[q].tolist() == scores[q][order].tolist()


def test_few_vectors_and_none(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [1e6])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(few, F.col("vec_id") % 50 == 0).orderBy("rank").collect()] == [(0, 1, 2, 65536000000), (0, 2, 1, 32768)]
    assert topk.top_k(few.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(few, F.col("vec_id") > 5).count() == 0


def test_scores_beyond_doubles_are_exact(spark):
    big = float(2**22)
    rows = [(0, [big] * 64), (1, [big] * 63 + [big + 1 / 256]), (2, [big] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["score"] for r in topk.top_k(df, F.col("vec_id") == 0).collect()}
    assert found == {1: 64 * 2**60 % 2**64 + 2**30 - (2**64 if 64 * 2**60 % 2**64 >= 2**63 else 0), 2: 0}
