import zlib
from collections import Counter

from cases import documents
from pyspark.sql import functions as F

from tabloom.llm import exact, sharding


def same_groups(rows, texts):
    """Equal (blocks, name) exactly where texts are equal."""
    names = {}
    for r in rows:
        names.setdefault((r["blocks"], r["name"]), set()).add(texts[r["doc_id"]])
    return all(len(t) == 1 for t in names.values()) and len(names) == len(set(texts.values()))


def test_names_are_equal_only_for_equal_texts(spark):
    texts = {i: t for i, t in enumerate(["", "a", "ab", "abcd", "abcde", "abcdabcd", "abcdabcdabcd", "abcdabcdabc", "éé", "a" * 50, "a" * 51, "b" * 50] * 2)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert same_groups(exact.name_documents(docs, block_bytes=4).collect(), texts)


def test_contents_that_share_a_sort_key_keep_names_of_their_own(spark):
    texts = {i: t for i, t in enumerate(["aaaabbbb", "aaaacccc", "bbbbaaaa", "aaaabbbb", "ccccdddd", "aaaa", "bbbb", "bbbb", "aaaabbbbcc", "aaaabbbbcc"])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    few = lambda *c: F.pmod(F.xxhash64(*c), F.lit(2))  # noqa: E731  nearly all contents collide
    assert same_groups(exact.name_documents(docs, block_bytes=4, sort_key=few).collect(), texts)


def test_awkward_rows(spark):
    docs = documents(spark)
    rows = exact.dedup(docs).collect()
    assert len(rows) == docs.count()
    same = [r for r in rows if r["keep_id"] == 2]
    assert [r["group_size"] for r in same] == [4] * 4 and [r["doc_id"] for r in same if r["kept"]] == [2]
    empty = [r for r in rows if r["keep_id"] == 10]
    assert {r["doc_id"] for r in empty} == {3, 4, 10, None} and [r["doc_id"] for r in empty if r["kept"]] == [10]
    assert sum(r["kept"] for r in rows) == len({r["text_sha256"] for r in rows})


def test_one_of_repeated_rows_stays(spark):
    docs = documents(spark, [(1, "x", "s")] * 3 + [(None, "y", "s")] * 2 + [(2, None, None)])
    assert sorted((r["kept"], r["group_size"]) for r in exact.dedup(docs).collect()).count((True, 3)) == 1
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == {(1, "x"): 1, (None, "y"): 1, (2, None): 1}


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert exact.dedup(docs).count() == 0 and exact.keep_one(docs).count() == 0
    sizes = sharding.slot_bytes(docs)
    plan = sharding.first_map(sizes, 4)
    table = spark.createDataFrame([(1, k, s) for k, s in enumerate(plan)], "version int, virtual_slot int, shard int")
    assert sharding.assign(docs, table).count() == 0


def test_shards_are_gapless_and_even(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(documents(spark).select("doc_id", "text"))
    sizes = sharding.slot_bytes(docs)
    sharding.save_map(spark, str(tmp_path), 1, sharding.first_map(sizes, 4))
    rows = sharding.assign(docs, sharding.load_map(spark, str(tmp_path))).collect()
    assert len(rows) == docs.count()
    for shard in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
    biggest = max(r["size"] for r in rows)
    assert max(loads.values()) - min(loads.values()) <= biggest
    by_key = {(r["doc_id"], r["size"]): r["text_crc32"] for r in rows}
    for doc_id, text in [(r["doc_id"], r["text"]) for r in docs.collect()]:
        body = (text or "").encode()
        assert by_key[doc_id, len(body) + 1] == zlib.crc32(body)


def test_rebalancing_edits_the_map(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = sharding.slot_bytes(docs).cache()
    old = sharding.first_map(sizes, 8)
    grown = sharding.edit_map(old, sizes, 9)
    weight = {r["virtual_slot"]: r["bytes"] for r in sizes.collect()}
    moved = [k for k in weight if old[k] != grown[k]]
    assert sum(weight[k] for k in moved) < 1.5 * sum(weight.values()) / 9  # little more than the new shard holds
    assert 8 in {grown[k] for k in moved}
    fewer = sharding.edit_map(grown, sizes, 5)
    assert max(fewer) < 5
    loads = Counter()
    for k, b in weight.items():
        loads[fewer[k]] += b
    assert max(loads.values()) < 1.3 * sum(loads.values()) / 5
    sharding.save_map(spark, str(tmp_path), 1, old)
    sharding.save_map(spark, str(tmp_path), 2, grown)
    assert sharding.load_map(spark, str(tmp_path)).first()["version"] == 2
    assert [r["shard"] for r in sharding.load_map(spark, str(tmp_path), 1).orderBy("virtual_slot").collect()] == old


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = documents(spark)
    plan = spark.createDataFrame([(1, k, k % 3) for k in range(sharding.SLOTS)], "version int, virtual_slot int, shard int")
    sharding.write_shards(docs, plan, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == docs.count()
