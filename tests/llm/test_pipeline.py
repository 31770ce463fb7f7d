"""The pipeline on awkward rows and on an empty table, stage by stage."""

import pytest
from cases import documents
from pyspark.sql import functions as F

import corpus_pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("awkward"))
    docs = documents(spark).withColumns({"__copy": F.lit("x"), "__sha": F.lit("y"), "__source": F.lit(1)})
    docs.write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame([(3, 1, 0), (7, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_awkward_rows_pass_all_stages(spark, folder):
    docs = before = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, folder), name)
        assert docs.columns == before.columns
        kept[name] = sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in docs.collect())
    assert len(kept["quality_classifier"]) == before.count()  # there is nothing to tell good from bad by
    texts = {(r["text"] or "") for r in before.collect()}
    assert len(kept["exact_dedup"]) == len(texts)
    assert len(kept["minhash_near_dedup"]) == len(texts) - 1  # the two long ones are near copies
    out = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r["doc_id"] or 0 for r in out) == [d for d, _ in kept["mixing"]]
    assert all(r["n_tokens"] >= 0 and len(r["ids_sha256"]) == 64 for r in out)


def test_an_empty_table_gives_an_empty_result(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 0
