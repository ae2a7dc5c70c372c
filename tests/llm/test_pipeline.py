"""The pipeline's stages: what they drop, keep and change."""

from collections import Counter

import corpus_pipeline
import pytest
from llm.conftest import texts_of
from llm.test_near_copies import least_ids
from llm.test_tokens import check_packing
from pyspark.sql import functions as F

from millrace.llm import secret_scan

FOLDER = "/root/testdata/sf0.01"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_duplicates", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, FOLDER).persist()
        assert docs.columns == DOCUMENTS and docs.schema == before.schema
        kept = {r.doc_id for r in docs.collect()}
        assert len(kept) == docs.count()
        if name == "quality":
            bad = labels.filter("quality = 0").join(before, "doc_id")
            assert bad.filter(F.col("doc_id").isin(kept)).count() <= 0.1 * bad.count()
            assert len(kept) > 0.75 * before.count()
        if name == "near_duplicates":
            assert kept == {least for _, least in least_ids(texts_of(before))}
        if name == "secrets":
            assert docs.count() == before.count()
            assert not any(secret_scan.base_spans(r.text) for r in docs.collect())
            assert all(len(r.text) == r.n_chars for r in docs.collect())
    check_packing(corpus_pipeline.pack(spark, docs, FOLDER).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows_pass_every_stage(spark, documents, no_documents, tmp_path):
    spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, no_documents, str(tmp_path)).count() == 0
        assert stage(spark, documents, str(tmp_path)).schema == documents.schema
    kept = corpus_pipeline.drop_near_duplicates(spark, documents, str(tmp_path))
    assert Counter(kept.groupBy("doc_id").count().select("count").toPandas()["count"]) == {1: kept.count()}
    assert kept.filter("doc_id is null").count() == 1
    assert corpus_pipeline.pack(spark, no_documents, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["pipeline", "op2_vector_topk"])
def test_registered(name):
    import __spark_entry__

    assert name in __spark_entry__.queries()
