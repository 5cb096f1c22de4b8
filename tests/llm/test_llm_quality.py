import binascii

import numpy as np
from pyspark.sql import functions as F

from chronoctx.llm import quality, queries
from llm_cases import empty, hostile


def test_rules_in_numpy_and_in_spark_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert 0 < len(model.rules) < 200
    rows = docs.select(quality.statistics(F.col("text")).alias("s")).select("s.*", model.column(F.col("s")).alias("rated")).collect()
    x = np.array([[r[c] for c in quality.STATISTICS] for r in rows])
    assert np.allclose(model.scores(x), [r.rated for r in rows])


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op4_quality(spark, sf_dir).collect()
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    tried = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in tried) / len(tried) > 0.97


def test_hostile_documents_and_labels(spark):
    docs = hostile(spark)
    labels = spark.createDataFrame([(0, 1), (0, 1), (2, 0), (3, None), (None, 1), (99, 1), (16, 1), (17, 0), (18, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    rows = quality.score_documents(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1)}) == 1
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns


def test_without_two_classes(spark):
    docs = hostile(spark)
    for labels, low, high in (([], 0.5, 0.5), ([(0, 1), (2, 1)], 0.5, 1)):
        model = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert not model.rules and all(low <= r.score <= high for r in quality.score_documents(docs, model).collect())
    assert quality.score_documents(empty(spark), model).collect() == []
