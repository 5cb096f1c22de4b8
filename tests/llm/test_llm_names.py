"""Columns of the input that are named as the operators' own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chronoctx.llm import packing
from chronoctx.llm.common import free_name
from llm_cases import hostile

NAMES = ("_line_key", "_line_drop", "_near_key", "_quality_statistics", "_row", "_cell", "text_", "_text")


@pytest.mark.parametrize("change", [str, str.upper])
def test_no_column_name_is_special(spark, sf_dir, change):
    docs = hostile(spark, extra=False).withColumns({change(n): F.concat(F.lit("mine"), F.col("doc_id")) for n in NAMES})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        for r in out.collect():
            assert {r[change(n)] for n in NAMES} == {None if r.doc_id is None else f"mine{r.doc_id}"}, name
    pieces = spark.createDataFrame([(i, i % 3 * 700 + 1, "mine") for i in range(40)], "doc_id long, length long, x string").withColumns(
        {change(n): F.col("doc_id") for n in NAMES})
    packed = packing.pack(pieces)
    assert packed.columns == [*pieces.columns, "sequence_id", "offset"]
    assert all({r[change(n)] for n in NAMES} == {r.doc_id} for r in packed.collect())


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2)], "A int, a_ int")
    assert free_name(df, "a") == "a__" and free_name(df, "b") == "b"
