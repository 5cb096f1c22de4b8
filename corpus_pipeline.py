"""A training corpus from raw documents: five stages, each on all that the one
before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chronoctx.llm import line_dedup, near_duplicates, packing, pii, quality
from chronoctx.llm.common import prepare, table
from chronoctx.plans.session import store


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    prepare(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more have go."""
    prepare(spark)
    return line_dedup.drop_frequent_lines(docs, least=10)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    prepare(spark)
    return near_duplicates.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked."""
    prepare(spark)
    return pii.masked_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in as few sequences as possible."""
    prepare(spark)
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("line dedup", without_shared_lines),
    ("near duplicates", without_near_duplicates),
    ("personal data", without_personal_data),
    ("packing", packed),
]
#: The classifier, the search for near duplicates and the packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
