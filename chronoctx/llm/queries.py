"""Queries of the text operators over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoctx.llm import (
    bpe, fingerprints, hard_negatives, licenses, line_dedup, near_duplicates, neighbours, packing, pii, quality, repeats, whitening,
    word_bpe,
)
from chronoctx.llm.common import prepare, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(prepare(spark), sf_dir, "documents"), least=10)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(prepare(spark), sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(prepare(spark), sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(prepare(spark), sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(prepare(spark), sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_documents(table(prepare(spark), sf_dir, "documents"), path)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(prepare(spark), sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(table(prepare(spark), sf_dir, "documents")))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared_with_next(table(prepare(spark), sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(prepare(spark), sf_dir, "embeddings"), lambda i: i % 50 == 0, label)


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.round_trip(table(prepare(spark), sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(prepare(spark), sf_dir, "embeddings"))


QUERIES = [
    op1_line_dedup, op2_bpe, op3_licenses, op4_quality, op5_neighbours, op6_near_duplicates, op7_packing, op8_repeats, op9_pii,
    op10_fingerprints, op11_hard_negatives, op12_word_bpe, op13_whitening,
]
#: Twins for what SQL can express over whole tables.
ORACLES: dict[str, str] = {
    "op1_line_dedup": r"""
        WITH cut AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM cut
        ), frequent AS (
            SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        )
        SELECT k.doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
        FROM keyed k LEFT JOIN frequent f USING (key) GROUP BY k.doc_id
    """,
    "op11_hard_negatives": """
        WITH sound AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
                   list_dot_product(a.x, r.x)::BIGINT AS score
            FROM sound a JOIN sound r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
        FROM positives p JOIN scored n USING (anchor_id)
        WHERE NOT n.same AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
        QUALIFY rank <= 3
    """,
}
