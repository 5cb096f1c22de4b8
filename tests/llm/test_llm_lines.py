import hashlib
from collections import Counter

import numpy as np

from chronoctx.llm import line_dedup, queries
from chronoctx.llm.perfect_hash import PerfectHash
from compare import connect, differences
from llm_cases import empty, hostile

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, least):
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate(LOWER) for line in (t or "").split("\n")] for t in texts]
    counts = Counter(k for own in keys for k in set(own))
    out = []
    for text, own in zip(texts, keys):
        kept = [line for line, k in zip((text or "").split("\n"), own) if not k or counts[k] < least]
        out.append((len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_perfect_hash_is_minimal_and_survives_storing():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64)
    table = PerfectHash.from_bytes(PerfectHash.build(np.unique(keys)).to_bytes())
    assert sorted(table.slots(np.unique(keys)).tolist()) == list(range(len(np.unique(keys))))
    assert PerfectHash.build(np.zeros(0, np.uint64)).slots(keys[:3]).tolist() == [-1, -1, -1]


def test_hostile_documents_match_brute_force(spark):
    docs = hostile(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = Counter((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], 2)))
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.digest(docs, 2).collect())
    assert got == want


def test_documents_keep_their_columns(spark):
    docs = hostile(spark)
    out = line_dedup.drop_frequent_lines(docs, 2)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert {r.n_lines for r in out.collect()} == {"mine"}
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_empty_table(spark):
    assert line_dedup.digest(empty(spark)).collect() == []


def test_query_matches_sql(spark, sf_dir):
    assert differences(queries.op1_line_dedup(spark, sf_dir), connect(sf_dir), queries.ORACLES["op1_line_dedup"]) == []


def test_very_long_text_of_equal_lines(spark):
    (row,) = line_dedup.digest(hostile(spark, ["a\n" * 200_000], extra=False).where("doc_id = 0").limit(1), 1).collect()
    assert (row.n_lines, row.n_dropped) == (200_001, 200_000)

