from collections import Counter, defaultdict

import numpy as np

from chronoctx.llm import near_duplicates as near
from chronoctx.llm.components import components
from llm_cases import BODY, empty, hostile


def brute(docs):
    """Class ids and numbers of links by comparing every pair that shares a shingle."""
    sets = [near.shingles(t or "") for _, t in docs]
    holders, common = defaultdict(list), Counter()
    for i, found in enumerate(sets):
        for h in found.tolist() or [-1]:
            holders[h].append(i)
    for own in holders.values():
        common.update((a, b) for k, b in enumerate(own) for a in own[:k])
    parent, links = list(range(len(docs))), Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        union = len(sets[a]) + len(sets[b]) - n
        if not len(sets[a]) or 5 * n >= 4 * union:
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return Counter((doc_id, min(least[root(i)], default=None), links[i]) for i, (doc_id, _) in enumerate(docs))


def results(df):
    return Counter((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def test_hostile_documents_match_brute_force(spark):
    docs = hostile(spark)
    assert results(near.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert near.near_duplicates(empty(spark)).collect() == []


def test_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert results(near.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 16)
    words = BODY.split()
    texts = [" ".join([*words[:5 * i], f"changed{i}", *words[5 * i + 1:]]) for i in range(70)] + [BODY] * 30
    docs = hostile(spark, texts)
    assert results(near.near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_one_of_each_group_stays(spark):
    docs = hostile(spark)
    kept = near.keep_one(docs)
    classes = {r.doc_id: r.class_id for r in near.near_duplicates(docs).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(i for i in ids if i is not None) == sorted(set(classes.values()) - {None}) and ids.count(None) == 1


def test_posterior_and_survivors():
    assert near.fewest_equal(32, 0.8, 1e-9) < near.fewest_equal(32, 0.8, 1e-3) < 32
    chance = np.random.default_rng(1)
    one = chance.integers(0, 2 ** 32, (3, near.HASHES), dtype=np.uint32)
    other = np.vstack((one[1:2], chance.integers(0, 2 ** 32, (2, near.HASHES), dtype=np.uint32)))
    assert [x.tolist() for x in near._survivors(one, other)] == [[1], [0]]


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "u long, v long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert roots == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
