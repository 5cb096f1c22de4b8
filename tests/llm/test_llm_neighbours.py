import numpy as np

from chronoctx.llm import neighbours, queries
from chronoctx.llm.common import prepare


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], float)
    out = {}
    for i, v in zip(ids.tolist(), vectors):
        scores = neighbours.cosines(v, vectors)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_few_vectors_are_searched_exactly(spark):
    prepare(spark)
    chance = np.random.default_rng(3)
    rows = [(i, chance.normal(size=4).tolist()) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(12)]  # copies: ties go to smaller ids
    bad = [(200, None), (201, [0.0] * 4), (202, [1.0, float("nan"), 0.0, 0.0]), (203, [1.0, None, 0.0, 0.0]),
           (204, [float("inf"), 0.0, 0.0, 0.0]), (205, []), (None, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "mine") for i, v in rows + bad + rows[:1]], "vec_id long, embedding array<double>, label int, v string")
    assert found(neighbours.nearest(df, lambda i: i >= 0)) == brute(rows, 5)


def test_fewer_candidates_than_asked_and_none(spark):
    prepare(spark)
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [len(v) for v in found(neighbours.nearest(df, lambda i: i == 0)).values()] == [2]
    assert neighbours.nearest(df.where("vec_id > 5"), lambda i: i >= 0).collect() == []
    assert neighbours.nearest(df.where("vec_id = 0"), lambda i: i >= 0).collect() == []


def test_recall_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want, got = brute(rows, 5), found(queries.op5_neighbours(spark, sf_dir))
    assert set(got) == {i for i, _ in rows if i % 50 == 0}
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in got)
    assert hits >= 0.9 * 5 * len(got)
    exact = {q: dict(v) for q, v in want.items()}
    assert all(s == exact[q].get(i, s) for q, v in got.items() for i, s in v)


def test_scaled_copies_tie_as_in_brute_force(spark):
    prepare(spark)
    chance = np.random.default_rng(5)
    for others in (0, 300):
        one = chance.normal(size=16)
        rows = [(int(i), (one * s).tolist()) for i, s in zip(chance.permutation(400), chance.uniform(0.1, 9, 400))]
        rows += [(1000 + i, chance.normal(size=16).tolist()) for i in range(others)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        want = {i: v for i, v in brute(rows, 5).items() if i < 400}
        assert found(neighbours.nearest(df, lambda i: i < 400)) == want


def test_extreme_and_shorter_vectors_take_part(spark):
    prepare(spark)
    chance = np.random.default_rng(9)
    rows = [(i, (chance.normal(size=4) * s).tolist()) for i, s in enumerate([1e-200, 1e200, 5e-324, 1e-308, 1.7e308, 1.0, 3.0, 1e-5] * 5)]
    rows = [(i, [x if np.isfinite(x) else 1.7e308 for x in v]) for i, v in rows] + [(900, [2.0]), (901, [1.0, 2.0]), (902, [1e-200, 0.0, 0.0, 1e-200])]
    rows = [(i, v) for i, v in rows if any(v)]
    scaled = [(i, [x / max(map(abs, v)) for x in v] + [0.0] * (4 - len(v))) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = found(neighbours.nearest(df, lambda i: i >= 0)), brute(scaled, 5)
    assert set(got) == {i for i, _ in rows}
    for i, near in want.items():
        assert np.allclose([s for _, s in got[i]], [s for _, s in near], atol=1e-9)
