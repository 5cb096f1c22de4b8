import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from chronoctx.llm import hard_negatives as mining, queries
from chronoctx.llm.common import prepare
from compare import connect, differences

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95):
    """Every pair with Python's own integers."""
    width = max(len(v) for _, v, _ in rows)
    whole = [(i, [int(np.floor(256.0 * x)) for x in v] + [0] * (width - len(v)), y) for i, v, y in rows]
    out = []
    for i, a, y in whole:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(p * q for p, q in zip(a, b)), j, z) for j, b, z in whole if j != i)
        for s, p, _ in [r for r in scored if r[2] == y][:positives]:
            fits = [(j, -t) for t, j, z in scored if z != y and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(i, p, k + 1, j, -s, t) for k, (j, t) in enumerate(fits)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


def test_query_against_sql(spark, sf_dir):
    for folder in (sf_dir, "/root/testdata/sf0.1"):
        sql = queries.ORACLES["op11_hard_negatives"]
        assert differences(queries.op11_hard_negatives(spark, folder), connect(folder), sql) == []
    assert entry.oracle_sql()["op11_hard_negatives"] == sql


def test_ties_copies_and_rows_that_take_no_part(spark):
    prepare(spark)
    chance = np.random.default_rng(2)
    rows = [(i, (chance.integers(-3, 4, 3) / 256).tolist(), int(chance.integers(3))) for i in range(-40, 160)]
    rows += [(500 + i, [0.01, 0.02, 0.01], 0) for i in range(120)]  # a third are copies, most of one label
    rows += [(700 + i, [0.01, 0.02, 0.01], 1) for i in range(60)]
    rows += [(800, [0.0, 0.0, 0.0], 0), (801, [0.0, 0.0, 0.0], 1), (802, [1.0], 0), (803, [], 1), (804, [-0.0] * 3, 2), (850, [1.0], 7)]
    bad = [(900, None, 1), (950, [1.0, None, 0.0], 1), (1000, [float("nan"), 0.0, 1.0], 1), (1050, [float("inf"), 0.0, 1.0], 1),
           (1100, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1)]
    df = spark.createDataFrame(rows + bad + rows[:9], SCHEMA).withColumns({c: F.lit("mine") for c in ("id", "mark", "x", "key", "scores", "slice")})
    for every in (1, 50):
        assert found(mining.mine(df, lambda i: i % every == 0)) == brute(rows, lambda i: i % every == 0)
    assert found(mining.mine(df.where("vec_id > 899"), lambda i: i % 50 == 0)) == []
    assert mining.mine(df.limit(0), lambda i: i >= 0).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_many_cells_give_what_one_gives(spark, monkeypatch):
    prepare(spark)
    chance = np.random.default_rng(4)
    rows = [(i, chance.normal(size=4).round(2).tolist(), "a" if i % 3 else "b") for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    for name, value in (("ROW_NUMBERS", 1000), ("ANCHOR_NUMBERS", 120), ("SCORES", 900)):
        monkeypatch.setattr(mining, name, value)
    assert found(mining.mine(df, lambda i: i % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)


def test_large_components_are_exact():
    chance = np.random.default_rng(6)
    one, two = chance.integers(-2**29, 2**29, (5, 8)).astype(float), chance.integers(-2**29, 2**29, (6, 8)).astype(float)
    exact = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in two] for x in one]
    assert mining.scores_of(one, two).tolist() == exact
    assert mining.scores_of(np.full((1, 2), 1e200), np.full((1, 2), 1e200)).tolist() == [[2**63 - 1]]


@pytest.mark.parametrize("score", [-7, -2, 0, 1, 2, 99, 1001, 2**62])
def test_windows(score):
    bottom, top = mining.window_of(score, 50, 95)
    for t in (bottom - 1, bottom, top, top + 1):
        assert (50 * score <= 100 * t <= 95 * score) == (bottom <= t <= top)


def test_a_key_sorts_as_its_pair():
    chance = np.random.default_rng(8)
    pairs = [tuple(int(v) for v in chance.integers(-3, 4, 4)) for _ in range(300)] + [(2**63 - 1, -2**63, -2**63, 2**63 - 1)]
    keys = [mining._pack(a, 0, 0, np.array([s]), np.array([i]), np.array([m])).tobytes() for a, s, i, m in pairs]
    assert [p for _, p in sorted(zip(keys, pairs))] == sorted(pairs, key=lambda p: (p[0], -p[1], p[2], p[3]))
    assert [tuple(c[0] for c in mining.unpack(k))[::2] for k in keys] == [(a, s, i) for a, s, i, _ in pairs]
