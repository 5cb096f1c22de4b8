import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoctx.llm import queries, whitening
from chronoctx.llm.common import prepare

SCHEMA = "vec_id long, embedding array<double>"


def brute(vectors, components=16):
    """Covariance and eigenvectors by numpy, sums by Python's integers."""
    width = max(map(len, vectors))
    x = [[int(np.floor(64.0 * c)) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array([s / n for s in sums])
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in fit])
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    kept = [k for k in range(min(components, width)) if values[k] > width * np.finfo(float).eps * values[0]]
    return n, [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x], (np.array(x) - mean) @ basis / np.sqrt(values), values / values.sum(), kept


def check(rows, df, same_space=()):
    """``same_space``: components that share an eigenvalue, so any basis of their space is right."""
    got = {}
    for r in df.collect():
        got.setdefault(r.vec_id, {})[r.component - 1] = r
    n, deviations, white, explained, kept = brute([v for _, v in rows])
    assert sorted(got) == sorted(i for i, _ in rows)
    errors = {r.identity_error for parts in got.values() for r in parts.values()}
    assert len(errors) == 1 and errors.pop() <= 1e-9
    table = np.array([[got[i][k].whitened for k in kept] for i, _ in rows])
    for place, (i, _) in enumerate(rows):
        assert sorted(got[i]) == kept
        assert {(r.n, r.deviation) for r in got[i].values()} == {(n, deviations[place])}
        assert np.allclose([got[i][k].explained for k in kept], explained[kept], rtol=1e-9)
    alone = [k for k in kept if k not in same_space]
    signs = np.sign((table[:, alone] * white[:, alone]).sum(axis=0))
    assert np.allclose(table[:, alone] * signs, white[:, alone], atol=1e-8)
    both = [k for k in kept if k in same_space]
    assert np.allclose((table[:, both] ** 2).sum(axis=1), (white[:, both] ** 2).sum(axis=1), atol=1e-7)


def test_query_against_numpy(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
        sound = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
        check(sound, queries.op13_whitening(spark, folder))


def test_copies_count_once_and_bad_rows_not_at_all(spark):
    prepare(spark)
    chance = np.random.default_rng(1)
    rows = [(i, chance.normal(size=5).tolist()) for i in range(60)] + [(100 + i, [0.25, 1.0, -3.0, 0.0, 9.0]) for i in range(90)]
    rows += [(300, [7.0]), (301, []), (302, [1e9, 1.0, 1.0, 1.0, 1.0])]
    bad = [(400, None), (401, [1.0, None, 1.0, 1.0, 1.0]), (402, [float("nan")] * 5), (403, [float("-inf"), 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumns({c: F.lit("mine") for c in ("x", "vec", "n", "i", "row", "component")})
    check(rows[:-1], whitening.whiten(df.where("vec_id <> 302")))
    got = whitening.whiten(df).where("component = 1").collect()
    n, deviations, *_ = brute([v for _, v in rows])
    want = {i: d if d < 2**63 else None for (i, _), d in zip(rows, deviations)}
    assert {r.vec_id: r.deviation for r in got} == want and None in want.values() and {r.n for r in got} == {n}


def test_rows_without_variance_and_none(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.5, 2.0]), (None, [0.5, 2.0])], SCHEMA)
    assert whitening.whiten(df).collect() == [] and whitening.whiten(df.limit(0)).collect() == []
    line = spark.createDataFrame([(i, [i / 4.0, i / 2.0, 1.0]) for i in range(9)] + [(None, [1.0, 2.0, 1.0])], SCHEMA)
    got = whitening.whiten(line).collect()
    assert {r.component for r in got} == {1} and len(got) == 10 and all(abs(r.explained - 1) < 1e-12 for r in got)


def test_repeated_eigenvalues_span_the_same_space(spark):
    prepare(spark)
    rows = [(k, [float(s) if d == j else 0.0 for d in range(4)]) for k, (j, s) in enumerate((j, s) for j in range(3) for s in (-1, 1))]
    rows += [(10 + k, [0.0, 0.0, 0.0, float(s)]) for k, s in enumerate((-3, 3))]
    check(rows, whitening.whiten(spark.createDataFrame(rows, SCHEMA)), same_space=(1, 2, 3))


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64])
def test_spectrum(size):
    chance = np.random.default_rng(size)
    turn = np.linalg.qr(chance.normal(size=(size, size)))[0]
    half = size // 2
    for values in (
        chance.uniform(0.5, 5, size), np.r_[np.ones(half), np.full(size - half, 2.0)], 10.0 ** chance.uniform(-14, 3, size),
        np.r_[np.zeros(half), chance.uniform(1, 2, size - half)], 1 + 1e-9 * chance.normal(size=size), np.full(size, 3.0), np.zeros(size),
    ):
        matrix = (turn * values) @ turn.T
        matrix = (matrix + matrix.T) / 2
        found, basis = whitening.spectrum(matrix)
        near = 1e-14 * size * max(np.abs(matrix).max(), 1e-300)
        assert np.abs(basis.T @ basis - np.eye(size)).max() < 1e-13
        assert np.abs(matrix @ basis - basis * found).max() <= near
        assert np.abs(found - np.linalg.eigvalsh(matrix)[::-1]).max() <= near


def test_polar_factor_is_the_sign():
    chance = np.random.default_rng(3)
    turn = np.linalg.qr(chance.normal(size=(12, 12)))[0]
    values = np.r_[10.0 ** chance.uniform(-9, 2, 6), -(10.0 ** chance.uniform(-9, 2, 6))]
    sign = whitening.polar_sign((turn * values) @ turn.T)
    assert np.abs(sign @ sign - np.eye(12)).max() < 1e-12 and np.trace(sign) == pytest.approx(0, abs=1e-10)
