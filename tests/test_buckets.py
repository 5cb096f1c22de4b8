"""Time buckets."""

import random
from collections import defaultdict
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from chronoctx.operators import buckets as B

KEYS = ["entity"]
UTC = timezone.utc


def ms(*parts):
    return int(datetime(*parts, tzinfo=UTC).timestamp() * 1000)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    edges = [ms(2024, 1, 31, 23, 59, 59), ms(2024, 12, 31, 23, 59, 59), ms(2024, 2, 29), ms(2024, 12, 1), ms(2024, 1, 1)]
    data = [("hot" if i % 3 else "b", "T1" if i < 200 else "T2", rng.choice(edges) + rng.randrange(0, 90_000), float(rng.randrange(5)), "abc"[i % 3])
            for i in range(400)]
    return spark.createDataFrame(data, "entity string, kind string, recv_time_ts long, value double, word string").repartition(5)


SLOT = {
    "second": (lambda d: d.replace(second=0), lambda d: d.second), "minute": (lambda d: d.replace(minute=0, second=0), lambda d: d.minute),
    "hour": (lambda d: d.replace(hour=0, minute=0, second=0), lambda d: d.hour), "day": (lambda d: d.replace(day=1, hour=0, minute=0, second=0), lambda d: d.day),
    "month": (lambda d: d.replace(month=1, day=1, hour=0, minute=0, second=0), lambda d: d.month),
}


def brute(rows, resolutions):
    out = defaultdict(list)
    for r in rows.collect():
        d = datetime.fromtimestamp(r.recv_time_ts // 1000, UTC).replace(tzinfo=None)
        for res in resolutions:
            out[r.entity, res, SLOT[res][0](d), SLOT[res][1](d)].append(r)
    return out


@pytest.mark.parametrize("resolutions", [B.ALL_RESOLUTIONS, ("month",), ("hour", "second")])
def test_numeric(spark, rows, resolutions):
    got = B.numeric_buckets(rows, KEYS, resolutions=resolutions, attr_type="kind").collect()
    want = brute(rows, resolutions)
    assert len(got) == len(want)
    for g in got:
        members = want[g.entity, g.resolution, g.origin, g.offset]
        values = [m.value for m in members]
        assert (g.samples, g["sum"], g.sum2, g["min"], g["max"]) == (
            len(values), sum(values), sum(v * v for v in values), min(values), max(values))
        newest = max(m.recv_time_ts for m in members)
        assert g.last_ts == newest and g.kind in {m.kind for m in members if m.recv_time_ts == newest}


def test_merge_equals_one_batch(spark, rows):
    parts = [B.numeric_buckets(rows.filter(F.col("value") % 2 == i), KEYS, attr_type="kind") for i in (0, 1)]
    merged = B.merge_numeric(parts[0].unionByName(parts[1]), KEYS, "kind")
    whole = B.numeric_buckets(rows, KEYS, attr_type="kind")
    names = [c for c in whole.columns if c != "kind"]
    assert merged.select(names).exceptAll(whole.select(names)).count() == 0 and merged.count() == whole.count()


def test_categorical_and_parts(spark, rows):
    flat = B.categorical_buckets(rows, KEYS, "word", resolutions=("day", "month"))
    want = brute(rows, ("day", "month"))
    assert sum(r.samples for r in flat.collect()) == 800
    seen = {(p.entity, p.resolution, p.origin, p.offset): p for p in B.occurrence_points(flat, KEYS, "word").collect()}
    assert set(seen) == set(want)
    for key, members in want.items():
        assert seen[key].samples == sum(seen[key].occur.values()) == len(members) and set(seen[key].occur) == {m.word for m in members}
    documents = B.dense_occurrences(B.occurrence_points(flat, KEYS, "word"), KEYS)
    assert documents.count() == documents.select(*KEYS, "resolution", "range", "origin").distinct().count()
    assert B.explode_points(documents).groupBy("resolution").agg(F.sum("samples")).collect()[0][1] == 400
    assert B.merge_categorical(flat.unionByName(flat), KEYS, "word").agg(F.sum("samples")).first()[0] == 1600


def test_dense_documents(spark, rows):
    sizes = {"second": 60, "minute": 60, "hour": 24, "day": 31, "month": 12}
    documents = B.dense_points(B.numeric_buckets(rows, KEYS), KEYS)
    for d in documents.collect():
        assert len(d.points) == sizes[d.resolution]
        first = 1 if d.resolution in ("day", "month") else 0
        assert [p.offset for p in d.points] == list(range(first, first + sizes[d.resolution]))
        for p in d.points:
            if p.samples == 0:
                assert (p["sum"], p.sum2, p["min"], p["max"]) == (0.0, 0.0, float("inf"), float("-inf"))
    total = B.explode_points(documents).groupBy("resolution").agg(F.sum("samples")).collect()
    assert {r[0]: r[1] for r in total} == dict.fromkeys(sizes, 400)


def test_rows_are_combined_before_the_shuffle(spark, rows):
    plan = B.numeric_buckets(rows, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") == 1 and plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


def test_texts_that_are_no_numbers(spark):
    texts = ["1", "-2.5e3", "0", "NaN", "Infinity", "3d", "1e400", "-1e400", "05", "", " 7", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(B.numeric_value(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [1.0, -2500.0, 0.0] + [None] * 9


def test_unknown_resolution(spark, rows):
    with pytest.raises(ValueError):
        B.numeric_buckets(rows, KEYS, resolutions=("week",))
