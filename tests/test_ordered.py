"""Ordered groups, trajectories and retention, with and without hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from chronoctx.operators import retention as R
from chronoctx.operators import trajectory as TR
from chronoctx.operators.ordered import OrderedGroups

HOT = 40


@pytest.fixture(scope="module")
def points(spark):
    """One group holds two thirds of the rows; half of it has one timestamp."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        dest = "hot" if i % 3 else f"d{i % 7}"
        ts = 5_000 if dest == "hot" and i % 2 else rng.randrange(1, 10_000)
        rows.append((dest, i, ts, rng.uniform(-180, 180), rng.uniform(-85, 85), i % 5 or None))
    return spark.createDataFrame(rows, "dest string, seq int, recv_time_ts long, lon double, lat double, x int").repartition(7)


def _brute(points):
    groups = {}
    for r in points.collect():
        groups.setdefault(r.dest, []).append(r)
    return {k: sorted(v, key=lambda r: (r.recv_time_ts, r.seq)) for k, v in groups.items()}


@pytest.mark.parametrize("hot_rows", [10**6, HOT, 7])
def test_running_values(spark, points, hot_rows):
    groups = OrderedGroups.of(points, ["dest"], ["recv_time_ts", "seq"], hot_rows)
    assert (groups.hot is None) == (hot_rows == 10**6)
    got = groups.numbered("n").lag(before="seq", before_x="x").running(total=("sum", F.col("x")), low=("min", F.col("lon")), high=("max", F.col("x"))).result()
    got = {(r.dest, r.seq): r for r in got.collect()}
    assert len(got) == 600
    for dest, rows in _brute(points).items():
        total, low, high, before = None, None, None, None
        for i, r in enumerate(rows):
            if r.x is not None:
                total = (total or 0) + r.x
                high = r.x if high is None else max(high, r.x)
            low = r.lon if low is None else min(low, r.lon)
            g = got[dest, r.seq]
            assert (g.n, g.before, g.total, g.low, g.high) == (i + 1, before and before.seq, total, low, high)
            assert g.before_x == (before and before.x)
            before = r


@pytest.mark.parametrize("hot_rows", [10**6, HOT])
def test_numbers_over_all_rows_and_descending(spark, points, hot_rows):
    got = TR.with_row_ids(points, [], ["-recv_time_ts", "seq"], "id", 10, hot_rows).orderBy("id").collect()
    want = sorted(points.collect(), key=lambda r: (-r.recv_time_ts, r.seq))
    assert [(r.id, r.seq) for r in got] == [(i + 10, r.seq) for i, r in enumerate(want)]


def test_hot_runs_are_bounded(spark, points):
    groups = OrderedGroups.of(points, ["dest"], ["recv_time_ts", "seq"], HOT)
    sizes = [r["count"] for r in groups.hot.groupBy("_run").count().collect()]
    assert sum(sizes) == 400 and max(sizes) < 2 * HOT + 20
    assert groups.cold.filter("dest = 'hot'").count() == 0


def test_one_group_of_all_rows_never_meets_in_one_task(spark, points):
    plan = TR.with_row_ids(points, [], ["seq"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_newest_rows_are_limited_before_the_shuffle(spark, points):
    plan = R.retain_newest(points, ["dest"], 3, "seq")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_trajectory_is_the_same_with_hot_groups(spark, points):
    plain = TR.trajectory(points, ["dest"], "seq", scale=3)
    runs = TR.trajectory(points, ["dest"], "seq", scale=3, hot_rows=HOT)
    assert plain.exceptAll(runs).count() == 0 and runs.count() == 600


@pytest.mark.parametrize("hot_rows", [10**6, HOT])
def test_trajectory_resumes_batch_by_batch(spark, points, hot_rows):
    cuts = [0, 3_000, 5_001, 8_000, 20_000]
    done, state = None, None
    for low, high in zip(cuts, cuts[1:]):
        batch = points.filter((F.col("recv_time_ts") >= low) & (F.col("recv_time_ts") < high))
        out = TR.trajectory(batch, ["dest"], "seq", stored=state, scale=3, hot_rows=hot_rows)
        out = spark.createDataFrame(out.collect(), out.schema)
        done = out if done is None else done.unionByName(out)
        state = TR.last_rows(done, ["dest"])
    whole = TR.trajectory(points, ["dest"], "seq", scale=3)
    assert done.select(whole.columns).exceptAll(whole).count() == 0 and done.count() == 600


def test_known_trajectory(spark):
    df = spark.createDataFrame(
        [("p", 1, 1559908745414, 0.0, 0.0, None), ("p", 2, 1559908831520, 1.0, 1.0, 696473.71816969)],
        "dest string, seq int, recv_time_ts long, lon double, lat double, stage_distance double",
    )
    first, second = TR.trajectory(df, ["dest"], "seq").orderBy("seq").collect()
    zero = ["stageDistance", "stageTime", "stageSpeed", "sumDistance", "sumTime", "sumSpeed", "sum2Distance", "sum2Time", "sum2Speed"]
    assert all(first[c] == 0 for c in zero) and first.numSamples == 1 and first.cartodb_id == 1
    assert (first.maxDistance, first.minSpeed) == (1.4e-45, 3.4028235e38)
    assert second.stageTime == 86106 and second.stageSpeed == pytest.approx(8.08856198371414)
    assert second.sum2Distance == pytest.approx(485075640101.113) and second.sum2Time == 7414243236
    assert second.sum2Speed == pytest.approx(65.4248349643857) and second.numSamples == 2
    assert (second.maxDistance, second.minTime) == (696473.71816969, 86106)


def test_no_time_between_points(spark):
    df = spark.createDataFrame(
        [("p", i, t, float(i), 0.0) for i, t in enumerate([10, 10, 30])], "dest string, seq int, recv_time_ts long, lon double, lat double"
    )
    rows = TR.trajectory(df, ["dest"], "seq", moments=True).orderBy("seq").collect()
    assert rows[1].stageSpeed is None and rows[1].sumSpeed == 0 and rows[2].sumSpeed == rows[2].stageSpeed > 0
    assert rows[0].avgDistance is None and rows[2].avgTime == 10 and rows[2].varTime == 100
    assert rows[1].stageDistance == pytest.approx(111195.08, abs=0.01)


def _records(spark):
    rows = [("a", i, "x" * (i % 4 + 1), i * 1000 if i != 3 else 90_000) for i in range(20)]
    rows += [("b", 100 + i, "y", 500) for i in range(3)]
    return spark.createDataFrame(rows, "dest string, _id long, body string, ms long")


@pytest.mark.parametrize("hot_rows", [10**6, 5])
def test_retention(spark, hot_rows):
    df = _records(spark)
    ids = lambda out: sorted(r._id for r in out.collect())
    assert ids(R.retain_newest(df, ["dest"], 4)) == [16, 17, 18, 19, 100, 101, 102]
    assert ids(R.retain_age(df, F.col("ms"), 20_000, 5)) == [3, 15, 16, 17, 18, 19]
    assert ids(R.retain_after_prefix(df, ["dest"], F.col("ms"), 20_000, 5)) == list(range(3, 20))
    sizes = [(i, i % 4 + 1) for i in range(19, -1, -1)]
    kept, total = [], 0
    for i, size in sizes:
        total += size
        if total <= 12 and len(kept) < 6:
            kept.append(i)
    got = R.retain_capped(df, ["dest"], F.octet_length("body"), 12, 6, hot_rows=hot_rows)
    assert ids(got) == sorted(kept) + [100, 101, 102]
    assert R.retain_capped(df, ["dest"], F.octet_length("body"), 12, 0).count() == 23
    doomed = spark.createDataFrame([(5,), (101,)], "_id long")
    assert R.delete_records(df, doomed, ["_id"]).count() == 21


def test_latest_combines_before_the_shuffle(spark, points):
    out = TR.latest(points, ["dest"], "seq")
    assert {r.dest: r.seq for r in out.collect()} == {k: max(r.seq for r in v) for k, v in _brute(points).items()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "SortAggregate" not in plan
