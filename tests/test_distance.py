"""The closed form against an iterated geodesic."""

import math
import random

import pytest
from pyspark.sql import functions as F

from chronoctx.functions import geo as G
from chronoctx.functions import sql as SQL
from chronoctx.operators import trajectory as TR


def vincenty(lon1, lat1, lon2, lat2):
    """Metres on the ellipsoid; None where the iteration does not settle."""
    a, f = G.SEMI_MAJOR_M, G.FLATTENING
    b, wide = a * (1 - f), math.radians(lon2 - lon1)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    turn = wide
    for _ in range(200):
        x = math.cos(u2) * math.sin(turn)
        y = math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(turn)
        sine, cosine = math.hypot(x, y), math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(turn)
        if sine == 0:
            return 0.0
        angle = math.atan2(sine, cosine)
        azimuth = math.cos(u1) * math.cos(u2) * math.sin(turn) / sine
        squared = 1 - azimuth ** 2
        middle = cosine - 2 * math.sin(u1) * math.sin(u2) / squared if squared > 1e-15 else 0.0
        c = f / 16 * squared * (4 + f * (4 - 3 * squared))
        new = wide + (1 - c) * f * azimuth * (angle + c * sine * (middle + c * cosine * (2 * middle ** 2 - 1)))
        if abs(new - turn) < 1e-12:
            break
        turn = new
    else:
        return None
    k = squared * (a * a - b * b) / (b * b)
    big = 1 + k / 16384 * (4096 + k * (k * (320 - 175 * k) - 768))
    small = k / 1024 * (256 + k * (k * (74 - 47 * k) - 128))
    change = small * sine * (middle + small / 4 * (cosine * (2 * middle ** 2 - 1) - small / 6 * middle * (4 * sine ** 2 - 3) * (4 * middle ** 2 - 3)))
    return b * big * (angle - change)


@pytest.fixture(scope="module")
def pairs():
    chance = random.Random(1)
    out = [(chance.uniform(-180, 180), chance.uniform(-90, 90), chance.uniform(-180, 180), chance.uniform(-90, 90)) for _ in range(3000)]
    out += [(x, y, x + chance.uniform(-2, 2), y + chance.uniform(-2, 2)) for x, y, *_ in out[:1000] if abs(y) < 88]
    return out + [(10.0, 20.0, 10.0, 20.0), (0.0, 90.0, 50.0, -90.0), (0.0, 0.0, 180.0, 0.0), (5.0, 90.0, 77.0, 90.0), (179.9, 1.0, -179.9, 1.0)]


def measured(spark, pairs, column):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double, c double, d double")
    return {r.i: r.m for r in df.select("i", column.alias("m")).collect()}


def test_within_fifty_metres_in_a_thousand_kilometres(spark, pairs):
    got = measured(spark, pairs, G.distance_ellipsoid_m(*map(F.col, "abcd")))
    checked = 0
    for i, pair in enumerate(pairs):
        want = vincenty(*pair)
        if want is not None and want < 19_000_000:
            assert abs(got[i] - want) <= max(0.05, 50e-6 * want), pair
            checked += 1
    assert checked > 3500
    at = len(pairs) - 5
    assert got[at] == 0 and got[at + 3] == pytest.approx(0, abs=1e-3)
    assert got[at + 1] == pytest.approx(20_003_931, abs=50) and 20_000_000 < got[at + 2] < 20_038_000


def test_sql_function_is_the_column(spark, pairs):
    SQL.register(spark)
    one = measured(spark, pairs, G.distance_ellipsoid_m(*map(F.col, "abcd")))
    two = measured(spark, pairs, F.expr("ctx_geo_distance_ellipsoid(a, b, c, d)"))
    assert all(two[i] == pytest.approx(m, rel=1e-9, abs=1e-3) for i, m in one.items())


def test_a_path_on_the_ellipsoid(spark):
    points = spark.createDataFrame([("a", i, i * 1000, 0.0, 10.0 * i) for i in range(3)], "k string, i long, recv_time_ts long, lon double, lat double")
    rows = TR.trajectory(points, ["k"], "i", measure="ellipsoid").orderBy("i").collect()
    assert [r.stageDistance for r in rows[1:]] == [pytest.approx(vincenty(0, 10.0 * i, 0, 10.0 * i + 10), abs=30) for i in range(2)]
