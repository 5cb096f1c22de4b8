"""Tables with versions: commits, readers, retention, orphans."""

import pytest
from pyspark.sql import functions as F

from chronoctx.operators import retention as R
from chronoctx.plans.session import shared_dir
from chronoctx.sinks import ids as IDS
from chronoctx.sinks import maintenance as MT
from chronoctx.sinks import versions as V

DAY = 86_400_000
LAYOUT = {"partitions": ("day",), "order": ("dest", "_id"), "time_ms": "ms"}


@pytest.fixture
def root(spark, tmp_path):
    shared_dir(spark)
    return str(tmp_path / "store")


def records(spark, n=400):
    """Days follow ids but for every seventh row; one destination has half of all."""
    rows = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 6)).alias("dest"), F.col("id").alias("_id"),
        ((F.col("id") / 40).cast("long") + F.when(F.col("id") % 7 == 0, 3).otherwise(0)).alias("n"), F.repeat(F.lit("x"), (F.col("id") % 9).cast("int")).alias("text"),
    )
    return rows.select("dest", "_id", (F.col("n") * DAY + F.col("_id")).alias("ms"), "text", F.col("n").cast("string").alias("day"))


def stored(spark, root, version=None):
    rows = V.read(spark, root, "t", version)
    return [] if rows is None else sorted((r.dest, r._id, r.ms, r.text) for r in rows.collect())


def wanted(df):
    return sorted((r.dest, r._id, r.ms, r.text) for r in df.collect())


def paths(spark, root):
    return {r.path for r in V.file_list(spark, root).collect()}


@pytest.fixture
def filled(spark, root):
    rows = records(spark)
    V.commit(spark, root, {"t": rows.filter("_id < 200")}, **LAYOUT)
    V.commit(spark, root, {"t": rows.filter("_id >= 200")}, **LAYOUT)
    return rows


OPERATIONS = {
    "newest": (lambda s, r: MT.keep_newest(s, r, "t", ["dest"], 90, **LAYOUT), lambda df: R.retain_newest(df, ["dest"], 90)),
    "age": (lambda s, r: MT.drop_expired(s, r, "t", 8 * DAY, 4 * 86_400, **LAYOUT), lambda df: R.retain_age(df, F.col("ms"), 8 * DAY, 4 * 86_400)),
    "prefix": (lambda s, r: MT.drop_prefix(s, r, "t", ["dest"], 8 * DAY, 4 * 86_400, **LAYOUT),
               lambda df: R.retain_after_prefix(df, ["dest"], F.col("ms"), 8 * DAY, 4 * 86_400)),
    "bytes": (lambda s, r: MT.keep_capped(s, r, "t", ["dest"], F.octet_length("text"), 300, 80, **LAYOUT),
              lambda df: R.retain_capped(df, ["dest"], F.octet_length("text"), 300, 80)),
    "ids": (lambda s, r: MT.delete_records(s, r, "t", s.range(0, 130).select(F.col("id").alias("_id")), ["_id"], **LAYOUT),
            lambda df: df.filter("_id >= 130")),
}


@pytest.mark.parametrize("name", sorted(OPERATIONS))
def test_retention_of_a_stored_table(spark, root, filled, name):
    apply, operator = OPERATIONS[name]
    before, files = stored(spark, root), paths(spark, root)
    assert before == wanted(filled)
    assert apply(spark, root) == 3
    assert stored(spark, root) == wanted(operator(filled)) and len(stored(spark, root)) < len(before)
    assert stored(spark, root, 2) == before  # the version before is as it was
    kept = files & paths(spark, root)
    assert kept and kept < files  # files without a doomed row are the same ones
    untouched = {r.path for r in spark.read.parquet(*files).filter("ms is null").select(F.col("_metadata.file_path").alias("path")).collect()}
    assert not untouched
    assert apply(spark, root) is None and len(V.versions(spark, root)) == 3  # nothing is left to do


def test_everything_can_go_and_come_again(spark, root, filled):
    MT.delete_records(spark, root, "t", filled.select("_id"), ["_id"], **LAYOUT)
    assert stored(spark, root) == [] and MT.keep_newest(spark, root, "t", ["dest"], 3, **LAYOUT) is None
    V.commit(spark, root, {"t": filled.limit(0)}, **LAYOUT)
    V.commit(spark, root, {"t": filled.filter("_id < 10")}, **LAYOUT)
    assert len(stored(spark, root)) == 10


def test_a_writer_that_dies_is_seen_by_nobody(spark, root, monkeypatch):
    rows = records(spark, 20)
    V.commit(spark, root, {"t": rows.filter("_id < 10"), "dead": rows.filter("_id < 2")}, **LAYOUT)
    broken = rows.filter("_id >= 10").withColumn("text", F.when(F.col("_id") == 15, F.raise_error(F.lit("died"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="died"):
        V.commit(spark, root, {"t": rows.filter("_id >= 10"), "dead": broken}, **LAYOUT)
    assert len(stored(spark, root)) == 10 and V.read(spark, root, "dead").count() == 2
    assert V.orphans(spark, root) == []  # too young: a writer may be at work
    left = V.orphans(spark, root, -1)
    assert left and V.remove_orphans(spark, root, -1) == len(left) and V.orphans(spark, root, -1) == []
    assert len(stored(spark, root)) == 10 and V.read(spark, root, "nothing") is None


def test_repeated_and_rival_commits(spark, root, monkeypatch):
    rows = records(spark, 30)
    assert [V.commit(spark, root, {"t": rows.filter("_id < 10")}, token="b0", **LAYOUT) for _ in range(2)] == [1, 1]
    publish, rivals = V._publish, iter([rows.filter("_id between 10 and 19"), None])

    def late(s, r, number, record):
        rival = next(rivals, None)
        if rival is not None:
            V.commit(spark, root, {"t": rival}, **LAYOUT)
        return publish(s, r, number, record)

    monkeypatch.setattr(V, "_publish", late)
    assert V.commit(spark, root, {"t": rows.filter("_id >= 20")}, **LAYOUT) == 3
    assert len(stored(spark, root)) == 30
    # a rewrite whose files were taken out meanwhile does not bring them back
    gone = V.file_list(spark, root).select("table", "path")
    rivals = iter([1])

    def robbed(s, r, number, record):
        if next(rivals, None):
            publish(s, r, number, {"commit": steal, "token": None, "tables": ["t"]})
        return publish(s, r, number, record)

    steal = "stolen"
    gone.limit(1).select("table", "path", F.lit(False).alias("added"), *[F.lit(None).cast("long").alias(c) for c in ("n_rows", "n_bytes", "low", "high")]).write.parquet(f"{root}/lists/commit=stolen")
    monkeypatch.setattr(V, "_publish", robbed)
    with pytest.raises(V.Conflict):
        MT.delete_records(spark, root, "t", rows.select("_id"), ["_id"], **LAYOUT)


def test_old_rows_are_found_without_reading(spark, root, filled, monkeypatch):
    monkeypatch.setattr(V, "_read", lambda *a: pytest.fail("a file was read"))
    assert MT.drop_expired(spark, root, "t", 10**9 * DAY, 1, **LAYOUT) == 3
    assert V.file_list(spark, root).count() == 0


def test_ids_go_on_over_appends_and_rivals(spark, root, monkeypatch):
    rows = records(spark, 120).select("dest", F.col("_id").alias("n"), "ms")

    def append(part, token, **more):
        return IDS.append_with_ids(spark, root, "t", rows.filter(part), ["dest"], ["n"], token=token, partitions=(), order=("dest",), time_ms="ms", **more)

    assert append("n < 40", "a") == 1 and append("n between 40 and 79", "b", hot_rows=5) == 2 and append("n < 40", "a") == 1
    commit, rivals = V.commit, iter([1])

    def late(*args, **kw):
        if next(rivals, None):
            append("n between 80 and 89", "rival")
        return commit(*args, **kw)

    monkeypatch.setattr(V, "commit", late)
    assert append("n >= 90", "c") == 4
    monkeypatch.undo()
    assert IDS.compact(spark, root, "t", ["dest"]) == 5
    assert append("n < 4", "d") == 6
    found = {}
    for r in V.read(spark, root, "t").collect():
        found.setdefault(r.dest, []).append((r._id, r.n))
    for dest, numbered in found.items():
        assert [i for i, _ in sorted(numbered)] == list(range(1, len(numbered) + 1))
    first = [n for _, n in sorted(found["hot"])]
    assert first == [*range(0, 120, 2), 0, 2]
    last = {r.dest: r.last_id for r in IDS.largest(spark, root, "t", ["dest"]).collect()}
    assert last == {dest: len(numbered) for dest, numbered in found.items()}


def test_a_batch_of_a_stream_is_one_version_or_nothing(spark, root, monkeypatch):
    from chronoctx.streaming import history as SH
    from chronoctx.streaming import runtime
    from test_parse import CAR, raw

    write = SH.version_writer(root, "job")
    batch = raw(spark, CAR).unionByName(raw(spark, "{broken"))
    with monkeypatch.context() as dying:
        def die(*_):
            raise OSError("gone")

        dying.setattr(V, "_publish", die)
        with pytest.raises(OSError):
            write(batch, 0)
    assert V.read(spark, root, "history") is None and V.read(spark, root, "dead_letter") is None
    assert V.orphans(spark, root, -1)
    write(batch, 0)
    once = V.read(spark, root, "history").count()
    write(batch, 0)
    assert V.read(spark, root, "history").count() == once > 0 and V.read(spark, root, "dead_letter").count() == 1
    write(batch, 1)
    assert V.read(spark, root, "history").count() == 2 * once and list(V.versions(spark, root)) == [1, 2]
    with pytest.raises(ValueError):
        runtime.run_batch(batch, 2, write, root, faults=(OSError,))
