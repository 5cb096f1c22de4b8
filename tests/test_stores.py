"""Catalogue, fragments, schemas, parameters, sinks and streams."""

import json

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from chronoctx import model as M
from chronoctx.functions import params, vocab
from chronoctx.operators import catalog as C
from chronoctx.operators import evolve
from chronoctx.operators import fragments as FR
from chronoctx.options import Options
from chronoctx.plans.session import scratch, shared_dir, store
from chronoctx.sinks import files
from chronoctx.sources import history as H
from chronoctx.sources import notifications as NS
from chronoctx.streaming import buckets as SB
from chronoctx.streaming import fragments as SF
from chronoctx.streaming import history as SH
from chronoctx.streaming import runtime
from chronoctx.streaming import trajectory as ST
from test_parse import CAR, raw


def pairs(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


# -- catalogue --------------------------------------------------------------

def test_enrichment_keeps_headers_without_a_value(spark):
    events = raw(spark, CAR, headers={"version": "old", "contactName": "kept", "Keywords": "[\"x\"]"})
    out = C.enrich(events, {"version": "'2'", "contactName": "CASE WHEN event_id > 5 THEN 'x' END", "themes": "'a,b'"})
    headers = out.first().headers
    assert headers == {"version": "2", "contactName": "kept", "Keywords": '["x"]', "themes": '["a","b"]'}
    row = C.catalog_columns(out).first()
    assert row.keywords == ["x"] and row.themes == '["a","b"]' and row.license is None
    assert C.catalog_columns(raw(spark, CAR)).first().keywords == []
    with pytest.raises(ValueError):
        C.enrich(events, {"colour": "'red'"})


def test_package_record(spark):
    events = C.catalog_columns(C.enrich(raw(spark, CAR), {"keywords": "'k1,k2'", "contactName": "'Ann'", "packageDescription": "'d'"}))
    named = events.withColumns({"org_name": F.lit("o"), "pkg_name": F.lit("p"), "res_name": F.lit("r"), "recv_time_ts": F.lit(1)})
    record = C.package_records(named).first()
    assert (record.name, record.owner_org, record.notes, [t.name for t in record.tags]) == ("p", "o", "d", ["k1", "k2"])
    assert len(record.extras) == 10 and {e.key: e.value for e in record.extras}["contact_name"] == "Ann"
    assert C.resource_records(named).count() == 1 and C.organization_records(named).count() == 1


def test_lookup_or_create(spark):
    wanted = spark.createDataFrame(
        [("o1", "p1", "r1"), ("o1", "p1", "r2"), ("o1", "p2", "r1"), ("o2", "p1", "r1"), ("o1", "p1", "r1")],
        "org_name string, pkg_name string, res_name string")
    orgs = spark.createDataFrame([("o1",)], "org_name string")
    pkgs = spark.createDataFrame([("o1", "p1"), ("o2", "p1")], "org_name string, pkg_name string")
    ress = spark.createDataFrame([("o1", "p1", "r1", "id1"), ("o1", "p2", "r1", "x")], "org_name string, pkg_name string, res_name string, res_id string")
    got = {tuple(r[:3]): (r.create_from, r.res_id) for r in C.lookup_or_create(wanted, orgs, pkgs, ress).collect()}
    assert got == {
        ("o1", "p1", "r1"): (None, "id1"), ("o1", "p1", "r2"): ("resource", None), ("o1", "p2", "r1"): ("package", None),
        ("o2", "p1", "r1"): ("organization", None)}
    keys = ["org_name", "pkg_name", "res_name"]
    assert C.missing_records(wanted.distinct(), ress, keys).count() == 2
    assert C.known_records(wanted.distinct(), ress, keys, "res_id").count() == 2


def test_vocabularies(spark):
    assert len(vocab.format_rows()) == 86 and vocab.vocabulary(spark).filter("field = 'format'").count() == 82
    df = spark.createDataFrame([("format", "CSV"), ("format", "SHP"), ("mimetype", "text/csv"), ("availability", "soon")], "field string, value string")
    assert {r.value for r in C.check_vocabulary(df, spark, valid=False).collect()} == {"SHP", "soon"}


# -- fragments, schemas, parameters -----------------------------------------

CASES = {
    "lone": ([(None, None)], "READY", None), "full": ([("0", "2"), ("1", "2")], "READY", None), "part": ([("0", "2")], "WAIT", None),
    "no-count": ([("0", "2"), ("1", None)], "INVALID", "count-missing"), "word": ([("0", "two")], "INVALID", "count-not-an-integer"),
    "decimal": ([("0", "2.0")], "INVALID", "count-not-an-integer"), "zero": ([("0", "0")], "INVALID", "count-not-positive"),
    "differ": ([("0", "2"), ("1", "3")], "INVALID", "count-inconsistent"), "no-index": ([(None, "2")], "INVALID", "index-missing"),
    "bad-index": ([("a", "2")], "INVALID", "index-not-an-integer"), "minus": ([("-1", "2")], "INVALID", "index-negative"),
    "twice": ([("1", "2"), ("1", "2")], "INVALID", "index-duplicate"), "plus": ([("+1", "2"), ("1", "2")], "INVALID", "index-duplicate"),
}


def _fragments(spark, cases, queued=1000):
    rows = [(name, i, c, queued) for name, (pieces, _, _) in cases.items() for i, c in pieces]
    return spark.createDataFrame(rows, "fragment_identifier string, fragment_index string, fragment_count string, last_queue_ts long")


def test_fragment_status(spark):
    got = pairs(FR.fragment_status(_fragments(spark, CASES), now_ms=2000, timeout_ms=1000).select("fragment_identifier", "status", "reason"))
    assert got == {name: (status, reason) for name, (_, status, reason) in CASES.items()}
    late = pairs(FR.fragment_status(_fragments(spark, CASES), now_ms=2001, timeout_ms=1000).select("fragment_identifier", "status", "reason"))
    assert late["part"] == ("INVALID", "timeout") and late["full"] == ("READY", None)
    assert pairs(FR.fragment_status(_fragments(spark, CASES), 10**9).select("fragment_identifier", "status"))["part"] == ("WAIT",)


def test_new_columns(spark):
    assert evolve.new_columns(["a", "B"], ["A", "b", "C", "c"]) == ["b", "c"]
    grown = evolve.append(spark.sql("SELECT 1 AS a"), spark.sql("SELECT 2 AS a, 'x' AS b"))
    assert sorted(map(tuple, grown.collect())) == [(1, None), (2, "x")]


def test_catalog_table_grows(spark):
    name = "grow_" + shared_dir(spark)[-6:].replace("-", "_").replace("/", "_") + str(id(spark))
    path = f"{shared_dir(spark)}/{name}"
    spark.sql(f"CREATE TABLE {name} (a STRING) USING parquet LOCATION '{path}'")
    files.save_table(spark.sql("SELECT 'x' AS a"), name)
    evolve.add_columns(spark, name, ["b c"])
    evolve.add_columns(spark, name, [])
    files.save_table(spark.sql("SELECT 'y' AS a, 'z' AS `b c`"), name)
    assert sorted((r[0], r[1]) for r in spark.table(name).collect()) == [("x", None), ("y", "z")]
    spark.sql(f"DROP TABLE {name}")


def test_params(spark):
    given = {"cypher.param.integer.n": "3", "cypher.param.boolean.b": "TRUE", "cypher.param.float.f": "1.5", "cypher.param.string.s": "x", "other": "y"}
    assert params.typed_params(given) == {"n": 3, "b": True, "f": 1.5, "s": "x"}
    rows = H.query_text(spark, "SELECT id, :s AS s, CAST(NULL AS INT) AS z FROM range(5) WHERE id < :n", given).collect()
    assert [r.row for r in rows] == ["0,x,null", "1,x,null", "2,x,null"]


def test_page(spark):
    df = spark.range(50).withColumnRenamed("id", "_id").repartition(4)
    assert [r._id for r in H.page(df, 3, 4, F.col("_id") % 2 == 0).collect()] == [6, 8, 10, 12]
    assert [r._id for r in H.page_after(df, None, 2).collect()] == [0, 1] and [r._id for r in H.page_after(df, 7, 3).collect()] == [8, 9, 10]


# -- sinks ------------------------------------------------------------------

@pytest.fixture
def out(spark, tmp_path):
    return str(tmp_path / "out")


def test_shared_table(spark, out):
    df = spark.range(100).select(
        F.concat(F.lit("db"), (F.col("id") % 2).cast("string")).alias("dest_db"), F.concat(F.lit("t"), (F.col("id") % 5).cast("string")).alias("dest_table"),
        (F.col("id") * 3_600_000).alias(M.RECV_TIME_TS))
    files.append_table(files.with_day(df), out)
    files.append_table(files.with_day(df.withColumn("extra", F.lit("x"))), out)
    back = files.read_table(spark, out)
    assert back.count() == 200 and back.filter("extra = 'x'").count() == 100
    files.destination_view(back, "one_dest", "db1", "t3")
    view = spark.table("one_dest")
    assert view.count() == 20
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "dest_db" in plan.split("PartitionFilters: [")[1].split("]")[0] and "EqualTo(dest_table,t3)" in plan
    assert "RebalancePartitions" in files.clustered(df, ["dest_db"], [])._jdf.queryExecution().optimizedPlan().toString()


def test_export_by_destination(spark, out):
    df = spark.createDataFrame([("a/b", "1"), ("a/b", "2"), ("c", "3")], "dest_folder string, line string")
    files.export_by_destination(df, out)
    assert spark.read.text(out).count() == 3


def test_clusters_need_a_shared_folder(monkeypatch):
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)
            set = staticmethod(lambda key, value: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session)
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        shared_dir(Session)


def test_external_table(spark, out):
    spark.createDataFrame([("a", 1), ("b", 2)], "s string, n int").write.csv(out)
    files.external_table(spark, "ext_csv", out, spark.sql("SELECT '' AS s, 0 AS n").schema, "csv-row")
    assert spark.table("default.ext_csv").agg(F.sum("n")).first()[0] == 3
    spark.sql("DROP TABLE default.ext_csv")
    with pytest.raises(ValueError):
        files.external_table(spark, "x", out, "a INT", "cvs-row")


def test_scratch_removes_what_it_stored(spark):
    with scratch(spark):
        path = store(spark.range(3), "gone").inputFiles()[0].rsplit("/", 1)[0]
    kept = store(spark.range(3), "kept")
    assert runtime.read_or_none(spark, path) is None and kept.count() == 3


# -- streams ----------------------------------------------------------------

def _land(spark, folder, *bodies):
    """One file per body, each its own micro-batch."""
    import pathlib

    pathlib.Path(folder).mkdir(parents=True, exist_ok=True)
    for i, body in enumerate(bodies):
        line = {"headers": {M.HEADER_SERVICE: "web", M.HEADER_SERVICE_PATH: "/p"}, "body": body if isinstance(body, str) else json.dumps(body),
                "ingest_ts": f"2024-01-01T00:00:{i:02d}.000Z"}
        (pathlib.Path(folder) / f"{i:03d}.json").write_text(json.dumps(line) + "\n")


def _body(i, value):
    return {"data": [{"id": f"e{i}", "type": "T", "x": {"type": "Number", "value": value, "metadata": {}}}]}


def _run(stream, write, out):
    runtime.start(stream, write, out, f"{out}/checkpoint", every=None).awaitTermination()


def test_ingest_stream(spark, tmp_path, out):
    _land(spark, tmp_path / "in", _body(1, 5), "{broken", _body(2, 6))
    stream = NS.stream_envelopes(spark, str(tmp_path / "in"), max_files=1)
    _run(stream, SH.history_writer(out, "mysql", Options()), out)
    rows = runtime.read_committed(spark, out, "history")
    assert sorted((r.entityId, r.attrValue, r.dest_table) for r in rows.collect()) == [
        ("e1", "5", "x002fpxffffe1xfffft"), ("e2", "6", "x002fpxffffe2xfffft")]
    assert [r.body for r in runtime.read_committed(spark, out, "dead_letter").collect()] == ["{broken"]
    assert spark.read.parquet(f"{out}/commits").count() == 3
    # nothing is read twice when the job starts again, and a repeated batch replaces itself
    _run(stream, SH.history_writer(out, "mysql", Options()), out)
    SH.history_writer(out, "mysql", Options())(NS.read_envelopes(spark, str(tmp_path / "in" / "000.json")), 0)
    assert runtime.read_committed(spark, out, "history").count() == 2


def test_bodies_read_as_text(spark, tmp_path):
    _land(spark, tmp_path / "in", "x")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "one.json").write_text('{\n"data": []}')
    assert NS.read_bodies(spark, str(tmp_path / "b"), {"a": "b"}, one_per_file=True).first().body == '{\n"data": []}'
    assert NS.stream_bodies(spark, str(tmp_path / "b"), max_files=1).columns == ["headers", "body", "ingest_ts"]


def test_faults_are_routed_and_other_errors_raised(spark, out):
    long = "no " * 2000

    def broken(batch, batch_id):
        raise (ValueError if batch_id == 1 else OSError)(long)

    assert runtime.run_batch(spark.range(2), 0, lambda b, i: None, out, (ValueError,)) == runtime.SUCCESS
    assert runtime.run_batch(spark.range(2), 1, broken, out, (ValueError,)) == runtime.FAILURE
    for faults in ((ValueError,), ()):
        with pytest.raises(OSError):
            runtime.run_batch(spark.range(2), 2, broken, out, faults)
    assert [r.error for r in spark.read.parquet(f"{out}/failed").collect()] == [long] * 2
    routes = {r.batch_id: (r.route, r.error) for r in spark.read.parquet(f"{out}/commits").collect()}
    assert routes == {0: ("success", None), 1: ("failure", "ValueError")}


def test_failed_batches_are_not_read(spark, out):
    def half(batch, batch_id):
        files.write_batch(batch, f"{out}/history", batch_id)
        if batch_id == 1:
            raise ValueError("after the first write")

    for i in range(3):
        runtime.run_batch(spark.range(2), i, half, out, (ValueError,))
    assert {r.batch_id for r in runtime.read_committed(spark, out, "history").collect()} == {0, 2}


def test_jobs_with_state_leave_out_no_batch(spark, out):
    for write in (SF.fragment_writer(out), ST.trajectory_writer(out)):
        for routes in ({"faults": (ValueError,)}, {"transient": (OSError,)}):
            with pytest.raises(ValueError, match="state"):
                runtime.run_batch(spark.range(1), 0, write, out, **routes)


def test_failing_rows_are_told_apart(spark, out):
    attempts = []

    def write(batch, batch_id):
        attempts.append(batch_id)
        files.write_batch(batch.select("id", F.col("text").cast("int").alias("n")), f"{out}/history", batch_id)

    bad = {3, 4711, 9998}
    text = F.when(F.col("id").isin(*bad), "x").otherwise(F.col("id").cast("string"))
    rows = spark.range(10_000).select("id", text.alias("text"), F.create_map(F.lit("k"), F.col("id")).alias("m"), F.lit(1).alias("_content"))
    assert runtime.run_batch(rows, 4, write, out, (NumberFormatException,)) == runtime.SUCCESS
    stored = runtime.read_committed(spark, out, "history")
    assert stored.count() == 9_997 and stored.filter(F.col("id").isin(*bad)).isEmpty()
    failed = runtime.read_committed(spark, out, "failed")
    assert {r.id for r in failed.collect()} == bad and set(failed.columns) == {"batch_id", "id", "text", "m", "_content", "error"}
    assert all("'x'" in r.error for r in failed.collect())
    assert len(attempts) <= 2 + 2 * len(bad) * 15


def test_foreseen_rows_are_told_apart_in_one_pass(spark, out):
    attempts = []

    def write(batch, batch_id):
        attempts.append(batch_id)
        files.write_batch(batch.select("id", F.col("text").cast("int").alias("n")), f"{out}/history", batch_id)

    # 200 rows that the handler knows of, more than are told apart by halving, and one that it does not.
    write.reason = lambda batch: F.when(F.col("text") == "x", "an x")
    text = F.when(F.col("id") % 50 == 3, "x").when(F.col("id") == 4711, "y").otherwise(F.col("id").cast("string"))
    rows = spark.range(10_000).select("id", text.alias("text"), F.lit("e").alias("_error"))
    assert runtime.run_batch(rows.filter("id <> 4711"), 0, write, out, (NumberFormatException,)) == runtime.SUCCESS
    assert len(attempts) == 2
    assert runtime.run_batch(rows, 1, write, out, (NumberFormatException,)) == runtime.SUCCESS
    assert runtime.run_batch(rows.filter("id = 3"), 2, write, out, (NumberFormatException,)) == runtime.FAILURE
    stored = runtime.read_committed(spark, out, "history").groupBy("batch_id").count().collect()
    assert {(r.batch_id, r["count"]) for r in stored} == {(0, 9_799), (1, 9_799)}
    failed = spark.read.parquet(f"{out}/failed")
    assert set(failed.columns) == {"batch_id", "id", "text", "_error", "error"}
    assert failed.filter("error = 'an x' AND text = 'x'").count() == 401 and failed.filter("error LIKE '%y%'").count() == 1


def test_rows_that_only_fail_together_go_together(spark, out):
    def write(batch, batch_id):
        if batch.filter("id in (1, 2)").count() == 2:
            raise ValueError("both")

    rows = spark.range(4).withColumn("h", F.col("id"))
    found = runtime.isolate(rows, "h", lambda part: write(part, 0), (ValueError,), ValueError("both"))
    assert [(low, high) for low, high, _ in found] == [(0, 3)]
    monkey = runtime.MAX_ISOLATED
    try:
        runtime.MAX_ISOLATED = 2

        def always(part):
            raise ValueError("never")

        found = runtime.isolate(spark.range(64).withColumn("h", F.col("id")), "h", always, (ValueError,), ValueError("never"))
        assert sum(high - low + 1 for low, high, _ in found) == 64 and len(found) < 16
    finally:
        runtime.MAX_ISOLATED = monkey


def test_errors_that_pass_are_tried_again(spark, out):
    calls = []

    def write(batch, batch_id):
        calls.append(batch_id)
        files.write_batch(batch, f"{out}/history", batch_id)
        if batch_id == 0 and len(calls) < 2 or batch_id == 1 and len(calls) < 7:
            raise OSError("busy")

    assert runtime.run_batch(spark.range(2), 0, write, out, transient=(OSError,)) == runtime.SUCCESS
    assert runtime.run_batch(spark.range(3), 1, write, out, transient=(OSError,)) == runtime.RETRY
    assert {r.batch_id for r in runtime.read_committed(spark, out, "history").collect()} == {0}
    assert runtime.replay(spark, out, write, transient=(OSError,)) == {1: runtime.SUCCESS}
    assert runtime.read_committed(spark, out, "history").count() == 5 and runtime.batches(spark, f"{out}/retry") == []
    with pytest.raises(OSError):
        runtime.run_batch(spark.range(1), 2, lambda b, i: (_ for _ in ()).throw(OSError()), out)


FRAGMENTS = "fragment_identifier string, fragment_index string, fragment_count string, last_queue_ts long"


def _land_rows(spark, folder, number, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{number}")


def _assembled(spark, tmp_path, out, timeout_ms=None):
    stream = spark.readStream.schema(FRAGMENTS).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    runtime.start(SF.assemble(stream, timeout_ms, held=2), SF.fragment_writer(out), out, f"{out}/checkpoint", every=None).awaitTermination()


def test_fragments_wait_over_batches_and_restarts(spark, tmp_path, out):
    many = [("m", str(i), "9", 1) for i in range(9)]
    parts = [
        [("a", "0", "2", 0), ("b", "0", "1", 0), ("lone", None, None, 0), ("bad", "0", "2", 0), ("bad", "0", "2", 0), *many[:5]],
        [("a", "1", "2", 0), ("c", "0", "2", 1), ("bad", "1", "2", 0), ("two", None, None, 0), ("two", "0", None, 0)],
        [("d", "0", "1", 0), *many[5:], ("e", "x", "1", 0), ("f", "0", "2", 0), ("f", "1", "3", 0)],
    ]
    for number, rows in enumerate(parts):
        _land_rows(spark, tmp_path / "in", number, rows, FRAGMENTS)
        _assembled(spark, tmp_path, out)
    ready = {(r.batch_id, r.fragment_identifier, r.fragment_index) for r in runtime.read_committed(spark, out, "ready").collect()}
    assert ready == {(0, "b", "0"), (0, "lone", None), (1, "a", "0"), (1, "a", "1"), (2, "d", "0"), *((2, "m", str(i)) for i in range(9))}
    broken = sorted((r.fragment_identifier, r.reason) for r in runtime.read_committed(spark, out, "invalid").collect())
    assert broken == [("bad", "index-duplicate")] * 3 + [("e", "index-not-an-integer")] + [("f", "count-inconsistent")] * 2 + [("two", "count-missing")] * 2


def test_transactions_of_one_group_share_its_state(spark, tmp_path, out):
    # Forty transactions of three fragments in a group; fragment i of transaction t comes in batch (i * t) % 3.
    pieces = [(f"t{t}", str(i), "3", (i * t) % 3) for t in range(40) for i in range(3)] + [("never", "0", "2", 0)]
    for number in range(3):
        _land_rows(spark, tmp_path / "in", number, [p for p in pieces if p[3] == number], FRAGMENTS)
        stream = spark.readStream.schema(FRAGMENTS).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        job = SF.assemble(stream, held=5, groups=1)
        runtime.start(job, SF.fragment_writer(out), out, f"{out}/checkpoint", every=None).awaitTermination()
    ready = {(r.batch_id, r.fragment_identifier, r.fragment_index) for r in runtime.read_committed(spark, out, "ready").collect()}
    assert ready == {(0 if t % 3 == 0 else 2, f"t{t}", str(i)) for t in range(40) for i in range(3)}
    kept = spark.read.format("statestore").option("stateVarName", "summary").load(f"{out}/checkpoint")
    assert [r.key[0] for r in kept.collect()] == [0] and runtime.read_committed(spark, out, "invalid").isEmpty()


def test_waiting_fragments_expire_without_a_further_batch(spark, tmp_path, out):
    import time

    _land_rows(spark, tmp_path / "in", 0, [("a", "0", "2", 0), ("b", "0", "1", 0)], FRAGMENTS)
    stream = spark.readStream.schema(FRAGMENTS).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    query = runtime.start(SF.assemble(stream, 1_000), SF.fragment_writer(out), out, f"{out}/checkpoint", every="1 second")
    try:
        end = time.time() + 60
        while time.time() < end:
            late = runtime.read_or_none(spark, f"{out}/invalid")
            if late is not None and late.count():
                break
            time.sleep(1)
    finally:
        query.stop()
    assert [(r.fragment_identifier, r.reason) for r in late.collect()] == [("a", "timeout")]
    assert [r.fragment_identifier for r in runtime.read_committed(spark, out, "ready").collect()] == ["b"]


def _bucket_rows(batch):
    from chronoctx.operators import parse as P

    return P.attribute_rows(P.parse(batch)).select("attr_name", "recv_time_ts", F.col("attr_value").cast("double").alias("value"))


def test_bucket_stream_with_compaction(spark, tmp_path, out):
    _land(spark, tmp_path / "in", *[_body(i, i) for i in range(5)])
    _run(NS.stream_envelopes(spark, str(tmp_path / "in"), 1), SB.bucket_writer(out, _bucket_rows, ["attr_name"], resolutions=("second", "minute")), out)
    before = SB.read_buckets(spark, out, ["attr_name"])
    minute = before.filter("resolution = 'minute'").first()
    assert (minute.samples, minute["sum"], minute.sum2, minute["max"]) == (5, 10.0, 30.0, 4.0)
    want = sorted(map(str, before.collect()))
    SB.compact(spark, out, ["attr_name"], 2)
    assert sorted(map(str, SB.read_buckets(spark, out, ["attr_name"]).collect())) == want


def test_compaction_stops_before_a_waiting_batch(spark, out):
    partial = SB.B.numeric_buckets(spark.createDataFrame([("a", 1_000, 2.0)], "attr_name string, recv_time_ts long, value double"), ["attr_name"], resolutions=("day",))
    routes = ["success", "success", "retry", "success", None]
    for number, route in enumerate(routes):
        files.write_batch(partial, f"{out}/partials", number)
        if route:
            files.write_batch(spark.createDataFrame([(route,)], "route string"), f"{out}/commits", number)
    files.write_batch(partial, f"{out}/retry", 2)
    read = lambda: [r.samples for r in SB.read_buckets(spark, out, ["attr_name"]).collect()]
    assert read() == [3]
    assert [SB.compact(spark, out, ["attr_name"], upto) for upto in (0, 3)] == [0, 1] and read() == [3]
    files.write_batch(spark.createDataFrame([("success",)], "route string"), f"{out}/commits", 2)
    assert read() == [4]


POINTS = "dest string, seq long, recv_time_ts long, lon double, lat double, stage_distance double"


@pytest.mark.parametrize("scale", [None, 3])
def test_trajectory_stream_over_restarts(spark, tmp_path, out, scale):
    from chronoctx.operators import trajectory as TR

    rows = [("a" if i % 3 else "b", i, i // 2 * 1000, i * 7.0 % 360 - 180, i * 5.0 % 180 - 90, 5.25 if i % 10 == 4 else None) for i in range(60)]
    want = TR.trajectory(spark.createDataFrame(rows, POINTS), ["dest"], "seq", scale=scale)
    for number in range(3):
        part = [r for r in rows if r[1] // 20 == number]
        _land_rows(spark, tmp_path / "in", number, part[::-1] if number else part[::2] + part[1::2], POINTS)
        stream = spark.readStream.schema(POINTS).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        job = ST.trajectory_stream(stream, ["dest"], "seq", scale=scale)
        runtime.start(job, ST.trajectory_writer(out), out, f"{out}/checkpoint", every=None).awaitTermination()
    got = {r.seq: r.asDict() for r in runtime.read_committed(spark, out, "trajectory").drop("batch_id").collect()}
    expected = {r.seq: r.asDict() for r in want.collect()}
    assert set(got) == set(expected) == set(range(60)) and set(got[0]) == set(expected[0])
    for seq, row in expected.items():
        for name, value in row.items():
            assert got[seq][name] == (pytest.approx(value, rel=1e-12) if isinstance(value, float) else value), (seq, name)
