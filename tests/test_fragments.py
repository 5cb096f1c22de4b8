"""Fragments meet the state of a stream in blocks, and none is lost in it."""

import pyarrow as pa
import pytest

from chronoctx.operators import fragments as FR
from chronoctx.plans.session import shared_dir
from chronoctx.streaming import fragments as SF
from chronoctx.streaming import runtime

ROWS = "fragment_identifier string, fragment_index string, fragment_count string, last_queue_ts long"


@pytest.fixture
def out(spark, tmp_path):
    shared_dir(spark)
    return str(tmp_path / "out")


def run(spark, folder, out, number, rows, **settings):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{folder}/{number}")
    stream = spark.readStream.schema(ROWS).option("recursiveFileLookup", True).parquet(folder)
    runtime.start(SF.assemble(stream, **settings), SF.fragment_writer(out), out, f"{out}/checkpoint", every=None).awaitTermination()


def given(spark, out):
    ready, invalid = (runtime.read_committed(spark, out, table) for table in ("ready", "invalid"))
    rows = ready.unionByName(invalid).select("batch_id", "fragment_identifier", "fragment_index", "reason")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_what_stays_while_others_leave_is_found_again(spark, tmp_path, out):
    # Of each pair of transactions one is complete in batch 1, the other begins there.
    for number in range(3):
        rows = [(f"{'ab'[late]}{t}", str(i), "2", 0) for t in range(20) for late in range(2) for i in range(2) if late + i == number]
        run(spark, str(tmp_path / "in"), out, number, rows, held=7, groups=1)
    want = [(late + 1, f"{'ab'[late]}{t}", str(i), None) for t in range(20) for late in range(2) for i in range(2)]
    assert given(spark, out) == sorted(want, key=repr)
    assert spark.read.format("statestore").option("stateVarName", "waiting").load(f"{out}/checkpoint").isEmpty()


CASES = [("lone", None, None), ("two", None, None), ("two", "0", None), ("bad", "0", "2"), ("bad", "0", "2"), ("word", "0", "x"), ("none", "0", "0"),
         ("mixed", "0", "2"), ("mixed", "1", "3"), ("first", "-1", "x"), ("no", None, "1"), ("text", "x1", "1"), ("minus", "-1", "1"), (None, "0", "2"), (None, "1", "2"),
         ("+", "+0", "+2"), ("+", "01", "2"), ("big", "0", "99999999999"), ("many", "0", "1"), ("many", "1", "1"), ("waits", "1", "2"), ("", "0", "1")]


@pytest.mark.parametrize("held", [1, 3, 100])
def test_one_batch_is_judged_as_a_table_is(spark, tmp_path, out, held):
    rows = [(*case, 0) for case in CASES]
    run(spark, str(tmp_path / "in"), out, 0, rows, held=held, groups=2)
    status = FR.fragment_status(spark.createDataFrame(rows, ROWS), 10**9)
    want = {r.fragment_identifier: (r.status, r.reason) for r in status.collect() if r.status != FR.WAIT}
    got = given(spark, out)
    assert {name: ("READY" if reason is None else "INVALID", reason) for _, name, _, reason in got} == want
    assert [row[1:3] for row in got] == sorted(((n, i) for n, i, _ in CASES if n in want), key=lambda r: repr((0, *r)))


def test_fragments_of_a_group_come_in_few_rows(spark):
    rows = [(f"t{i % 500}", str(i), "9", 0) for i in range(20_000)]
    pieces = spark.createDataFrame(rows, ROWS)
    schema = SF.pieces_schema(pieces.schema)
    seen = pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(zip(*rows), schema)), *(pa.array([0] * len(rows), pa.int32()) for _ in range(3)),
                                       pa.array([i % 500 % 4 for i in range(len(rows))], pa.int64())], [*schema.names, "_group"])
    (blocks,) = SF.dealt((seen.slice(start, 1000) for start in range(0, len(rows), 1000)), schema, 4000)
    assert blocks.column(0).to_pylist() == [0, 0, 1, 1, 2, 2, 3, 3]
    back = [SF._unpacked(b.as_buffer(), schema) for b in blocks.column(1)]
    assert [b.num_rows for b in back] == [4000, 1000] * 4
    assert sorted(r["fragment_index"] for b in back for r in b.to_pylist()) == sorted(str(i) for i in range(20_000))


def test_a_repeated_batch_replaces_both_tables(spark, out):
    write = SF.fragment_writer(out)
    rows = [("a", "READY", None), ("b", "INVALID", "timeout")]
    for batch in (rows, rows[:1], rows[1:], []):
        write(spark.createDataFrame(batch, "fragment_identifier string, status string, reason string"), 3)
        for status, table in (("READY", "ready"), ("INVALID", "invalid")):
            stored = spark.read.parquet(f"{out}/{table}/batch_id=3")
            assert stored.columns == ["fragment_identifier", "reason"]
            assert [tuple(r) for r in stored.collect()] == [(n, why) for n, s, why in batch if s == status]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


WIDE = ("fragment_identifier long, fragment_index string, fragment_count string, at timestamp, day date, money decimal(20,3), bytes binary, "
        "list array<string>, map map<string,int>, struct struct<a:int,b:array<double>>, flag boolean")


def test_fragments_keep_their_other_columns(spark, tmp_path, out):
    import datetime as dt
    from decimal import Decimal

    def row(name, i, n):
        return (name, str(i), n, dt.datetime(2024, 1, 2, 3, 4, 5, 6), dt.date(2024, 1, 2), Decimal("1.250"), bytearray(b"\x00\xff"), ["a", None],
                {"k": i, "none": None}, (i, [0.5, None]), None) if i % 2 else (name, str(i), n, *[None] * 8)

    rows = [row(name, i, "4") for name in (1, 2, -(1 << 62)) for i in range(4)] + [row(5, 1, "x")]
    for number in range(2):
        part = [r for r in rows if int(r[1]) // 2 == number]
        spark.createDataFrame(part, WIDE).coalesce(1).write.parquet(str(tmp_path / "in" / str(number)))
        stream = spark.readStream.schema(WIDE).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        runtime.start(SF.assemble(stream, held=2, groups=1), SF.fragment_writer(out), out, f"{out}/checkpoint", every=None).awaitTermination()
    stored = runtime.read_committed(spark, out, "ready").unionByName(runtime.read_committed(spark, out, "invalid")).drop("batch_id", "reason")
    assert stored.schema == spark.createDataFrame([], WIDE).schema
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, spark.createDataFrame(rows, WIDE).collect()))
