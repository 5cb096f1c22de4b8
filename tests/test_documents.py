"""Bucket documents: forms, merging, stored tables, time to live; side files."""

import pytest
from pyspark.sql import functions as F

from chronoctx import options as O
from chronoctx.operators import buckets as B
from chronoctx.operators import documents as D
from chronoctx.plans.session import shared_dir
from chronoctx.sinks import files
from chronoctx.sinks import versions as V

ROWS = "service_path string, entity_id string, entity_type string, attr_name string, attr_type string, recv_time_ts long, value double, text string"
DAY = 86_400_000


def rows(spark, *given):
    return spark.createDataFrame([("/p", e, "T", "a", kind, ts, v, t) for e, kind, ts, v, t in given], ROWS)


@pytest.fixture
def root(spark, tmp_path):
    shared_dir(spark)
    return str(tmp_path / "store")


@pytest.mark.parametrize("model, fields", [
    (O.BY_SERVICE_PATH, ["entityId", "entityType", "attrName"]), (O.BY_ENTITY, ["attrName"]), (O.BY_ATTRIBUTE, [])])
def test_the_id_follows_the_model(spark, model, fields):
    df = D.numeric_documents(rows(spark, ("e", "N", DAY, 1.0, "x"), ("e", "M", DAY + 9, 2.0, "x")), model, resolutions=("day",))
    assert df.schema["_id"].dataType.fieldNames() == [*fields, "origin", "resolution", "range"]
    (doc,) = df.collect()
    assert doc.attrType == "M" and [p.offset for p in doc.points] == list(range(1, 32))
    assert (doc.points[1].samples, doc.points[1]["sum"], doc.points[0].min, doc.points[0].max) == (2, 3.0, float("inf"), float("-inf"))
    with pytest.raises(ValueError):
        D.collection_keys("db-by-colour")


def test_empty_tables_and_new_documents(spark):
    one = D.numeric_documents(rows(spark, ("e", "N", DAY, 1.0, "x")), resolutions=("hour",))
    none = D.numeric_documents(rows(spark).limit(0), resolutions=("hour",))
    want = [tuple(r) for r in one.collect()]
    assert [tuple(r) for r in D.merge_documents(none, one).collect()] == want
    assert [tuple(r) for r in D.merge_documents(one, none).collect()] == want
    assert D.merge_documents(none, none).count() == 0


def test_occurrences_add_up_by_value(spark):
    a = D.categorical_documents(rows(spark, ("e", "N", DAY, None, "x"), ("e", "N", DAY, None, "y")), value="text", resolutions=("day",))
    b = D.categorical_documents(rows(spark, ("e", "N", DAY + 1, None, "y"), ("e", "O", 2 * DAY, None, "z")), value="text", resolutions=("day",))
    (doc,) = D.merge_documents(a, b).collect()
    assert (doc.attrType, doc.points[1].occur, doc.points[1].samples, doc.points[2].occur, doc.points[5].occur) == ("O", {"x": 1, "y": 2}, 3, {"z": 1}, {})


def test_upserts_leave_other_files_alone(spark, root):
    def batch(*entities, at=DAY):
        return D.numeric_documents(rows(spark, *[(e, "N", at, 1.0, "x") for e in entities]), resolutions=("hour",))

    D.upsert(spark, root, "t", batch("a", "b"), token="0")
    D.upsert(spark, root, "t", batch("c", at=9 * DAY), token="1")
    before = {r.path for r in V.file_list(spark, root).collect()}
    version = D.upsert(spark, root, "t", batch("c", "d", at=9 * DAY), token="2")
    assert D.upsert(spark, root, "t", batch("c", "d", at=9 * DAY), token="2") == version
    after = {r.path for r in V.file_list(spark, root).collect()}
    assert len(before) == 2 and len(before & after) == 1
    samples = {r.entity_id: sum(p.samples for p in r.points) for r in V.read(spark, root, "t").collect()}
    assert samples == {"a": 1, "b": 1, "c": 2, "d": 1}
    D.drop_expired(spark, root, "t", 10 * DAY, 5 * 86_400)
    assert {r.entity_id for r in V.read(spark, root, "t").collect()} == {"c", "d"}
    assert D.retain_documents(batch("a"), 10 * DAY, 5 * 86_400).count() == 0
    with pytest.raises(V.Conflict):
        V.commit(spark, root, {"t": D._placed(batch("z"))}, partitions=("resolution",), order=(), based_on=1)


def test_batches_equal_one_run(spark, root):
    given = [(f"e{i % 3}", "N", i * 7_000_000, float(i), "x") for i in range(40)]
    for part in range(3):
        D.upsert(spark, root, "t", D.numeric_documents(rows(spark, *given[part::3]), resolutions=B.ALL_RESOLUTIONS))
    stored = V.read(spark, root, "t").select("entity_id", "_id", F.to_json("points")).collect()
    want = D.numeric_documents(rows(spark, *given)).select("entity_id", "_id", F.to_json("points")).collect()
    assert sorted(map(str, stored)) == sorted(map(str, want))


def test_side_files_quote_what_they_must(spark, tmp_path):
    item = F.struct(F.lit("f,1").alias("md_file"), F.lit('say "x"').alias("value"))
    df = spark.range(3).select(F.lit("db").alias("dest_db"), "id", F.lit("").alias("text"), F.when(F.col("id") > 0, F.array(item)).otherwise(F.array()).alias("metadata"))
    files.append_csv_with_metadata(df, str(tmp_path / "out"))
    part = {p: files.read_csv_part(spark, str(tmp_path / "out"), p, s) for p, s in (("rows", "id long, text string"), ("metadata", "md_file string, value string"))}
    assert sorted(r.id for r in part["rows"].collect()) == [0, 1, 2]
    got = part["metadata"].collect()
    assert [r.md_file for r in got] == ["f,1"] * 2
