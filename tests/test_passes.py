"""Expensive steps are taken once: parsing, naming, aggregating, looking up."""

import pytest
from pyspark.sql import functions as F

from chronoctx.functions import encode as E
from chronoctx.operators import catalog as C
from chronoctx.operators import documents as D
from chronoctx.operators import layout as L
from chronoctx.operators import naming as N
from chronoctx.operators import parse as P
from chronoctx.plans import queries as Q
from chronoctx.plans.session import shared_dir
from chronoctx.sinks import ids as IDS

AWKWARD = [
    None, "", "plain", "Ab.c-d_e/f=g$h i\\j\"k", "x00ff=x12 x00FFx", "\u0000", "a\u0000=B", "é😀.😀-É", "\n/\r x0000", "==..--__//", "😀ab/.-",
]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_encoders_in_steps(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(AWKWARD)], "i int, s string")
    stepped, kinds = E.encode_steps(df, "s")
    assert set(kinds) == set(E.DENIED)
    same = [value.eqNullSafe(E.encode(F.col("s"), kind)).alias(kind) for kind, value in kinds.items()]
    assert [(r.i, k) for r in stepped.select("i", *same).collect() for k in kinds if not r[k]] == []


def test_old_encoders_in_steps(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(AWKWARD)], "i int, s string")
    s = F.col("s")
    want = {
        "old": E.encode_old(s), "old_path": E.encode_old(s, encode_slash=False), "old_table": E.encode_old(s, delete_slash=True),
        "ld_table": E.encode_ld_table(s), "sth_database": E.encode_sth_database(s), "sth_collection": E.encode_sth_collection(s),
    }
    stepped, got = E.encode_old_steps(df, "s")
    same = stepped.select("i", *[got[k].eqNullSafe(want[k]).alias(k) for k in want]).collect()
    assert [(r.i, k) for r in same for k in want if not r[k]] == []


def test_attributes_and_sub_attributes_in_one_pass(spark, sf_dir):
    assert "Union" not in _plan(Q.ld_attribute_rows(spark, sf_dir))


def test_documents_of_all_models_from_one_aggregation(spark):
    rows = spark.createDataFrame(
        [("/p", "e", "T", "a", "N", 5, 1.0), ("/p", "e", "T", "a", "M", None, 2.0), ("/p", "e", "T", "a", "M", 7, 3.0)],
        "service_path string, entity_id string, entity_type string, attr_name string, attr_type string, recv_time_ts long, value double")
    dense = D.dense_numeric(rows, resolutions=("hour",))
    assert "Join" not in _plan(dense)
    (doc,) = D.document(dense, "db-by-entity").collect()
    assert doc.attrType == "M" and sum(p.samples for p in doc.points) == 2


def test_rows_to_number_are_computed_once(spark, tmp_path):
    shared_dir(spark)
    seen = spark.sparkContext.accumulator(0)

    def row(i):
        seen.add(1)
        return ("d", i, 86_400_000 + i)

    rows = spark.createDataFrame(spark.sparkContext.parallelize(range(50), 2).map(row), "dest string, n long, ms long")
    IDS.append_with_ids(spark, str(tmp_path / "s"), "t", rows, ["dest"], ["n"], partitions=(), order=("dest",), time_ms="ms")
    assert seen.value == 50


def test_hdfs_rows_are_named_by_entity(spark, sf_dir, monkeypatch):
    given, real = [], N.hdfs_names
    monkeypatch.setattr(N, "hdfs_names", lambda df, *more: given.append(df.columns) or real(df, *more))
    Q.hdfs_csv_row_side_files(spark, sf_dir)
    assert given and all("attr_name" not in columns for columns in given)


@pytest.mark.parametrize("query", [Q.v2_rejects, Q.v2_discovered_columns])
def test_what_is_used_twice_is_parsed_once(spark, sf_dir, query):
    assert [f for f in query(spark, sf_dir).inputFiles() if "events.parquet" in f] == []


def test_side_files_are_named_once(spark, sf_dir):
    calls = []

    def md_file(attribute):
        calls.append(attribute)
        return attribute["name"]

    L.csv_column_layout(Q.event_entities(spark, sf_dir), ["value", "kind"], "u", md_file, side=True)
    assert len(calls) == 2


def test_catalogue_metadata_is_evaluated_once(spark):
    df = spark.createDataFrame([({"FORMAT": "x", "a": "b"},)], "headers map<string,string>")
    out = C.enrich(df, {"format": "concat('zz', 'y', size(headers))", "version": "CAST(NULL AS STRING)"})
    assert out._jdf.queryExecution().analyzed().toString().count("zz") == 1
    assert out.first().headers == {"a": "b", "format": "zzy2"}


def test_equal_headers(spark):
    maps = ["map('A', '1', 'a', '2', 'b', '3')", "map('A', '1', 'b', NULL)", "CAST(map() AS map<string,string>)", "CAST(NULL AS map<string,string>)"]
    got = [spark.range(1).select(P.lower_headers(F.expr(m))).first()[0] for m in maps]
    assert got == [{"a": "1", "b": "3"}, {"a": "1", "b": None}, {}, None]


@pytest.mark.parametrize("query", [Q.trajectory_moments, Q.trajectory_ellipsoid])
def test_points_are_stored_with_what_is_used(spark, sf_dir, query):
    files = query(spark, sf_dir).inputFiles()
    assert files and spark.read.parquet(files[0]).columns == Q._PATH
