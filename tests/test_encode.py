"""Encoders, names and times against known values."""

import pytest
from pyspark.sql import functions as F

from chronoctx import options as O
from chronoctx.functions import encode as E
from chronoctx.functions import sql as SQL
from chronoctx.functions import times as T
from chronoctx.operators import naming as N
from chronoctx.options import Options

TEXTS = {
    "postgresql": {
        "/somePath": "x002fsomex0050ath", "someService": "somex0053ervice", "a=b": "axffffb", "x002fq": "xx002fq",
        "xyz": "xyz", "é": "x00e9", "": "", "😀": "xd83dxde00", "x12": "x12", "axABCDz": "axxx0041x0042x0043x0044z",
        "a 😀😀b é\n": "ax0020xd83dxde00xd83dxde00bx0020x00e9x000a", "==": "xffffxffff", " ": "x0020",
    },
    "mysql": {"/somePath": "x002fsomePath", "someService": "someService"},
    "mongo_database": {"Sth.a$b": "x0053thx002eax0024b", 'a/b\\c"d=': "ax002fbx005ccx0022dxffff", "a b": "a b"},
    "mongo_collection": {"Sth.a$b/": "Sth.ax0024bx002f", "a=b": "axffffb"},
    "hdfs": {"a/b=c": "ax002fbxffffc"},
    "hdfs_path": {"/a/b=c": "/a/bxffffc"},
    "dynamo": {"a.b-c_d e": "a.b-c_dx0020e"},
    "ckan": {"a.b-C_d": "ax002eb-x0043_d"},
}


def _one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column).first()[0]


@pytest.mark.parametrize("kind", sorted(TEXTS))
def test_reversible_encoders(spark, kind):
    df = spark.createDataFrame(list(TEXTS[kind].items()), "s string, want string")
    bad = df.withColumn("got", E.encode(F.col("s"), kind)).filter("got <> want").collect()
    assert bad == []


def test_null_stays_null(spark):
    assert _one(spark, E.encode_postgresql(F.col("s")), s=None) is None


def test_old_encoders(spark):
    s = F.col("s")
    assert _one(spark, E.encode_old(s, delete_slash=True), s="/some Path/x") == "some_Path_x"
    assert _one(spark, E.encode_old(s), s="/a.b-c_d") == "_a.b-c_d"
    assert _one(spark, E.encode_old(s, encode_slash=False), s="/a b") == "/a_b"
    assert _one(spark, E.encode_ld_table(s), s="urn:a/b.c") == "urn_a/b_c"
    assert _one(spark, E.encode_sth_database(s), s='this\\is/a$pre.fix "x=') == "this_is_a_pre_fix__x_"
    assert _one(spark, E.encode_sth_collection(s), s="a/b$c=d") == "a/b_c_d"


def _names(spark, namer, path="/somePath", eid="someId", etype="someType", attr="someName", service="someService", **opts):
    df = spark.createDataFrame(
        [(service, path, eid, etype, attr)],
        "service string, service_path string, entity_id string, entity_type string, attr_name string",
    )
    return namer(df, Options(**{"enable_lowercase": False, **opts})).first().asDict()


PATH, ENTITY, ATTRIBUTE = O.BY_SERVICE_PATH, O.BY_ENTITY, O.BY_ATTRIBUTE

TABLES = [
    (N.postgresql_names, PATH, "/somePath", False, "somePath"),
    (N.postgresql_names, PATH, "/somePath", True, "x002fsomex0050ath"),
    (N.postgresql_names, ENTITY, "/somePath", False, "somePath_someId_someType"),
    (N.postgresql_names, ENTITY, "/somePath", True, "x002fsomex0050athxffffsomex0049dxffffsomex0054ype"),
    (N.postgresql_names, PATH, "/", False, ""),
    (N.postgresql_names, PATH, "/", True, "x002f"),
    (N.postgresql_names, ENTITY, "/", False, "someId_someType"),
    (N.postgresql_names, ENTITY, "/", True, "x002fxffffsomex0049dxffffsomex0054ype"),
    (N.mysql_names, PATH, "/somePath", False, "somePath"),
    (N.mysql_names, PATH, "/somePath", True, "x002fsomePath"),
    (N.mysql_names, ENTITY, "/somePath", True, "x002fsomePathxffffsomeIdxffffsomeType"),
    (N.mysql_names, ENTITY, "/", False, "someId_someType"),
    (N.mysql_names, ENTITY, "/", True, "x002fxffffsomeIdxffffsomeType"),
    (N.mongo_names, PATH, "/", False, "sth_/"),
    (N.mongo_names, PATH, "/", True, "sth_x002f"),
    (N.mongo_names, ENTITY, "/", False, "sth_/_someId_someType"),
    (N.mongo_names, ENTITY, "/", True, "sth_x002fxffffsomeIdxffffsomeType"),
    (N.mongo_names, ATTRIBUTE, "/", False, "sth_/_someId_someType_someName"),
    (N.mongo_names, ATTRIBUTE, "/", True, "sth_x002fxffffsomeIdxffffsomeTypexffffsomeName"),
    (N.cassandra_names, PATH, "/somePath", True, "x002fsomePath"),
    (N.cassandra_names, ENTITY, "/somePath", False, "somePath_someId_someType"),
    (N.dynamo_names, PATH, "/somePath", False, "somePath"),
    (N.dynamo_names, ENTITY, "/somePath", True, "x002fsomePathxffffsomeIdxffffsomeType"),
    (N.dynamo_names, ENTITY, "/", False, "someId_someType"),
    (N.dynamo_names, ENTITY, "/", True, "x002fxffffsomeIdxffffsomeType"),
]


@pytest.mark.parametrize("namer,model,path,encoding,want", TABLES)
def test_table_names(spark, namer, model, path, encoding, want):
    got = _names(spark, namer, path, data_model=model, enable_encoding=encoding)
    assert got["dest_table"] == want
    root_by_path = path == "/" and model == PATH and not encoding and namer is not N.mongo_names
    assert got["name_warning" if "name_warning" in got else "name_reject"] is None or root_by_path


def test_database_names(spark):
    assert _names(spark, N.postgresql_names)["dest_db"] == "somex0053ervice"
    assert _names(spark, N.postgresql_names, enable_lowercase=True)["dest_db"] == "someservice"
    assert _names(spark, N.mysql_names, enable_encoding=False)["dest_db"] == "someService"
    assert _names(spark, N.mongo_names, data_model=PATH)["dest_db"] == "sth_somex0053ervice"


@pytest.mark.parametrize("path,encoding,folder,leaf", [
    ("/somePath", False, "someService/somePath/someId_someType", "someId_someType"),
    ("/somePath", True, "someService/somePath/someIdxffffsomeType", "someIdxffffsomeType"),
    ("/", False, "someService/someId_someType", "someId_someType"),
])
def test_folder_names(spark, path, encoding, folder, leaf):
    def namer(df, opts):
        return N.hdfs_names(df, opts, F.concat_ws("=", "entity_id", "entity_type"))

    got = _names(spark, namer, path, enable_encoding=encoding)
    assert (got["dest_folder"], got["dest_file"]) == (folder, f"{folder}/{leaf}.txt")


@pytest.mark.parametrize("namer,most", [
    (N.postgresql_names, 63), (N.mysql_names, 64), (N.cassandra_names, 48), (N.mongo_names, 113), (N.dynamo_names, 255),
])
def test_names_over_the_limit_are_rejected(spark, namer, most):
    fixed = len("sth_/") if namer is N.mongo_names else 0
    prefix = "/" + "a" * (most - fixed)
    opts = {"data_model": PATH, "enable_encoding": False}
    assert _names(spark, namer, prefix, **opts)["name_reject"] is None
    assert _names(spark, namer, prefix + "b", **opts)["name_reject"].endswith("too-long")


def test_mongo_limit_counts_bytes(spark):
    assert _names(spark, N.mongo_names, "/" + "é" * 60, data_model=PATH)["name_reject"] == "collection-name-too-long"


def test_short_names(spark):
    assert _names(spark, N.dynamo_names, "/ab", data_model=PATH, enable_encoding=False)["name_reject"] == "table-name-too-short"
    got = _names(spark, N.ckan_names, service="s", version="ld")
    assert got["name_reject"] == "organization-name-too-short"


def test_long_ld_table_is_only_a_warning(spark):
    got = _names(spark, N.postgresql_names, eid="e" * 70, version="ld", data_model=ENTITY)
    assert got["name_reject"] is None and got["name_warning"] == "table-name-too-long"


def test_unknown_model(spark):
    with pytest.raises(ValueError):
        _names(spark, N.postgresql_names, data_model="db-by-magic")


def test_times(spark):
    row = spark.sql("SELECT 1562561734983L AS ts, 1562561734083L AS low, 'second' AS r").select(
        T.recv_time(F.col("ts")), T.human_readable(F.col("low")), T.human_readable(F.col("ts"), False),
        T.milliseconds(F.lit("2019-07-08T04:55:34.983Z")), T.milliseconds(F.lit("nonsense")), T.seconds(F.col("ts")),
        T.bucket_range(F.col("r")), T.bucket_range(F.lit("week")),
    ).first()
    assert list(row) == [
        "07/08/2019 04:55:34", "2019-07-08T04:55:34.83Z", "2019-07-08 04:55:34.983", 1562561734983, None, 1562561734,
        "minute", None,
    ]


def test_sql_functions_agree_with_columns(spark):
    SQL.register(spark)
    df = spark.createDataFrame([(t,) for texts in TEXTS.values() for t in texts], "s string")
    for kind in E.DENIED:
        differ = df.filter(F.expr(f"ctx_encode_{kind}(s)") != E.encode(F.col("s"), kind))
        assert differ.count() == 0, kind
