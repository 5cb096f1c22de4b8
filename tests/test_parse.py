"""Parsing and layouts on hand-made notifications."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from chronoctx import model as M
from chronoctx.operators import catalog as C
from chronoctx.operators import graph
from chronoctx.operators import layout as L
from chronoctx.operators import parse as P
from chronoctx.operators.trajectory import trajectory_layout
from chronoctx.options import Options
from chronoctx.plans.pipelines import distance_history, history
from chronoctx.plans.session import store
from chronoctx.sources.notifications import from_kafka

TS = datetime(2019, 7, 8, 4, 55, 34, 983000, tzinfo=timezone.utc)


def raw(spark, *bodies, headers=None):
    headers = {M.HEADER_SERVICE: "vehicles", M.HEADER_SERVICE_PATH: "/4wheels"} if headers is None else headers
    rows = [(i, headers, b if isinstance(b, str) else json.dumps(b), TS) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, f"event_id int, {M.RAW_SCHEMA}")


def attr(type_, value, **metadata):
    return {"type": type_, "value": value, "metadata": metadata}


CAR = {"subscriptionId": "s", "data": [
    {"id": "car1", "type": "car", "speed": attr("float", 112.9), "oil_level": attr("float", 74.6)},
]}

PARKING = {"id": "n1", "type": "Notification", "data": [{
    "id": "urn:ngsi-ld:OffStreetParking:D1", "type": "OffStreetParking", "@context": ["https://example.org"],
    "name": {"type": "Property", "value": "Downtown One"},
    "availableSpotNumber": {
        "type": "Property", "value": 122, "observedAt": "2017-07-29T12:05:02Z",
        "reliability": {"type": "Property", "value": 0.7},
        "providedBy": {"type": "Relationship", "object": "urn:ngsi-ld:Camera:C1"},
    },
    "totalSpotNumber": {"type": "Property", "value": 200},
    "location": {"type": "GeoProperty", "value": {"type": "Point", "coordinates": [-8.5, 41.2]}},
    "odd": {"type": "LanguageProperty", "value": "x"},
}]}


def test_car_rows(spark):
    rows = history(raw(spark, CAR), "postgresql", Options()).accepted.drop("event_id").collect()
    want = [
        ("vehicles", "x002f4wheelsxffffcar1xffffcar", 1562561734983, "07/08/2019 04:55:34", "4wheels", "car1", "car", n, "float", v, "[]")
        for n, v in (("speed", "112.9"), ("oil_level", "74.6"))
    ]
    assert [tuple(r) for r in rows] == want


def test_car_columns(spark):
    out = history(raw(spark, CAR), "mysql", Options(enable_encoding=False), "column", ["speed", "oil_level", "other"]).accepted
    assert out.columns[-6:] == ["speed", "speed_md", "oil_level", "oil_level_md", "other", "other_md"]
    row = out.first()
    assert (row.dest_table, row.speed, row.speed_md, row.oil_level, row.other, row.other_md) == (
        "4wheels_car1_car", "112.9", "[]", "74.6", None, None)


def test_values_keep_their_json_text(spark):
    body = {"data": [{"id": "Room10", "type": "Room", "temperature": attr("Float", 244.5, accuracy={"type": "Float", "value": 0.88}),
                      "list": attr("Array", [1, {"a": None}]), "none": attr("Text", None), "quoted": attr("Text", 'say "hi"'), "flag": attr("Bool", True)}]}
    rows = {r.attr_name: r for r in P.attribute_rows(P.parse(raw(spark, body))).collect()}
    assert {n: r.attr_value for n, r in rows.items()} == {
        "temperature": "244.5", "list": '[1,{"a":null}]', "none": "null", "quoted": 'say "hi"', "flag": "true"}
    assert rows["temperature"].md_json == '{"accuracy":{"type":"Float","value":0.88}}'
    assert [tuple(m) for m in rows["temperature"].md] == [("accuracy", "Float", "0.88")]
    assert [rows[n].attr_pos for n in ("temperature", "list", "none", "quoted", "flag")] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("body,reason", [
    ("{not json", "malformed-notification"), ("", "malformed-notification"), ({"subscriptionId": "x"}, "malformed-notification"),
    ({"data": {"id": "a"}}, "malformed-notification"), ({"data": [{"type": "T"}]}, "entity-id-missing"),
    ({"data": [{"id": "a"}]}, "entity-type-missing"), ({"data": [{"id": "a", "type": "T", "x": 5}]}, "attribute-not-an-object"),
    ({"data": [{"id": "a", "type": "T", "x": {"value": 1, "metadata": {}}}]}, "attribute-type-missing"),
    ({"data": [{"id": "a", "type": "T", "x": {"type": "t", "metadata": {}}}]}, "attribute-value-missing"),
    ({"data": [{"id": "a", "type": "T", "x": {"type": "t", "value": 1}}]}, "attribute-metadata-missing"),
    ({"data": [{"id": "a", "type": "T", "x": attr("t", 1, m={"type": "t"})}]}, "metadata-item-invalid"),
])
def test_rejects(spark, body, reason):
    parsed = P.parse(raw(spark, body, CAR))
    dead = P.rejects(parsed).collect()
    assert [(r.event_id, r.reject_reason) for r in dead] == [(0, reason)]
    assert dead[0].body == (body if isinstance(body, str) else json.dumps(body))
    assert {r.event_id for r in P.attribute_rows(parsed).collect()} == {1}


def test_one_broken_entity_rejects_the_notification(spark):
    body = {"data": [*CAR["data"], {"id": "b", "type": "T", "x": {"type": "t", "value": 1}}]}
    parsed = P.parse(raw(spark, body))
    assert P.rejects(parsed).count() == 1 and P.attribute_rows(parsed).count() == 0


def test_entity_without_attributes_gives_no_row(spark):
    parsed = P.parse(raw(spark, {"data": [{"id": "a", "type": "T"}]}))
    assert P.rejects(parsed).count() == 0 and P.entity_rows(parsed).count() == 0


@pytest.mark.parametrize("headers,want", [
    ({}, ("test", "/path")), ({M.HEADER_SERVICE.upper(): "ND", M.HEADER_SERVICE_PATH.title(): "/Nd"}, ("test", "/path")),
    ({M.HEADER_SERVICE.title(): "A", M.HEADER_SERVICE_PATH: "/b"}, ("A", "/b")),
])
def test_tenants(spark, headers, want):
    row = P.entity_rows(P.parse(raw(spark, CAR, headers=headers))).first()
    assert (row.service, row.service_path) == want


def test_service_paths_go_to_entities_by_position(spark):
    body = {"data": [{"id": i, "type": "T", "x": attr("t", 1)} for i in "ab"]}
    headers = {M.HEADER_SERVICE: "s", M.HEADER_SERVICE_PATH: "/other,/suites"}
    rows = P.entity_rows(P.parse(raw(spark, body, headers=headers))).collect()
    assert [(r.entity_id, r.service_path) for r in rows] == [("a", "/other"), ("b", "/suites")]
    headers = {**headers, M.HEADER_SERVICE_PATH: "/1,/2,/3"}
    assert P.rejects(P.parse(raw(spark, body, headers=headers))).first().reject_reason == "service-path-count"


def test_correlator_is_kept_or_made(spark):
    given = P.with_event_columns(raw(spark, CAR, headers={M.HEADER_CORRELATOR: "c1"})).first().correlator
    other = {"data": [{"id": "other", "type": "T"}]}
    made = [[r.correlator for r in P.with_event_columns(raw(spark, CAR, other)).collect()] for _ in range(2)]
    assert given == "c1" and len(set(made[0])) == 2 and made[0] == made[1] and all(len(m) == 36 for m in made[0])


def test_ld_columns(spark):
    opts = Options(version="ld", data_model="db-by-entity", enable_lowercase=False)
    out = history(raw(spark, PARKING), "postgresql", opts, "column").accepted
    row = out.first().asDict()
    assert M.SERVICE_PATH not in row and M.RECV_TIME_TS not in row
    assert row["availableSpotNumber"] == "122" and row["availableSpotNumber_observedAt"] == "2017-07-29T12:05:02Z"
    assert row["availableSpotNumber_reliability"] == "0.7" and row["availableSpotNumber_providedBy"] == "urn:ngsi-ld:Camera:C1"
    assert row["totalSpotNumber"] == "200" and row["name"] == "Downtown One"
    assert row["location"] == '{"type":"Point","coordinates":[-8.5,41.2]}' and row["odd"] is None
    literal = [s for r in P.attribute_rows(P.parse(raw(spark, PARKING), opts)).collect() for s in r.sub_attrs if s.name == "observedAt"]
    assert literal[0].type is None


@pytest.mark.parametrize("attribute,reason", [
    ({"type": "Relationship", "value": 1}, "attribute-value-missing"), ({"type": "Property"}, "attribute-value-missing"),
    ({"value": 1}, "attribute-type-missing"), (3, "attribute-not-an-object"),
    ({"type": "Property", "value": 1, "sub": 5}, "sub-attribute-not-an-object"),
    ({"type": "Property", "value": 1, "sub": {"value": 5}}, "sub-attribute-type-missing"),
    ({"type": "Property", "value": 1, "sub": {"type": "Relationship"}}, "sub-attribute-value-missing"),
])
def test_ld_rejects(spark, attribute, reason):
    parsed = P.parse(raw(spark, {"data": [{"id": "a", "type": "T", "x": attribute}]}), Options(version="ld"))
    assert parsed.first().reject_reason == reason


def test_ld_graph(spark):
    rows = P.attribute_rows(P.parse(raw(spark, PARKING), Options(version="ld")))
    edge = graph.edges(rows).select("source", "predicate", "target").collect()
    assert [tuple(e) for e in edge] == [
        ("urn:ngsi-ld:OffStreetParking:D1", "availableSpotNumber_providedBy", "urn:ngsi-ld:Camera:C1")]
    assert graph.nodes(rows).count() == 1


def test_time_instant(spark):
    body = {"data": [{"id": "a", "type": "T", "x": attr("t", 1, TimeInstant={"type": "DateTime", "value": "2020-01-01T00:00:01.500Z"}),
                      "y": attr("t", 1, TimeInstant={"type": "DateTime", "value": "soon"})}]}
    rows = P.use_time_instant(P.attribute_rows(P.parse(raw(spark, body)))).collect()
    assert {r.attr_name: r.recv_time_ts for r in rows} == {"x": 1577836801500, "y": 1562561734983}


def test_json_lines_are_json(spark):
    body = {"data": [{"id": 'a"b', "type": "T", "text": attr("t", 'q"\\\n'), "num": attr("t", -1.5), "obj": attr("t", {"k": [1]}),
                      "like": attr("t", "007"), "none": attr("t", None, m={"type": "u", "value": "v"})}]}
    parsed = P.parse(raw(spark, body))
    lines = [json.loads(r.line) for r in L.json_row_lines(P.attribute_rows(parsed)).collect()]
    assert {x[M.ATTR_NAME]: x[M.ATTR_VALUE] for x in lines} == {
        "text": 'q"\\\n', "num": -1.5, "obj": {"k": [1]}, "like": "007", "none": None}
    assert lines[-1][M.ATTR_MD] == [{"name": "m", "type": "u", "value": "v"}] and lines[0][M.ATTR_MD] == []
    assert lines[0][M.RECV_TIME_TS] == "1562561734" and lines[0][M.SERVICE_PATH] == "/4wheels"
    column = json.loads(L.json_column_lines(P.entity_rows(parsed)).first().line)
    assert column["text"] == 'q"\\\n' and column["num_md"] == [] and column[M.ENTITY_ID] == 'a"b'


def test_geometry(spark):
    body = {"data": [{"id": "eventoGEO", "type": "geo", "location": attr("geo:point", "40.4, -3.6"), "temperature": attr("Float", 1)}]}
    entities = P.entity_rows(P.parse(raw(spark, body)))
    for swap, want in ((False, (40.4, -3.6)), (True, (-3.6, 40.4))):
        row = L.with_geometry(entities, Options(swap_coordinates=swap)).first()
        assert (row.the_geom.lon, row.the_geom.lat, row.the_geom.srid) == (*want, 4326)
        assert (row.the_geom_webmercator.lon, row.the_geom_webmercator.srid) == (want[0], 3857)
    layout = L.carto_raw_layout(entities, ["location", "temperature"]).first().asDict()
    assert "location" not in layout and layout["temperature"] == "1"


@pytest.mark.parametrize("per_entity", [True, False])
def test_distance_history_continues(spark, per_entity):
    def body(eid, lat):
        return {"data": [{"id": eid, "type": "geo", "location": attr("geo:point", f"{lat}, 1")}, {"id": "still", "type": "x", "t": attr("n", 1)}]}

    opts = Options(data_model="db-by-service-path", swap_coordinates=True)
    data = raw(spark, *[body("ab"[i % 2], i) for i in range(6)])
    whole = distance_history(data, opts, per_entity=per_entity, scale=2)
    first = store(distance_history(data.filter("event_id < 3"), opts, per_entity=per_entity, scale=2), "first")
    rest = distance_history(data.filter("event_id >= 3"), opts, stored=first, per_entity=per_entity, scale=2)
    out = first.unionByName(rest)
    assert out.select(whole.columns).exceptAll(whole).count() == 0 and out.count() == 6
    last = whole.orderBy(F.desc("event_id")).first()
    assert last.numSamples == (3 if per_entity else 6) and last.sumDistance == pytest.approx((4 if per_entity else 5) * 111195.08, abs=0.1)
    assert trajectory_layout(whole).columns == ["dest_db", "dest_table", *M.TRAJECTORY_COLUMNS]


def test_attribute_names_are_found(spark):
    assert L.discover_attributes(P.attribute_rows(P.parse(raw(spark, CAR)))) == ["oil_level", "speed"]


def test_of_equal_headers_the_first_counts(spark):
    headers = "map('Keywords', 'k1', 'keywords', 'k2', 'FIWARE-Service', 'one', 'fiware-service', 'two')"
    df = spark.sql(f"SELECT {headers} AS headers, '{{}}' AS body, timestamp'2024-01-01' AS ingest_ts")
    parsed = P.parse(df).first()
    assert parsed.service == "one" and parsed.correlator == P.parse(df).first().correlator
    assert C.catalog_columns(C.enrich(df, {"keywords": "'x,y'"})).first().keywords == ["x", "y"]
    assert C.catalog_columns(df).first().keywords == ["k1"]
    kafka = spark.sql(
        "SELECT array(named_struct('key', 'a', 'value', cast('1' AS BINARY)), named_struct('key', 'a', 'value', cast('2' AS BINARY))) AS headers,"
        " cast('{}' AS BINARY) AS value, timestamp'2024-01-01' AS timestamp")
    assert from_kafka(kafka).first().headers == {"a": "1"}


def test_time_instant_is_an_option_of_pipelines(spark):
    md = {"TimeInstant": {"type": "DateTime", "value": "2020-05-06T07:08:09.010Z"}}
    body = {"data": [{"id": "e", "type": "T", "x": {"type": "N", "value": 1, "metadata": md}, "y": {"type": "N", "value": 2, "metadata": {}}}]}
    rows = {r.attrName: r.recvTimeTs for r in history(raw(spark, body), "postgresql", Options(time_instant=True)).accepted.collect()}
    assert rows["x"] == 1588748889010 and rows["y"] != rows["x"]
    plain = history(raw(spark, body), "postgresql", Options()).accepted.collect()
    assert {r.recvTimeTs for r in plain} == {rows["y"]}


def test_repeated_attributes_are_rejected(spark):
    body = '{"data":[{"id":"e","type":"T","x":{"type":"N","value":1,"metadata":{}},"x":{"type":"N","value":2,"metadata":{}}}]}'
    df = spark.createDataFrame([(body,)], "body string").selectExpr("map() AS headers", "body", "timestamp'2024-01-01' AS ingest_ts")
    df = df.withColumn("headers", F.col("headers").cast("map<string,string>"))
    assert P.parse(df).first().reject_reason == "attribute-repeated"


def test_kafka_records(spark):
    df = spark.sql(
        f"SELECT array(named_struct('key', '{M.HEADER_SERVICE}', 'value', cast('web' AS BINARY))) AS headers, "
        "cast('{}' AS BINARY) AS value, timestamp'2020-01-01' AS timestamp"
    )
    row = from_kafka(df).first()
    assert (row.headers, row.body) == ({M.HEADER_SERVICE: "web"}, "{}")


def test_json_predicate(spark):
    df = spark.createDataFrame([(t,) for t in ('{"a":1}', "[1]", "5", '"x"', "{", "", None, " [] ")], "s string")
    assert [r[0] for r in df.select(P.is_valid_json(F.col("s"))).collect()] == [True, True, False, False, False, False, False, True]


def test_parse_does_not_shuffle_and_parses_once(spark):
    plan = history(raw(spark, CAR)).accepted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("from_json(StructField(data") == 1
