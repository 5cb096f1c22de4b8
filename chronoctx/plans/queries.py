"""Queries over the analytic tables, one or more per group of operators.

Every query takes (spark, folder of the parquet tables). Numbers inside text
values are compared as DOUBLE columns, so results do not depend on how an
engine prints a number.
"""

from __future__ import annotations

import os
import uuid
from contextlib import nullcontext

from pyspark.errors import NumberFormatException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronoctx import model as M
from chronoctx import options as O
from chronoctx.functions import encode as E
from chronoctx.functions import geo as G
from chronoctx.functions import params
from chronoctx.functions import sql as SQL
from chronoctx.functions import times as T
from chronoctx.functions import vocab
from chronoctx.operators import buckets as B
from chronoctx.operators import catalog as C
from chronoctx.operators import documents as D
from chronoctx.operators import evolve
from chronoctx.operators import fragments as FR
from chronoctx.operators import graph
from chronoctx.operators import layout as L
from chronoctx.operators import naming as N
from chronoctx.operators import parse as P
from chronoctx.operators import retention as R
from chronoctx.operators import trajectory as TR
from chronoctx.options import Options
from chronoctx.plans.pipelines import history
from chronoctx.plans.session import shared_dir, store
from chronoctx.sinks import files
from chronoctx.sinks import ids as IDS
from chronoctx.sinks import maintenance as MT
from chronoctx.sinks import versions as V
from chronoctx.sources import adapters as A
from chronoctx.sources import history as H
from chronoctx.sources.adapters import spread
from chronoctx.streaming import buckets as SB
from chronoctx.streaming import fragments as SF
from chronoctx.streaming import history as SH
from chronoctx.streaming import live as SL
from chronoctx.streaming import runtime
from chronoctx.streaming import trajectory as ST

V2 = Options()
LD = Options(version="ld")
NOW_MS = 1705708800000          # 2024-01-20T00:00:00Z
ATTRS = ["value", "kind", "props"]
LD_ATTRS = {"totalPrice": ["observedAt", "unitCode", "status", "handledBy"], "priority": [], "placedBy": [], "location": []}


def work_dir(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def events(spark, d) -> DataFrame:
    return spread(A.table(spark, d, "events"), "event_id")


def orders(spark, d) -> DataFrame:
    return spread(A.table(spark, d, "orders"), "o_orderkey")


def event_parsed(spark, d, geo=False, opts=V2) -> DataFrame:
    return P.parse(A.event_notifications(events(spark, d), geo), opts)


def event_rows(spark, d, geo=False, opts=V2) -> DataFrame:
    return P.attribute_rows(event_parsed(spark, d, geo, opts))


def event_entities(spark, d, geo=False, opts=V2) -> DataFrame:
    return P.entity_rows(event_parsed(spark, d, geo, opts))


def order_parsed(spark, d) -> DataFrame:
    return P.parse(A.order_notifications(orders(spark, d)), LD)


def order_rows(spark, d) -> DataFrame:
    return P.attribute_rows(order_parsed(spark, d))


def order_entities(spark, d) -> DataFrame:
    return P.entity_rows(order_parsed(spark, d))


def split_value(df: DataFrame, column: str = M.ATTR_VALUE) -> DataFrame:
    """A text value as (number, other text)."""
    number = F.col(column).try_cast("double")
    return df.withColumns({
        "value_num": F.coalesce(number, F.lit(-1.0)),
        "value_text": F.when(number.isNull(), F.col(column)).otherwise(F.lit("")),
    }).drop(column)


def number(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


# -- rows and columns -------------------------------------------------------

def v2_row_history(spark, d):
    """Notifications to named rows of a relational store, one per attribute."""
    out = history(A.event_notifications(events(spark, d)), "postgresql", V2).accepted
    return split_value(out)


def v2_column_history(spark, d):
    out = history(A.event_notifications(events(spark, d)), "postgresql", V2, "column", ATTRS).accepted
    return number(out, "value")


def v2_discovered_columns(spark, d):
    """Column history without a given list of attributes."""
    out = history(A.event_notifications(events(spark, d)), "mysql", V2, "column").accepted
    return number(out, "value")


def v2_column_map(spark, d):
    out = L.column_map_layout(event_entities(spark, d))
    return out.select(
        "event_id", M.ENTITY_ID, F.array_join(F.array_sort(F.map_keys("values")), ",").alias("names"),
        F.col("values")["kind"].alias("kind"), F.col("metadata")["kind"].alias("kind_md"),
        F.col("values")["value"].cast("double").alias("value"),
    )


def v2_ckan_compat_rows(spark, d):
    opts = V2.but(ckan_compatible=True)
    return split_value(history(A.event_notifications(events(spark, d)), "postgresql", opts).accepted)


def v2_metadata_rows(spark, d):
    rows = P.metadata_rows(event_rows(spark, d))
    return rows.select(
        "event_id", "entity_id", "attr_name", F.col("md_pos").cast("bigint"), "md_name", "md_type", "md_value"
    )


def v2_time_instant(spark, d):
    """Rows re-timed by their metadata: the notification arrives 90 s late."""
    raw = A.event_notifications(events(spark, d)).withColumn("ingest_ts", F.expr("ingest_ts + INTERVAL 90 SECONDS"))
    rows = P.use_time_instant(P.attribute_rows(P.parse(raw)))
    return rows.select("event_id", "attr_name", "recv_time_ts", T.recv_time(F.col("recv_time_ts")).alias("recv_time"))


def v2_multi_path(spark, d):
    """Two entities per notification, with one path for both or one for each."""
    ev = events(spark, d)
    empty = F.from_json(F.lit("{}"), "map<string,string>")

    def entity(suffix: str) -> Column:
        return F.struct(
            F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit(suffix)).alias("id"),
            F.lit("User").alias("type"),
            F.struct(F.lit("Text").alias("type"), F.col("event_type").alias("value"), empty.alias("metadata")).alias("kind"),
        )

    paths = F.when(F.col("event_id") % 3 == 0, F.lit("/only")).otherwise(F.lit("/first, /second"))
    raw = ev.select(
        "event_id",
        F.create_map(F.lit(M.HEADER_SERVICE.upper()), F.lit("ND"), F.lit(M.HEADER_SERVICE_PATH), paths).alias("headers"),
        F.to_json(F.struct(F.array(entity("a"), entity("b")).alias("data"))).alias("body"),
        F.col("ts").cast("timestamp").alias("ingest_ts"),
    )
    rows = P.attribute_rows(P.parse(raw))
    return rows.select("event_id", "service", "service_path", F.col("entity_pos").cast("bigint"), "entity_id", "attr_value")


def v2_rejects(spark, d):
    """Broken notifications by reason, and what is accepted beside them."""
    good = A.event_notifications(events(spark, d))
    body = F.col("body")
    case = F.col("event_id") % 8
    broken = (
        F.when(case == 1, F.substring(body, F.lit(1), F.length(body) - 3))
        .when(case == 2, F.regexp_replace(body, '"data":', '"date":'))
        .when(case == 3, F.regexp_replace(body, r'"id":"[^"]*",', ""))
        .when(case == 4, F.regexp_replace(body, r',"metadata":\{\}', ""))
        .when(case == 5, F.regexp_replace(body, r'"kind":\{"type":"Text",', '"kind":{'))
        .when(case == 6, F.regexp_replace(body, r'"kind":\{[^}]*\}\}', '"kind":7'))
        .when(case == 7, F.regexp_replace(body, r'"value":"[a-z]*"', '"value":null'))
        .otherwise(body)
    )
    parsed = P.parse(good.withColumn("body", broken))
    parsed = store(parsed.select("event_id", "service_paths", "entities", "reject_reason"), "parsed")
    dead = P.rejects(parsed).select("event_id", F.col("reject_reason").alias("outcome"))
    alive = P.attribute_rows(parsed).filter(F.col("attr_name") == "kind").select(
        "event_id", F.concat(F.lit("accepted "), F.col("attr_value")).alias("outcome")
    )
    return dead.unionByName(alive)


def ld_column_history(spark, d):
    opts = LD.but(data_model=O.BY_ENTITY_TYPE)
    out = history(A.order_notifications(orders(spark, d)), "postgresql", opts, "column", LD_ATTRS).accepted
    return number(out, "totalPrice")


def ld_attribute_rows(spark, d):
    rows = order_rows(spark, d)
    def named(name: Column, type_: Column, text: Column) -> Column:
        return F.struct(name.alias("name"), type_.alias("type"), text.alias("text"))

    own = named(F.col("attr_name"), F.col("attr_type"), F.col("attr_value"))
    subs = F.transform("sub_attrs", lambda s: named(
        F.concat_ws("_", "attr_name", s["name"]), F.coalesce(s["type"], F.lit("")), s["value"]))
    both = F.when(F.size("sub_attrs") > 0, F.concat(F.array(own), subs)).otherwise(F.array(own))
    return split_value(rows.select("event_id", "entity_id", F.inline(both)), "text")


def ld_edges(spark, d):
    return graph.edges(order_rows(spark, d)).select("event_id", "source", "predicate", "target")


def ld_nodes(spark, d):
    return graph.nodes(order_rows(spark, d))


# -- stores -----------------------------------------------------------------

def mysql_rows(spark, d):
    return split_value(history(A.event_notifications(events(spark, d)), "mysql", V2.but(enable_encoding=False)).accepted)


def cassandra_rows(spark, d):
    out = history(A.event_notifications(events(spark, d)), "cassandra", V2.but(data_model=O.BY_SERVICE_PATH)).accepted
    return split_value(out.drop("id"))


def dynamo_items(spark, d):
    """Items with consecutive numbers over the whole batch."""
    rows = N.accepted_names(N.dynamo_names(event_rows(spark, d)))
    items = store(L.dynamo_layout(L.row_layout(rows.withColumn("event_id", F.col("event_id") * 10 + F.col("attr_pos")), strip_path=False)), "items")
    numbered = TR.with_row_ids(items, [], ["event_id"], "ID", start=NOW_MS)
    return split_value(numbered)


def dynamo_column_items(spark, d):
    out = history(A.event_notifications(events(spark, d)), "dynamo", V2, "column", ATTRS).accepted
    return number(out, "value")


def mongo_docs_by_path(spark, d):
    out = history(A.event_notifications(events(spark, d)), "mongo", V2.but(data_model=O.BY_SERVICE_PATH)).accepted
    return split_value(out).withColumn(M.RECV_TIME, F.unix_millis(M.RECV_TIME))


def mongo_docs_by_attribute(spark, d):
    opts = V2.but(data_model=O.BY_ATTRIBUTE, enable_encoding=False)
    out = history(A.event_notifications(events(spark, d)), "mongo", opts).accepted
    return split_value(out).withColumn(M.RECV_TIME, F.unix_millis(M.RECV_TIME))


def mongo_column_docs(spark, d):
    opts = V2.but(data_model=O.BY_SERVICE_PATH)
    out = history(A.event_notifications(events(spark, d)), "mongo", opts, "column", ATTRS).accepted
    return number(out, "value").withColumn(M.RECV_TIME, F.unix_millis(M.RECV_TIME))


def ckan_records(spark, d):
    out = history(A.order_notifications(orders(spark, d)), "ckan", LD, "column", LD_ATTRS).accepted
    return number(out, "totalPrice")


def ckan_row_records(spark, d):
    out = L.ckan_row_records(event_rows(spark, d), V2)
    return split_value(out.withColumn(M.RECV_TIME, F.unix_millis(M.RECV_TIME)))


def ckan_fields(spark, d):
    """Fields of every record store, from its first record."""
    ev = A.table(spark, d, "events").select("event_type", F.col("event_id").alias("_id"), F.concat(
        F.lit('{"recvTime":'), F.col("event_id").cast("string"), F.lit(',"'), F.col("event_type"), F.lit('":1,"u'),
        (F.col("user_id") % 7).cast("string"), F.lit('":2}')
    ).alias("record"))
    out = L.infer_fields(ev, "record", ["event_type"])
    return out.withColumn("field_pos", F.col("field_pos").cast("bigint"))


def ckan_upsert(spark, d):
    """Records appended to a datastore of another width."""
    stored = A.table(spark, d, "events").filter(F.col("event_type") != "error").select("event_id", "event_type")
    fresh = A.table(spark, d, "events").filter(F.col("event_type") == "error").select("event_id", "user_id")
    out = evolve.append(stored, fresh)
    return out.select("event_id", F.coalesce("event_type", F.lit("-")).alias("event_type"), F.coalesce("user_id", F.lit(-1)).alias("user_id"))


# -- files ------------------------------------------------------------------

def hdfs_json_rows(spark, d):
    """JSON lines written to a shared folder and read back."""
    path = work_dir(spark, "json-row")
    files.append_lines(N.accepted_names(N.hdfs_names(event_rows(spark, d))).transform(L.json_row_lines), path)
    schema = (
        f"{M.RECV_TIME_TS} STRING, {M.RECV_TIME} STRING, {M.SERVICE_PATH} STRING, {M.ENTITY_ID} STRING, "
        f"{M.ENTITY_TYPE} STRING, {M.ATTR_NAME} STRING, {M.ATTR_TYPE} STRING, {M.ATTR_VALUE} STRING, "
        f"{M.ATTR_MD} {M.MD_TYPE}, dest_db STRING"
    )
    back = spark.read.schema(schema).json(path)
    back = back.withColumns({
        M.RECV_TIME_TS: F.col(M.RECV_TIME_TS).cast("bigint"),
        M.ATTR_MD: F.array_join(F.col(f"{M.ATTR_MD}.value"), "|"),
    })
    return split_value(back)


def hdfs_json_columns(spark, d):
    path = work_dir(spark, "json-column")
    files.append_lines(N.accepted_names(N.hdfs_names(event_entities(spark, d))).transform(L.json_column_lines), path)
    schema = (
        f"{M.RECV_TIME} STRING, {M.SERVICE_PATH} STRING, {M.ENTITY_ID} STRING, {M.ENTITY_TYPE} STRING, value DOUBLE, "
        f"value_md {M.MD_TYPE}, kind STRING, kind_md {M.MD_TYPE}, props STRUCT<k:BIGINT>, dest_db STRING"
    )
    back = spark.read.schema(schema).json(path)
    return back.select(
        "dest_db", M.RECV_TIME, M.SERVICE_PATH, M.ENTITY_ID, M.ENTITY_TYPE, "value",
        F.array_join(F.col("value_md.name"), "|").alias("value_md"), "kind",
        F.size("kind_md").cast("bigint").alias("kind_md"), F.col("props.k").alias("k"),
    )


def hdfs_csv_rows(spark, d):
    path = work_dir(spark, "csv-row")
    named = N.accepted_names(N.hdfs_names(N.hdfs_metadata_names(event_rows(spark, d))))
    out = L.csv_row_layout(named, "hist").drop("dest_folder", "dest_file", "md_folder", "md_file")
    files.append_csv(out, path)
    fields = [f for f in out.columns if f != "dest_db"]
    schema = ", ".join(f"{f} {'BIGINT' if f in ('event_id', M.RECV_TIME_TS) else 'STRING'}" for f in [*fields, "dest_db"])
    return split_value(spark.read.schema(schema).csv(path))


def hdfs_csv_columns(spark, d):
    def md_file(attribute: Column) -> Column:
        return F.concat_ws("/", F.lit("md"), attribute["name"], attribute["type"])

    named = N.accepted_names(N.hdfs_names(event_entities(spark, d)))
    out = L.csv_column_layout(named, ATTRS, "hist", md_file)
    return number(out, "value")


def hdfs_md_files(spark, d):
    """Lines of the metadata side files."""
    named = N.hdfs_metadata_names(P.metadata_rows(event_rows(spark, d)))
    return L.csv_metadata_layout(named).drop("md_folder")


_SIDE = f"md_file STRING, {M.RECV_TIME_TS} BIGINT, name STRING, type STRING, value STRING, dest_db STRING"


def _linked(links: DataFrame, lines: DataFrame) -> DataFrame:
    """Every link with the rows that have it and the lines of the file it leads to."""
    rows = links.groupBy("link").agg(F.count("*").alias("n_rows"))
    link = F.concat(F.lit("hdfs:///user/hist/"), F.col("md_file")).alias("link")
    found = lines.groupBy(link).agg(
        F.count("*").alias("n_lines"), F.min(M.RECV_TIME_TS).alias("first_ms"), F.max(M.RECV_TIME_TS).alias("last_ms"),
        F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))
    both = rows.join(found, "link", "full")
    return both.select("link", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_lines", "first_ms", "last_ms")],
                       F.coalesce("names", F.lit("")).alias("names"))


def hdfs_csv_row_side_files(spark, d):
    """CSV rows and metadata side files written in one pass and followed from one to the other."""
    path = work_dir(spark, "csv-row-side")
    # named per entity; no attributes, no rows
    named = N.hdfs_names(event_entities(spark, d))
    named = named.withColumn("attrs", F.when(F.col("name_reject").isNull(), F.col("attrs"))).drop("name_reject")
    rows = N.hdfs_metadata_names(P.explode_attributes(named))
    out = L.csv_row_layout(rows, "hist", side=True).drop("dest_folder", "dest_file", "md_folder", "md_file")
    for half in (0, 1):
        files.append_csv_with_metadata(out.filter(F.col("event_id") % 2 == half), path)
    schema = ", ".join(f"{f} STRING" for f in out.columns if f not in ("dest_db", "metadata")) + ", dest_db STRING"
    rows = files.read_csv_part(spark, path, "rows", schema)
    return _linked(rows.select(F.col(M.ATTR_MD_FILE).alias("link")), files.read_csv_part(spark, path, "metadata", _SIDE))


def hdfs_csv_column_side_files(spark, d):
    """The same for entities with an attribute in each column."""
    path = work_dir(spark, "csv-column-side")
    named = N.accepted_names(N.hdfs_names(event_entities(spark, d)))
    out = L.csv_column_layout(named, ATTRS, "hist", N.hdfs_metadata_file, side=True).drop("dest_folder", "dest_file")
    files.append_csv_with_metadata(out, path)
    schema = ", ".join(f"{f} STRING" for f in out.columns if f not in ("dest_db", "metadata")) + ", dest_db STRING"
    rows = files.read_csv_part(spark, path, "rows", schema)
    links = rows.select(F.explode(F.array(*[f"{a}_md_file" for a in ATTRS])).alias("link"))
    return _linked(links, files.read_csv_part(spark, path, "metadata", _SIDE))


def external_table_scan(spark, d):
    """A catalog table over the JSON folder of one tenant, read as text rows."""
    path = work_dir(spark, "external")
    named = N.accepted_names(N.hdfs_names(event_rows(spark, d)))
    files.append_lines(L.json_row_lines(named), path)
    name = f"web_row_{uuid.uuid4().hex[:8]}"
    schema = f"{M.RECV_TIME_TS} STRING, {M.ENTITY_ID} STRING, {M.ATTR_NAME} STRING, {M.ATTR_VALUE} STRING"
    files.external_table(spark, name, f"{path}/dest_db=web", schema, "json-row")
    statement = (
        f"SELECT {M.ENTITY_ID}, {M.ATTR_NAME}, count(*) AS n, max(CAST({M.RECV_TIME_TS} AS BIGINT)) AS last "
        f"FROM default.{name} WHERE {M.ATTR_NAME} <> :skip GROUP BY ALL"
    )
    return H.query_text(spark, statement, {"cypher.param.string.skip": "props"})


# -- names ------------------------------------------------------------------

def encode_all(spark, d):
    """Every encoder over page addresses, names and whole document texts."""
    texts = (
        A.table(spark, d, "pages").select(F.lit("url").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("s"))
        .unionByName(A.table(spark, d, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("s")))
        .unionByName(A.table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.concat("c_name", F.lit("=x00ffé")).alias("s")))
        .unionByName(spread(A.table(spark, d, "documents"), "doc_id").select(F.lit("text").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("s")))
    )
    texts, kinds = E.encode_steps(texts, "s")
    texts, old = E.encode_old_steps(texts, "s")
    coded = {f"enc_{kind}": value for kind, value in kinds.items()} | old
    digest = {
        name: F.when(F.length("s") > 200, F.md5(value)).otherwise(value) for name, value in coded.items()
    }
    return texts.select("kind", "id", *[v.alias(k) for k, v in digest.items()])


_NAMED = [
    ("postgresql", N.postgresql_names, ("dest_db", "dest_table")),
    ("mysql", N.mysql_names, ("dest_db", "dest_table")),
    ("cassandra", N.cassandra_names, ("dest_db", "dest_table")),
    ("dynamo", N.dynamo_names, ("dest_table",)),
]


def _text_entities(spark, d) -> DataFrame:
    """Entities with awkward names, from the part table."""
    part = A.table(spark, d, "part")
    return part.select(
        F.col("p_partkey").alias("event_id"), F.lit("Big Service").alias("service"),
        F.when(F.col("p_size") % 5 == 0, F.lit("/")).otherwise(F.concat(F.lit("/"), F.col("p_brand"))).alias("service_path"),
        F.concat(F.lit("urn:x00a1="), F.col("p_name")).alias("entity_id"),
        F.concat(F.col("p_type"), F.lit("."), F.col("p_brand")).alias("entity_type"), F.lit("p.size$").alias("attr_name"),
    )


def destination_names(spark, d):
    """Names in the relational and key-value stores, old and new encoding."""
    entities = _text_entities(spark, d)
    parts = []
    for label, namer, columns in _NAMED:
        for encoding in (False, True):
            for by_path in (False, True):
                opts = V2.but(
                    enable_encoding=encoding, enable_lowercase=not encoding,
                    data_model=O.BY_SERVICE_PATH if by_path else O.BY_ENTITY,
                )
                named = namer(entities, opts)
                parts.append(named.select(
                    "event_id", F.lit(f"{label}-{'new' if encoding else 'old'}-{'path' if by_path else 'entity'}").alias("rule"),
                    F.concat_ws(".", *columns).alias("name"),
                    F.coalesce("name_reject", F.lit("")).alias("reject"),
                    F.coalesce("name_warning", F.lit("")).alias("warning"),
                ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def document_store_names(spark, d):
    """Collection names in three models and folder names, both encodings."""
    entities = _text_entities(spark, d)
    out = None
    for encoding in (False, True):
        tag = "new" if encoding else "old"
        opts = V2.but(enable_encoding=encoding, enable_lowercase=False)
        for model in (O.BY_SERVICE_PATH, O.BY_ENTITY, O.BY_ATTRIBUTE):
            named = N.mongo_names(entities, opts.but(data_model=model))
            part = named.select("event_id", F.lit(f"{model}-{tag}").alias("rule"), F.concat_ws(".", "dest_db", "dest_table").alias("name"))
            out = part if out is None else out.unionByName(part)
        folder = N.hdfs_names(entities.withColumn("attr_type", F.lit("Integer")), opts)
        both = N.hdfs_metadata_names(folder)
        for rule, column in (("folder", F.col("dest_folder")), ("file", F.col("dest_file")), ("md", F.col("md_file")),
                             ("hive", N.hive_table_name(F.col("dest_folder"), "csv-row", "hist", False))):
            out = out.unionByName(both.select("event_id", F.lit(f"{rule}-{tag}").alias("rule"), column.alias("name")))
    return out


def catalog_names(spark, d):
    """Organisation, package and resource names, derived and overridden."""
    entities = _text_entities(spark, d)
    given = entities.withColumns({
        "organizationName": F.when(F.col("event_id") % 2 == 0, F.lit("Org X")),
        "packageName": F.when(F.col("event_id") % 3 == 0, F.lit("Pkg/Y")),
        "resourceName": F.when(F.col("event_id") % 5 == 0, F.lit("Res Z")),
    })
    out = None
    for label, frame, opts in (
        ("plain-new", entities, LD), ("plain-old", entities, LD.but(enable_encoding=False)),
        ("plain-id", entities, LD.but(data_model=O.BY_ENTITY_ID)),
        ("given-keep", given, LD.but(enable_lowercase=False)), ("given-lower", given, LD),
    ):
        part = N.ckan_names(frame, opts).select(
            "event_id", F.lit(label).alias("rule"), "org_name", "pkg_name", "res_name",
            F.coalesce("name_reject", F.lit("")).alias("reject"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def destination_counts(spark, d):
    named = N.accepted_names(N.postgresql_names(event_rows(spark, d)))
    return N.destination_counts(named)


def destination_columns(spark, d):
    opts = V2.but(data_model=O.BY_SERVICE_PATH)
    return N.destination_columns(N.accepted_names(N.postgresql_names(event_rows(spark, d), opts)))


def destinations(spark, d):
    opts = LD.but(data_model=O.BY_ENTITY)
    return N.destinations(N.postgresql_names(order_entities(spark, d), opts))


# -- buckets ----------------------------------------------------------------

_BUCKET_KEYS = ["entity_id", "attr_name"]


def _numeric_rows(spark, d) -> DataFrame:
    rows = event_rows(spark, d)
    return rows.select(
        "event_id", "entity_id", "attr_name", "attr_type", "recv_time_ts", B.numeric_value(F.col("attr_value")).alias("value")
    )


def _bucket_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "origin": iso("origin"), "offset": F.col("offset").cast("bigint"),
        "sum": F.round("sum", 4), "sum2": F.round("sum2", 4),
    })


def bucket_numeric(spark, d):
    """Five resolutions of the numeric attributes of every user."""
    out = B.numeric_buckets(_numeric_rows(spark, d), _BUCKET_KEYS, attr_type="attr_type")
    return _bucket_columns(out.drop("last_ts"))


def bucket_hot_path(spark, d):
    """The same per service path, where few keys hold all rows."""
    rows = event_rows(spark, d).select("service_path", "attr_name", "recv_time_ts", B.numeric_value(F.col("attr_value")).alias("value"))
    out = B.numeric_buckets(rows, ["service_path", "attr_name"], resolutions=("hour", "day", "month"))
    return _bucket_columns(out.drop("last_ts"))


def bucket_merge(spark, d):
    """Buckets of three batches, merged."""
    rows = store(_numeric_rows(spark, d), "numbers")
    parts = [B.numeric_buckets(rows.filter(F.col("event_id") % 3 == i), _BUCKET_KEYS, resolutions=("minute", "day")) for i in range(3)]
    partials = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return _bucket_columns(B.merge_numeric(partials, _BUCKET_KEYS).drop("last_ts"))


def bucket_dense(spark, d):
    """Every slot of the hour and month documents, empty ones included."""
    sparse = B.numeric_buckets(_numeric_rows(spark, d), _BUCKET_KEYS, resolutions=("hour", "month"))
    return _bucket_columns(B.explode_points(B.dense_points(sparse, _BUCKET_KEYS)))


def bucket_categorical(spark, d):
    rows = event_rows(spark, d).filter(F.col("attr_name") == "kind")
    out = B.categorical_buckets(rows, ["entity_id"], "attr_value", resolutions=("hour", "day", "month"))
    return out.drop("last_ts").withColumns({"origin": iso("origin"), "offset": F.col("offset").cast("bigint")})


def bucket_occurrences(spark, d):
    """Occurrence maps per bucket, with every slot of the day documents."""
    rows = event_rows(spark, d).filter(F.col("attr_name") == "kind")
    flat = store(B.categorical_buckets(rows, ["entity_id"], "attr_value", resolutions=("day",)), "occurrences")
    points = B.explode_points(B.dense_occurrences(B.occurrence_points(flat, ["entity_id"], "attr_value"), ["entity_id"]))
    pairs = F.transform(F.array_sort(F.map_entries("occur")), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return points.select(
        "entity_id", iso("origin").alias("origin"), F.col("offset").cast("bigint"), "samples",
        F.array_join(pairs, ",").alias("occur"),
    )


def _document_rows(spark, d) -> DataFrame:
    return event_rows(spark, d).select(
        "event_id", "service_path", "entity_id", "entity_type", "attr_name", "attr_type", "recv_time_ts", "attr_value",
        B.numeric_value(F.col("attr_value")).alias("value"))


def _points_of(documents: DataFrame, model: str) -> DataFrame:
    """The slots with samples of each document, its collection and ``_id`` as text."""
    fields = [F.col(f"_id.{f}") for f in (D.ID_FIELDS[k] for k in B.MODEL_KEYS[model])]
    flat = documents.select(
        F.lit(model).alias("model"), F.concat_ws("|", *D.collection_keys(model)).alias("collection"), F.concat_ws("|", *fields).alias("doc_key"),
        F.col("_id.resolution").alias("resolution"), F.col("_id.range").alias("range"), F.col("_id.origin").alias("origin"), "attrType",
        F.size("points").cast("bigint").alias("n_points"), F.inline("points"))
    return flat.filter("samples > 0")


def bucket_documents(spark, d):
    """Bucket documents in the form of the store, by each of the three data models."""
    rows = store(_document_rows(spark, d), "document-rows")
    dense = store(D.dense_numeric(rows, resolutions=("hour", "month")), "dense-documents")
    parts = [_points_of(D.document(dense, model), model) for model in B.MODEL_KEYS]
    return _bucket_columns(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def stored_documents(spark, d):
    """Documents of three batches, one of them repeated, merged into a stored table;
    then those whose origin has expired go."""
    root = work_dir(spark, "documents")
    rows = store(_document_rows(spark, d), "document-rows")
    for batch in (0, 1, 1, 2):
        fresh = D.numeric_documents(rows.filter(F.col("event_id") % 3 == batch), resolutions=("hour",))
        D.upsert(spark, root, "aggregates", store(fresh, "fresh-documents"), token=f"batch-{batch}")
    D.drop_expired(spark, root, "aggregates", NOW_MS, 10 * 86_400)
    stored = V.read(spark, root, "aggregates").select("service_path", "entity_id", "entity_type", "_id", "attrType", "points")
    return _bucket_columns(_points_of(stored, O.BY_ENTITY))


def merged_occurrences(spark, d):
    """Documents that count every value, of two batches, merged slot by slot."""
    rows = store(_document_rows(spark, d).filter("attr_name = 'kind'").drop("value"), "document-rows")
    one, two = (D.categorical_documents(rows.filter(F.col("event_id") % 2 == i), O.BY_ATTRIBUTE, "attr_value", resolutions=("day",)) for i in (0, 1))
    merged = store(D.merge_documents(one, two), "merged-documents")
    pairs = F.transform(F.array_sort(F.map_entries("occur")), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    flat = _points_of(merged, O.BY_ATTRIBUTE).withColumn("occur", F.array_join(pairs, ","))
    return flat.withColumns({"origin": iso("origin"), "offset": F.col("offset").cast("bigint")})


# -- trajectories -----------------------------------------------------------

def _points(spark, d, raw: DataFrame | None = None) -> DataFrame:
    """Position rows of the geo notifications (point text is ``lat, lon``)."""
    raw = A.event_notifications(events(spark, d), geo=True) if raw is None else raw
    located = L.with_geometry(P.entity_rows(P.parse(raw)), V2.but(swap_coordinates=True))
    return located.select(
        "event_id", "service_path", "entity_id", "entity_type", "recv_time_ts",
        F.col("the_geom.lon").alias("lon"), F.col("the_geom.lat").alias("lat"),
        G.as_text(F.col("the_geom_webmercator")).alias("the_geom_webmercator"), G.as_text(F.col("the_geom")).alias("the_geom"),
    )


# What the statistics of a path need; a stored point has no more to compute.
_PATH = ["event_id", "entity_id", "recv_time_ts", "lon", "lat"]


def _rounded_results(df: DataFrame) -> DataFrame:
    return df.drop("lon", "lat").withColumn("stageSpeed", F.coalesce("stageSpeed", F.lit(-1.0)))


def trajectory_stats(spark, d):
    """Distance, time and speed statistics per entity, as stored."""
    points = store(_points(spark, d), "points")
    out = TR.trajectory(points, ["entity_id"], "event_id", scale=3)
    full = TR.trajectory_layout(_rounded_results(out).drop("event_id"))
    return full.drop("the_geom_webmercator")


def trajectory_by_path(spark, d):
    """The same with one path of points per service path."""
    points = store(_points(spark, d), "points")
    out = TR.trajectory(points, ["service_path"], "event_id", scale=3)
    return _rounded_results(out).select(
        "event_id", "service_path", "cartodb_id", "stageDistance", "stageTime", "stageSpeed", "sumDistance", "sumTime",
        "sumSpeed", "maxDistance", "minDistance", "maxSpeed", "minSpeed", "numSamples",
    )


def trajectory_resume(spark, d):
    """Statistics of a second batch that continue those of the first."""
    points = store(_points(spark, d), "points")
    early = F.col("recv_time_ts") < F.lit(NOW_MS - 5 * 86_400_000)
    first = store(TR.trajectory(points.filter(early), ["entity_id"], "event_id", scale=3), "first")
    rest = TR.trajectory(
        points.filter(~early), ["entity_id"], "event_id", stored=TR.last_rows(first, ["entity_id"]), scale=3
    )
    out = first.unionByName(rest)
    return _rounded_results(out).select(
        "event_id", "entity_id", "cartodb_id", "stageDistance", "stageTime", "sumDistance", "sumTime", "sumSpeed",
        "maxTime", "minTime", "numSamples",
    )


def trajectory_moments(spark, d):
    """Running mean and variance of the stages."""
    points = store(_points(spark, d).select(*_PATH), "points")
    out = TR.trajectory(points, ["entity_id"], "event_id", scale=3, moments=True)
    return out.select("event_id", "entity_id", *[
        F.coalesce(c, F.lit(-1.0)).alias(c) for c in ("avgDistance", "varDistance", "avgTime", "varTime", "avgSpeed")
    ])


def trajectory_raw(spark, d):
    """Raw geographic rows with consecutive ids per destination."""
    opts = V2.but(data_model=O.BY_SERVICE_PATH, swap_coordinates=True)
    named = N.accepted_names(N.carto_names(event_entities(spark, d, geo=True), opts))
    raw = L.carto_raw_layout(named, [*ATTRS, "location"], opts)
    rows = store(raw.withColumns({
        "lon": F.col("the_geom.lon"), "lat": F.col("the_geom.lat"), "srid": F.col("the_geom_webmercator.srid").cast("bigint"),
    }).drop("the_geom", "the_geom_webmercator"), "raw")
    return number(TR.with_row_ids(rows, ["dest_db", "dest_table"], [M.RECV_TIME_TS, "event_id"]), "value")


def web_mercator(spark, d):
    lon, lat = A.position(F.col("user_id"), F.col("event_id"))
    point = F.concat((lat * 0.9).cast("string"), F.lit(","), lon.cast("string"))
    json = F.concat(F.lit('{"type":"Point","coordinates":['), lon.cast("string"), F.lit(","), (lat * 0.9).cast("string"), F.lit("]}"))
    ev = A.table(spark, d, "events").withColumn("kind", F.when(F.col("event_id") % 2 == 0, "geo:point").otherwise("Geo:JSON"))
    value = F.when(F.col("event_id") % 2 == 0, point).otherwise(json)
    geom = G.geometry(F.col("kind"), value, swap=True)
    out = ev.select("event_id", G.geometry_webmercator(geom, project=True).alias("g"))
    return out.select("event_id", F.round("g.lon", 2).alias("x"), F.round("g.lat", 2).alias("y"), F.col("g.srid").cast("bigint").alias("srid"))


def latest_per_destination(spark, d):
    named = N.accepted_names(N.postgresql_names(event_rows(spark, d), V2.but(data_model=O.BY_SERVICE_PATH)))
    rows = named.select("dest_db", "dest_table", "attr_name", "entity_id", "event_id", "recv_time_ts")
    return TR.latest(rows, ["dest_db", "dest_table", "attr_name"], "event_id")


# -- retention and reads ----------------------------------------------------

def _records(spark, d) -> DataFrame:
    """Stored records per event type; reception times are not in id order."""
    shift = (F.col("event_id") * 37 % 11) * 86_400_000
    return A.table(spark, d, "events").select(
        F.col("event_type").alias("dest"), F.col("event_id").alias("_id"),
        (F.unix_millis(F.col("ts").cast("timestamp")) + shift).alias("recv_ms"), "props",
    )


def page_read(spark, d):
    return H.page(_records(spark, d), 40, 25, F.col("dest") == "click")


def existing_row_counts(spark, d):
    return H.row_counts(_records(spark, d), ("dest",))


def retain_newest(spark, d):
    return R.retain_newest(_records(spark, d), ["dest"], 500)


def retain_age(spark, d):
    return R.retain_age(_records(spark, d), F.col("recv_ms"), NOW_MS, 10 * 86_400)


def retain_prefix(spark, d):
    """ISO reception times are read back and the expired prefix is dropped."""
    records = _records(spark, d).withColumn("recvTime", F.date_format(F.timestamp_millis("recv_ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    kept = R.retain_after_prefix(records, ["dest"], T.milliseconds(F.col("recvTime")), NOW_MS + 10 * 86_400_000, 7 * 86_400)
    return kept


def retain_bytes(spark, d):
    return R.retain_capped(_records(spark, d), ["dest"], F.octet_length("props"), 6_000, 900)


def delete_by_id(spark, d):
    doomed = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("_id"))
    return R.delete_records(_records(spark, d), doomed.filter(F.col("_id") % 2 == 0), ["_id"])


# -- catalogue --------------------------------------------------------------

_METADATA = {
    "organizationName": "CASE WHEN event_id % 7 < 5 THEN 'Sales Org' ELSE 'Other Org' END",
    "packageName": "concat('pkg ', event_id % 7)",
    "packageDescription": "concat('Orders of group ', event_id % 7)",
    "keywords": "concat('orders,group', event_id % 7)",
    "themes": "'economy,trade'",
    "contactName": "CASE WHEN event_id % 7 > 3 THEN 'Ann' END",
    "visibility": "'public'",
    "version": "'1.0'",
    "landingPage": "'https://example.org/orders'",
    "format": "'JSON'",
    "downloadURL": "concat('https://example.org/', event_id % 7, '/', event_id % 14)",
    "resourceName": "concat('res ', event_id % 14)",
}


def _catalog_events(spark, d) -> DataFrame:
    raw = C.enrich(A.order_notifications(orders(spark, d)), _METADATA)
    listed = C.catalog_columns(raw)
    entities = P.entity_rows(P.parse(listed, LD))
    return N.ckan_names(entities, LD.but(enable_lowercase=False, enable_encoding=False))


def catalog_packages(spark, d):
    out = C.package_records(_catalog_events(spark, d))
    extras = F.transform("extras", lambda e: F.concat_ws("=", e["key"], F.coalesce(e["value"], F.lit("-"))))
    return out.select(
        "name", "owner_org", "notes", "title", "version", "url", "visibility",
        F.array_join(extras, ";").alias("extras"), F.array_join(F.col("tags.name"), ";").alias("tags"),
    )


def catalog_resources(spark, d):
    out = C.resource_records(_catalog_events(spark, d))
    return out.select("package_id", "owner_org", "name", "format", "download_url", "url")


def catalog_organizations(spark, d):
    return C.organization_records(_catalog_events(spark, d))


def catalog_missing(spark, d):
    """What has to be created, given part of the catalogue."""
    named = _catalog_events(spark, d).select("org_name", "pkg_name", "res_name")
    nation = A.table(spark, d, "nation")
    n = F.col("n_nationkey")
    org = F.when(n % 7 < 5, "sales_org").otherwise("other_org").alias("org_name")
    orgs = nation.filter(n < 4).select(F.when(n % 2 == 0, "sales_org").otherwise("spare_org").alias("org_name")).distinct()
    pkgs = nation.filter(n < 4).select(org, F.concat(F.lit("pkg_"), n.cast("string")).alias("pkg_name"))
    ress = nation.filter(n < 9).select(
        org, F.concat(F.lit("pkg_"), (n % 7).cast("string")).alias("pkg_name"),
        F.concat(F.lit("res "), n.cast("string")).alias("res_name"), F.concat(F.lit("id-"), n.cast("string")).alias("res_id"),
    )
    out = C.lookup_or_create(named, orgs, pkgs, ress)
    return out.select("org_name", "pkg_name", "res_name", F.coalesce("create_from", F.lit("")).alias("create_from"), F.coalesce("res_id", F.lit("")).alias("res_id"))


def catalog_join(spark, d):
    """Catalogue metadata from a table, keyed by customer segment."""
    ev = A.table(spark, d, "orders").join(A.table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    ev = ev.select("o_orderkey", F.col("c_mktsegment").alias("segment"), "c_nationkey")
    nation = A.table(spark, d, "nation").filter(F.col("n_nationkey") < 20).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("publisher"))
    out = C.join_catalog(ev, nation, ["c_nationkey"])
    return out.select("o_orderkey", "segment", F.coalesce("publisher", F.lit("none")).alias("publisher"))


def _vocabulary_use(spark, d) -> DataFrame:
    n = F.col("p_partkey") % 6
    part = A.table(spark, d, "part")
    field = F.when(n < 3, "format").when(n < 5, "mimetype").otherwise("availability")
    value = (
        F.when(n == 0, "CSV").when(n == 1, "SHP").when(n == 2, F.col("p_type")).when(n == 3, "text/csv")
        .when(n == 4, F.concat(F.lit("text/"), F.col("p_brand"))).otherwise(F.concat(F.lit("http://data.europa.eu/r5r/availability/"),
              F.when(F.col("p_size") % 2 == 0, "stable").otherwise("never")))
    )
    return part.select("p_partkey", field.alias("field"), value.alias("value"))


def vocab_invalid(spark, d):
    return C.check_vocabulary(_vocabulary_use(spark, d), spark, valid=False).select("p_partkey", "field", "value")


def vocab_valid(spark, d):
    return C.check_vocabulary(_vocabulary_use(spark, d), spark).select("p_partkey", "field", "value")


def format_lookup(spark, d):
    """Description and mime type of the formats in use."""
    formats = vocab.resource_formats(spark)
    used = _vocabulary_use(spark, d).filter(F.col("field") == "format")
    out = used.join(F.broadcast(formats), used["value"] == formats["format"], "left")
    return out.select("p_partkey", "value", F.coalesce("description", F.lit("")).alias("description"), F.coalesce("mimetype", F.lit("")).alias("mimetype"))


# -- the rest ---------------------------------------------------------------

def new_columns(spark, d):
    """Columns that every destination has to add."""
    rows = event_rows(spark, d).select(F.col("service_path").alias("dest"), F.initcap("attr_name").alias("column"))
    ev = A.table(spark, d, "events")
    existing = ev.select(F.concat(F.lit("/"), F.col("event_type")).alias("dest"), F.lit("value").alias("column")).unionByName(
        ev.filter(F.col("event_type") == "view").select(F.concat(F.lit("/"), F.col("event_type")).alias("dest"), F.lit("kind").alias("column"))
    ).distinct()
    return evolve.new_column_rows(rows, existing, ["dest"], "column")


def typed_params(spark, d):
    o = A.table(spark, d, "orders")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("boolean", "string", "integer", "float", "date")]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    value = F.when(F.col("o_orderkey") % 5 == 0, F.when(F.col("o_custkey") % 2 == 0, "TRUE").otherwise("no")).when(
        F.col("o_orderkey") % 10 == 2, F.col("o_custkey").cast("string")).when(
        F.col("o_orderkey") % 10 == 3, F.col("o_totalprice").cast("string")).otherwise(F.col("o_orderpriority"))
    props = o.select("o_orderkey", F.concat(F.lit("cypher.param."), kind, F.lit(".p"), (F.col("o_orderkey") % 3).cast("string")).alias("key"), value.alias("value"))
    out = params.typed_param_rows(props, "key", "value")
    return out.select(
        "o_orderkey", "param_type", "param_name", F.coalesce(F.col("boolean_value").cast("bigint"), F.lit(-1).cast("bigint")).alias("boolean_value"),
        F.coalesce(F.col("integer_value").cast("bigint"), F.lit(-1).cast("bigint")).alias("integer_value"),
        F.coalesce("float_value", F.lit(-1.0)).alias("float_value"), F.coalesce("string_value", F.lit("")).alias("string_value"),
        F.col("invalid").cast("bigint").alias("invalid"),
    )


def _fragment_rows(lineitem: DataFrame) -> DataFrame:
    """Order lines as fragments of a transaction, some of them broken."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    bad = key % 40
    count = F.when(bad == 1, F.lit(None)).when(bad == 2, "two").when(bad == 3, "0").when(bad == 4, line.cast("string")).otherwise((key % 7 + 1).cast("string"))
    index = F.when(bad == 5, F.lit(None)).when(bad == 6, "x1").when(bad == 7, (-line).cast("string")).when(bad == 8, "3").otherwise((line - 1).cast("string"))
    return lineitem.select(
        key.cast("string").alias("fragment_identifier"), index.cast("string").alias("fragment_index"),
        count.cast("string").alias("fragment_count"), (F.lit(NOW_MS) - (key % 100) * 1000).alias("last_queue_ts"),
    )


def _fragments(spark, d) -> DataFrame:
    return _fragment_rows(A.table(spark, d, "lineitem"))


def fragments_status(spark, d):
    out = FR.fragment_status(_fragments(spark, d), NOW_MS, 50_000)
    return out.withColumn("reason", F.coalesce("reason", F.lit("")))


def fragments_ready(spark, d):
    pieces = _fragments(spark, d)
    ready = FR.split_by_status(pieces, FR.fragment_status(pieces, NOW_MS, 50_000))[FR.READY]
    return ready.select("fragment_identifier", F.coalesce("fragment_index", F.lit("")).alias("fragment_index"))


def json_valid(spark, d):
    ev = A.table(spark, d, "events")
    text = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(
        F.col("event_id") % 3 == 1, F.substring("props", F.lit(1), (F.col("event_id") % 11 + 1).cast("int"))).otherwise(
        F.concat(F.lit("["), (F.col("event_id") % 5).cast("string"), F.when(F.col("event_id") % 2 == 0, "]").otherwise("")))
    return ev.select("event_id", P.is_valid_json(text).cast("bigint").alias("valid"))


def sql_functions(spark, d):
    """The scalar functions called from SQL."""
    SQL.register(spark)
    A.table(spark, d, "events").createOrReplaceTempView("ctx_events")
    return spark.sql(
        "SELECT event_id, ctx_encode_postgresql(concat('/', event_type, '=X', user_id)) AS name, "
        "ctx_human_readable(unix_millis(CAST(ts AS TIMESTAMP))) AS recv, "
        "date_format(ctx_bucket_origin(CAST(ts AS TIMESTAMP), 'hour'), 'yyyy-MM-dd HH:mm:ss') AS origin, "
        "CAST(ctx_bucket_offset(CAST(ts AS TIMESTAMP), 'day') AS BIGINT) AS slot, ctx_bucket_range('minute') AS bucket_range, "
        "round(ctx_geo_distance(0D, 0D, CAST(user_id AS DOUBLE), 45D) / 1000, 3) AS km FROM ctx_events"
    )


def v2_hostile_input(spark, d):
    """Notifications that must not end a job: repeated attributes, nothing
    inside, texts that only look like numbers, headers twice, broken JSON."""
    case = F.col("event_id") % 8
    x = F.when(case == 2, F.lit('"NaN"')).when(case == 3, F.lit('"3d"')).when(case == 4, F.lit("1e400")).otherwise(
        F.col("event_id").cast("string"))
    attribute = F.concat(F.lit('"x":{"type":"Number","value":'), x, F.lit(',"metadata":{}}'))
    members = F.when(case == 0, F.concat_ws(",", attribute, attribute)).otherwise(attribute)
    body = (
        F.when(case == 1, F.lit('{"data":[]}')).when(case == 6, F.lit('{"data":[{"id":'))
        .otherwise(F.concat(F.lit('{"data":[{"id":"e","type":"T",'), members, F.lit("}]}")))
    )
    headers = F.when(case == 5, F.create_map(F.lit("Fiware-Service"), F.lit("first"), F.lit("fiware-service"), F.lit("second"))).otherwise(
        F.create_map(F.lit("Fiware-Service"), F.lit("web")))
    raw = A.table(spark, d, "events").select("event_id", headers.alias("headers"), body.alias("body"), F.col("ts").cast("timestamp").alias("ingest_ts"))
    attributes = F.flatten(F.transform("entities", lambda e: e["attrs"]))
    return P.parse(raw, V2).select(
        "event_id", "service", F.coalesce("reject_reason", F.lit("accepted")).alias("outcome"),
        F.coalesce(F.size(attributes), F.lit(0)).cast("bigint").alias("n_attrs"),
        B.numeric_value(F.get(attributes, F.lit(0))["value"]).alias("number"),
    )


def header_capture(spark, d):
    """Protocol headers, tenant defaults and correlation ids."""
    n = F.col("event_id") % 4
    pairs = F.when(n == 0, F.create_map(F.lit(M.HEADER_SERVICE.upper()), F.col("event_type"), F.lit(M.HEADER_CORRELATOR), F.lit("c-1"))).when(
        n == 1, F.create_map(F.lit(M.HEADER_SERVICE), F.lit("Nd"), F.lit(M.HEADER_SERVICE_PATH.upper()), F.lit("/ND"))).when(
        n == 2, F.create_map(F.lit("Accept"), F.lit("*/*"), F.lit(M.HEADER_SERVICE_PATH), F.lit("/a"))).otherwise(
        F.create_map(F.lit(M.HEADER_SERVICE), F.lit("s"), F.lit(M.HEADER_SERVICE_PATH), F.concat(F.lit("/"), F.col("event_type"))))
    ev = A.table(spark, d, "events").select("event_id", pairs.alias("headers"), F.col("ts").cast("timestamp").alias("ingest_ts"))
    out = P.with_event_columns(ev)
    return out.select(
        "event_id", "service", F.array_join("service_paths", ",").alias("path"), "recv_time_ts",
        (F.length("correlator") == 36).cast("bigint").alias("generated"), F.size(P.capture_headers(F.col("headers"))).cast("bigint").alias("kept"),
    )


# -- stored tables ----------------------------------------------------------

_DAILY = {"partitions": ("recv_day",), "order": ("dest", "_id"), "time_ms": "recv_ms"}


def _stored_records(spark, d) -> tuple[str, DataFrame]:
    """The records as a table of versions: two appends, partitioned by day."""
    root = work_dir(spark, "store")
    records = files.with_day(_records(spark, d), "recv_ms")
    for part in (0, 1):
        V.commit(spark, root, {"records": records.filter(F.col("_id") % 2 == part)}, **_DAILY)
    return root, records


def _stored(spark, root: str) -> DataFrame:
    return V.read(spark, root, "records").select("dest", "_id", "recv_ms", "props")


def stored_retention(spark, d):
    """The newest records of each destination, kept in the stored table."""
    root, _ = _stored_records(spark, d)
    MT.keep_newest(spark, root, "records", ["dest"], 500, **_DAILY)
    return _stored(spark, root)


def stored_age(spark, d):
    root, _ = _stored_records(spark, d)
    MT.drop_expired(spark, root, "records", NOW_MS, 10 * 86_400, **_DAILY)
    return _stored(spark, root)


def stored_prefix(spark, d):
    root, _ = _stored_records(spark, d)
    MT.drop_prefix(spark, root, "records", ["dest"], NOW_MS + 10 * 86_400_000, 7 * 86_400, **_DAILY)
    return _stored(spark, root)


def stored_bytes(spark, d):
    root, _ = _stored_records(spark, d)
    MT.keep_capped(spark, root, "records", ["dest"], F.octet_length("props"), 6_000, 900, **_DAILY)
    return _stored(spark, root)


def stored_delete(spark, d):
    root, _ = _stored_records(spark, d)
    doomed = A.table(spark, d, "orders").filter(F.col("o_orderkey") % 2 == 0).select(F.col("o_orderkey").alias("_id"))
    MT.delete_records(spark, root, "records", doomed, ["_id"], **_DAILY)
    return _stored(spark, root)


def file_statistics(spark, d):
    """What the list of a store's files says about each day."""
    root, _ = _stored_records(spark, d)
    listed = V.file_list(spark, root).withColumn("day", F.regexp_extract("path", "recv_day=([0-9-]+)", 1))
    return listed.groupBy("day").agg(F.sum("n_rows").alias("n_rows"), F.min("low").alias("low"), F.max("high").alias("high"))


def atomic_append(spark, d):
    """History, dead letters and misnamed rows of two batches in one version each.
    A batch that is repeated adds nothing; one that dies between two tables is seen
    by nobody."""
    root = work_dir(spark, "atomic")
    raw = A.event_notifications(events(spark, d))
    body = F.when(F.col("event_id") % 5 == 0, F.substring("body", F.lit(1), F.lit(40))).otherwise(F.col("body"))
    raw = raw.withColumn("body", body)
    for batch, token in ((0, "batch-0"), (1, "batch-1"), (1, "batch-1")):
        outcome = history(raw.filter(F.col("event_id") % 2 == batch), "postgresql", V2)
        tables = {"history": files.with_day(outcome.accepted), "dead_letter": outcome.rejects.select("event_id", "reject_reason")}
        V.commit(spark, root, tables, token=token)
    V.read(spark, root, "history").write.parquet(f"{root}/data/history/commit=died")
    stored = V.read(spark, root, "history").select("event_id", M.ATTR_NAME, F.lit("").alias("reject_reason"))
    return stored.unionByName(V.read(spark, root, "dead_letter").withColumn(M.ATTR_NAME, F.lit("")))


def continued_ids(spark, d):
    """Column items whose numbers go on over three appends, one of them repeated."""
    root = work_dir(spark, "items")
    for batch in (0, 1, 1, 2):
        raw = A.event_notifications(events(spark, d).filter(F.col("event_id") % 3 == batch))
        items = history(raw, "dynamo", V2, "column", ATTRS).accepted
        IDS.append_with_ids(spark, root, "items", items, ["dest_table"], ["event_id"], "ID", token=f"batch-{batch}")
    return V.read(spark, root, "items").select("event_id", M.ENTITY_ID, "ID")


def ellipsoid_distance(spark, d):
    """Distances on the ellipsoid as columns and from SQL, and a path measured so."""
    SQL.register(spark)
    _points(spark, d).createOrReplaceTempView("ctx_points")
    one = spark.sql("SELECT event_id, lon, lat, ctx_geo_distance_ellipsoid(lon, lat, -3.7D, 40.4D) / 1000 AS km FROM ctx_points")
    two = G.distance_ellipsoid_m(F.col("lon"), F.col("lat"), F.lit(0.0), F.lit(-90.0)) / 1000
    return one.select("event_id", F.round("km", 3).alias("km"), F.round(two, 3).alias("pole_km"))


def trajectory_ellipsoid(spark, d):
    points = store(_points(spark, d).select(*_PATH), "points")
    out = TR.trajectory(points, ["entity_id"], "event_id", scale=3, measure="ellipsoid")
    return out.select("event_id", "entity_id", "stageDistance", "sumDistance")


# -- streams ----------------------------------------------------------------

def _in_parts(spark, rows: DataFrame, part: Column, out: str, job, narrow: bool = False) -> None:
    """``job`` (a stream to a started query) over ``rows`` that land in three parts,
    each written by as many tasks as the table has. The job ends when a part is done
    and starts anew with the next one, from its checkpoint. ``narrow`` rows are written
    to all parts at once; others are sorted by part before, which holds less in memory."""
    with files.open_folders(spark, 3) if narrow else nullcontext():
        rows.withColumn("_part", part).write.partitionBy("_part").parquet(f"{out}/parts")
    for number in range(3):
        files.move(spark, f"{out}/parts/_part={number}", f"{out}/landed/{number}")
        landed = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{out}/landed")
        job(landed).awaitTermination()


def _events_in_parts(spark, d, out: str, job, mixed: bool = False) -> None:
    """The events in three parts: in order of time, or ``mixed``, so that most
    rows come late."""
    events = A.table(spark, d, "events")
    place = F.unix_millis(F.col("ts").cast("timestamp"))
    if mixed:
        part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    else:
        low, high = events.select(place.cast("double").alias("ms")).approxQuantile("ms", [0.33, 0.66], 0.01)
        part = F.when(place <= low, 0).when(place <= high, 1).otherwise(2)
    # Spread as the table is: a part has as few files, and is parsed by as few tasks.
    count = A.pieces(events)
    _in_parts(spark, events, part, out, lambda s: job(s.repartition(count, "event_id") if count else s))


def _run(spark, d, out, write, mixed: bool = False, of=lambda stream: stream, **routes) -> None:
    """A job over the events whose batches ``write`` handles; ``of`` is what is
    done to the stream before."""
    _events_in_parts(spark, d, out, lambda s: runtime.start(of(s), write, out, f"{out}/checkpoint", every=None, **routes), mixed)


def stream_row_history(spark, d):
    """The row history, ingested by a stream."""
    out = work_dir(spark, "stream-rows")
    write = SH.history_writer(out, "postgresql", V2)
    _run(spark, d, out, lambda b, i: write(A.event_notifications(b), i))
    return split_value(runtime.read_committed(spark, out, "history").drop("batch_id"))


def stream_dead_letter(spark, d):
    """Notifications a stream could not accept, with their reasons."""
    out = work_dir(spark, "stream-dead")
    write = SH.history_writer(out, "postgresql", V2)

    def damaged(batch: DataFrame, batch_id: int) -> None:
        raw = A.event_notifications(batch)
        cut = F.when(F.col("event_id") % 5 == 0, F.substring("body", F.lit(1), F.lit(40))).otherwise(F.col("body"))
        write(raw.withColumn("body", cut), batch_id)

    _run(spark, d, out, damaged)
    dead = runtime.read_committed(spark, out, "dead_letter").select("event_id", "reject_reason")
    alive = runtime.read_committed(spark, out, "history").select("event_id", F.lit("accepted").alias("reject_reason")).distinct()
    return dead.unionByName(alive)


def stream_versions(spark, d):
    """A stream whose batches are one version each, of history and dead letters
    together; every batch comes twice."""
    out = work_dir(spark, "stream-versions")
    write = SH.version_writer(f"{out}/store", "events", "postgresql", V2)

    def damaged_twice(batch: DataFrame, batch_id: int) -> None:
        raw = A.event_notifications(batch)
        cut = F.when(F.col("event_id") % 5 == 0, F.substring("body", F.lit(1), F.lit(40))).otherwise(F.col("body"))
        for _ in range(2):
            write(raw.withColumn("body", cut), batch_id)

    _run(spark, d, out, damaged_twice)
    dead = V.read(spark, f"{out}/store", "dead_letter").select("event_id", "reject_reason")
    stored = V.read(spark, f"{out}/store", "history").groupBy("event_id").agg(F.count("*").alias("n_rows"))
    alive = stored.select("event_id", F.concat(F.lit("accepted "), "n_rows").alias("reject_reason"))
    return dead.unionByName(alive)


def stream_buckets(spark, d):
    """Partial buckets of a stream, merged on reading."""
    out = work_dir(spark, "stream-buckets")

    def rows_of(batch: DataFrame) -> DataFrame:
        rows = P.attribute_rows(P.parse(A.event_notifications(batch)))
        return rows.select("entity_id", "attr_name", "recv_time_ts", B.numeric_value(F.col("attr_value")).alias("value"))

    write = SB.bucket_writer(out, rows_of, _BUCKET_KEYS, resolutions=("minute", "day"))
    _run(spark, d, out, write)
    return _bucket_columns(SB.read_buckets(spark, out, _BUCKET_KEYS).drop("last_ts"))


def stream_occurrences(spark, d):
    """Partial occurrences of a stream of mixed rows, merged on reading."""
    out = work_dir(spark, "stream-occurrences")

    def rows_of(batch: DataFrame) -> DataFrame:
        rows = P.attribute_rows(P.parse(A.event_notifications(batch)))
        return rows.filter(F.col("attr_name") == "kind").select("entity_id", "attr_value", "recv_time_ts")

    write = SB.categorical_writer(out, rows_of, ["entity_id"], "attr_value", resolutions=("hour", "day", "month"))
    _run(spark, d, out, write, mixed=True)
    merged = SB.read_occurrences(spark, out, ["entity_id"], "attr_value")
    return merged.drop("last_ts").withColumns({"origin": iso("origin"), "offset": F.col("offset").cast("bigint")})


def stream_trajectory(spark, d):
    """Trajectory statistics whose last rows are the state of the stream."""
    out = work_dir(spark, "stream-trajectory")

    def of(stream: DataFrame) -> DataFrame:
        return ST.trajectory_stream(_points(spark, d, A.event_notifications(stream, geo=True)), ["entity_id"], "event_id", scale=3)

    _run(spark, d, out, ST.trajectory_writer(out), of=of)
    return _rounded_results(runtime.read_committed(spark, out, "trajectory")).select(
        "event_id", "entity_id", "cartodb_id", "stageDistance", "stageTime", "sumDistance", "sumTime", "sumSpeed",
        "maxTime", "minTime", "numSamples",
    )


def stream_fragments(spark, d):
    """Complete transactions assembled by a stream."""
    out = work_dir(spark, "stream-fragments")
    schema = A.table(spark, d, "lineitem").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(d)
    write = SF.fragment_writer(out)
    runtime.start(SF.assemble(_fragment_rows(stream)), write, out, f"{out}/checkpoint", every=None).awaitTermination()
    ready = runtime.read_committed(spark, out, "ready")
    return ready.select("fragment_identifier", F.coalesce("fragment_index", F.lit("")).alias("fragment_index"))


def stream_fragments_mixed(spark, d):
    """Transactions whose fragments come in three mixed parts: complete ones, and
    broken ones with their reasons. What is never complete goes on waiting."""
    out = work_dir(spark, "stream-mixed")
    of_order = Window.partitionBy("l_orderkey")
    # In this order one sort serves both.
    lines = A.table(spark, d, "lineitem").select(
        "l_orderkey", F.row_number().over(of_order.orderBy("l_linenumber")).alias("line"))
    lines = lines.select("*", F.count("*").over(of_order).alias("n"))
    bad, line = F.col("l_orderkey") % 40, F.col("line")
    count = F.when(bad == 1, "two").when(bad == 2, "0").when(bad == 3, (F.col("n") + line).cast("string")).when(
        bad < 10, (F.col("n") + 1).cast("string")).otherwise(F.col("n").cast("string"))
    index = F.when(bad == 10, F.lit(None)).when(bad == 11, "x1").when(bad == 12, (-line).cast("string")).when(bad == 13, "0").otherwise(
        (line - 1).cast("string"))
    pieces = lines.select(
        F.col("l_orderkey").cast("string").alias("fragment_identifier"), index.alias("fragment_index"), count.alias("fragment_count"))
    part = F.pmod(F.xxhash64("fragment_identifier", F.monotonically_increasing_id()), F.lit(3))
    write = SF.fragment_writer(out)
    _in_parts(spark, pieces, part, out, lambda s: runtime.start(SF.assemble(s), write, out, f"{out}/checkpoint", every=None), narrow=True)
    return runtime.read_committed(spark, out, "ready").unionByName(runtime.read_committed(spark, out, "invalid")).select(
        "fragment_identifier", *[F.coalesce(c, F.lit("")).alias(c) for c in ("fragment_index", "fragment_count", "reason")])


def failed_rows(spark, d):
    """Rows that their own data keeps from being stored are told apart, the rest
    of their batches is committed."""
    out = work_dir(spark, "failed-rows")

    text = F.when(F.col("event_id") % 4999 == 7, "3x").otherwise(F.col("value").cast("string"))

    def typed(batch: DataFrame, batch_id: int) -> None:
        files.write_batch(batch.select("event_id", text.cast("double").alias("value")), f"{out}/history", batch_id)

    typed.reason = lambda batch: F.when(text.isNotNull() & text.try_cast("double").isNull(), "not a number")
    _run(spark, d, out, typed, mixed=True, faults=(NumberFormatException,))
    stored = runtime.read_committed(spark, out, "history").select("event_id", F.lit("committed").alias("outcome"))
    return stored.unionByName(runtime.read_committed(spark, out, "failed").select("event_id", F.lit("failed").alias("outcome")))


def stream_live_buckets(spark, d):
    """Day buckets in keyed state, of rows that come late and mixed."""
    out = work_dir(spark, "stream-live")

    def of(stream: DataFrame) -> DataFrame:
        rows = stream.select("event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("recv_time_ts"), "value")
        return SL.live_buckets(rows, ["event_type"], 2 * 86_400_000, resolutions=("day",))

    _run(spark, d, out, SL.live_writer(out), mixed=True, of=of)
    final = SL.read_live(spark, out, ["event_type"])
    return _bucket_columns(final).select("event_type", "resolution", "range", "origin", "offset", "samples", "sum", "sum2", "min", "max")


def stream_live_months(spark, d):
    """Live buckets of users at three resolutions, months among them; the events
    come in order, so that buckets close while the stream runs."""
    out = work_dir(spark, "stream-months")

    def of(stream: DataFrame) -> DataFrame:
        rows = P.attribute_rows(P.parse(A.event_notifications(stream)))
        numbers = rows.select("entity_id", "attr_name", "recv_time_ts", B.numeric_value(F.col("attr_value")).alias("value"))
        return SL.live_buckets(numbers, _BUCKET_KEYS, 3_600_000, resolutions=("hour", "day", "month"))

    _run(spark, d, out, SL.live_writer(out), of=of)
    return _bucket_columns(SL.read_live(spark, out, _BUCKET_KEYS).drop("last_ts"))


QUERIES = [
    v2_row_history, v2_column_history, v2_discovered_columns, v2_column_map, v2_ckan_compat_rows, v2_metadata_rows,
    v2_time_instant, v2_multi_path, v2_rejects, ld_column_history, ld_attribute_rows, ld_edges, ld_nodes,
    mysql_rows, cassandra_rows, dynamo_items, dynamo_column_items, mongo_docs_by_path, mongo_docs_by_attribute,
    mongo_column_docs, ckan_records, ckan_row_records, ckan_fields, ckan_upsert,
    hdfs_json_rows, hdfs_json_columns, hdfs_csv_rows, hdfs_csv_columns, hdfs_md_files, hdfs_csv_row_side_files, hdfs_csv_column_side_files, external_table_scan,
    encode_all, destination_names, document_store_names, catalog_names, destination_counts, destination_columns, destinations,
    bucket_numeric, bucket_hot_path, bucket_merge, bucket_dense, bucket_categorical, bucket_occurrences, bucket_documents, stored_documents, merged_occurrences,
    trajectory_stats, trajectory_by_path, trajectory_resume, trajectory_moments, trajectory_raw, web_mercator, latest_per_destination,
    page_read, existing_row_counts, retain_newest, retain_age, retain_prefix, retain_bytes, delete_by_id,
    catalog_packages, catalog_resources, catalog_organizations, catalog_missing, catalog_join,
    vocab_invalid, vocab_valid, format_lookup, new_columns, typed_params, fragments_status, fragments_ready,
    json_valid, sql_functions, header_capture, v2_hostile_input,
    stream_row_history, stream_dead_letter, stream_versions, stream_buckets, stream_trajectory, stream_fragments, stream_fragments_mixed, stream_live_buckets, stream_live_months, stream_occurrences,
    failed_rows, stored_retention, stored_age, stored_prefix, stored_bytes, stored_delete, file_statistics, atomic_append,
    continued_ids, ellipsoid_distance, trajectory_ellipsoid,
]
