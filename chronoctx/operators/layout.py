"""Stored layouts of parsed entities and attributes.

All column layouts are narrow projections: the attributes of an entity sit in
one row already, so no pivot and no shuffle is needed. Attribute names are
given, or found with ``discover_attributes``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoctx import model as M
from chronoctx import options as O
from chronoctx.functions import geo as G
from chronoctx.functions import times as T
from chronoctx.options import Options

# Fixed value: the text of a JSON number.
JSON_NUMBER = r"^-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?$"


def stored_path(path: Column) -> Column:
    """Service path as relational stores keep it: without slashes."""
    return F.regexp_replace(path, "/", "")


def metadata_text(md_json: Column, default: str = "[]") -> Column:
    return F.when(md_json.isNull() | md_json.isin("", "{}"), F.lit(default)).otherwise(md_json)


def _carried(df: DataFrame) -> list[str]:
    """Columns a layout carries along: keys of the caller and destinations."""
    names = ("event_id", "dest_db", "dest_table", "dest_folder", "dest_file", "md_folder", "md_file",
             "org_name", "pkg_name", "res_name")
    return [c for c in names if c in df.columns]


def _event_fields(strip_path: bool = True) -> list[Column]:
    path = F.col("service_path")
    return [
        F.col("recv_time_ts").alias(M.RECV_TIME_TS),
        T.recv_time(F.col("recv_time_ts")).alias(M.RECV_TIME),
        (stored_path(path) if strip_path else path).alias(M.SERVICE_PATH),
        F.col("entity_id").alias(M.ENTITY_ID),
        F.col("entity_type").alias(M.ENTITY_TYPE),
    ]


def row_layout(rows: DataFrame, opts: Options = Options(), strip_path: bool = True) -> DataFrame:
    """Nine columns, one row per attribute (``_id`` first in the compatible
    variant: the position of the attribute)."""
    lead = [F.col("attr_pos").cast("bigint").alias("_id")] if opts.ckan_compatible else []
    return rows.select(
        *_carried(rows), *lead, *_event_fields(strip_path),
        F.col("attr_name").alias(M.ATTR_NAME), F.col("attr_type").alias(M.ATTR_TYPE),
        F.col("attr_value").alias(M.ATTR_VALUE),
        metadata_text(F.col("md_json"), opts.md_default).alias(M.ATTR_MD),
    )


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """The all-text variant of a layout, as relational stores declare it."""
    names = columns or df.columns
    return df.withColumns({c: F.col(c).cast("string") for c in names})


def discover_attributes(rows: DataFrame) -> list[str]:
    """Attribute names in use, sorted, to become columns. Where names are many
    or not known to be few, ``column_map_layout`` is the layout to choose."""
    return [r[0] for r in rows.select("attr_name").distinct().orderBy("attr_name").collect()]


def discover_sub_attributes(rows: DataFrame) -> dict[str, list[str]]:
    """LD attribute names with the names of their sub-attributes, as above."""
    pairs = rows.select("attr_name", F.explode_outer("sub_attrs.name").alias("sub_name")).distinct()
    found = pairs.orderBy("attr_name", "sub_name").collect()
    names: dict[str, list[str]] = {}
    for attr, sub in found:
        names.setdefault(attr, [])
        if sub is not None:
            names[attr].append(sub)
    return names


def _find(items: Column, name: str) -> Column:
    return F.get(F.filter(items, lambda a: a["name"] == F.lit(name)), F.lit(0))


def _attribute_columns(names: list[str], default: str, keep: bool = True) -> list[Column]:
    out = []
    for name in names:
        attribute = _find(F.col("attrs"), name)
        md = F.when(attribute.isNotNull(), metadata_text(attribute["md_json"], default))
        out += [attribute["value"].alias(name)] + ([md.alias(f"{name}_md")] if keep else [])
    return out


def column_layout(
    entities: DataFrame, names: list[str], opts: Options = Options(), strip_path: bool = True
) -> DataFrame:
    """One row per entity: ``<attr>`` and ``<attr>_md`` per attribute name."""
    lead = [F.lit(0).cast("bigint").alias("_id")] if opts.ckan_compatible else []
    return entities.select(
        *_carried(entities), *lead, *_event_fields(strip_path), *_attribute_columns(names, opts.md_default)
    )


def column_map_layout(entities: DataFrame, opts: Options = Options(), strip_path: bool = True) -> DataFrame:
    """Column layout with a map instead of columns, for any attribute names."""
    def pairs(value) -> Column:
        return F.map_from_entries(
            F.transform("attrs", lambda a: F.struct(a["name"].alias("key"), value(a).alias("value")))
        )

    return entities.select(
        *_carried(entities), *_event_fields(strip_path),
        pairs(lambda a: a["value"]).alias("values"),
        pairs(lambda a: metadata_text(a["md_json"], opts.md_default)).alias("metadata"),
    )


def _ld_columns(names: dict[str, list[str]]) -> list[Column]:
    out = []
    for name, subs in names.items():
        attribute = _find(F.col("attrs"), name)
        out.append(attribute["value"].alias(name))
        out += [_find(attribute["sub_attrs"], sub)["value"].alias(f"{name}_{sub}") for sub in subs]
    return out


def ld_column_layout(entities: DataFrame, names: dict[str, list[str]], opts: Options = Options(version="ld")) -> DataFrame:
    """One row per LD entity: ``<attr>`` and ``<attr>_<sub>``, no path column."""
    lead = [F.lit(0).cast("bigint").alias("_id")] if opts.ckan_compatible else []
    return entities.select(
        *_carried(entities), *lead,
        T.recv_time(F.col("recv_time_ts")).alias(M.RECV_TIME),
        F.col("entity_id").alias(M.ENTITY_ID), F.col("entity_type").alias(M.ENTITY_TYPE),
        *_ld_columns(names),
    )


def ckan_records(entities: DataFrame, names: dict[str, list[str]]) -> DataFrame:
    """Catalogue records of LD entities, with ISO reception time; the internal
    type columns of the store never appear."""
    return entities.select(
        *_carried(entities),
        T.human_readable(F.col("recv_time_ts")).alias(M.RECV_TIME),
        F.col("entity_id").alias(M.ENTITY_ID), F.col("entity_type").alias(M.ENTITY_TYPE),
        *_ld_columns(names),
    )


def ckan_row_records(rows: DataFrame, opts: Options = Options()) -> DataFrame:
    """Typed row records: integer and timestamp times, JSON value and metadata.

    A value that is not JSON already is written as a JSON string.
    """
    typed = row_layout(rows, opts.but(ckan_compatible=False), strip_path=False)
    return typed.withColumns({
        M.RECV_TIME: F.timestamp_millis(F.col(M.RECV_TIME_TS)),
        M.ATTR_VALUE: json_value(F.col(M.ATTR_VALUE)),
    })


def record_fields(names: list[str]) -> list[tuple[str, str]]:
    """Declared fields of a column-mode record store: everything is text."""
    return [(name, "text") for name in names]


def infer_fields(records: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """Fields of each record store from its first record, all text.

    ``body`` holds the record as JSON text, ``keys`` identify the store, and
    the smallest ``_id`` of a store is its first record.
    """
    first = records.groupBy(*keys).agg(F.min_by(body, "_id").alias("_first"))
    return first.select(
        *keys, F.posexplode(F.json_object_keys("_first")).alias("field_pos", "field"), F.lit("text").alias("type")
    )


def mongo_row_documents(rows: DataFrame, opts: Options) -> DataFrame:
    """Row documents; columns that the collection key holds are left out."""
    fields = {
        O.BY_SERVICE_PATH: ["entity_id", "entity_type", "attr_name", "attr_type", "attr_value"],
        O.BY_ENTITY: ["attr_name", "attr_type", "attr_value"],
        O.BY_ATTRIBUTE: ["attr_type", "attr_value"],
    }[opts.data_model]
    names = {"entity_id": M.ENTITY_ID, "entity_type": M.ENTITY_TYPE, "attr_name": M.ATTR_NAME,
             "attr_type": M.ATTR_TYPE, "attr_value": M.ATTR_VALUE}
    return rows.select(
        *_carried(rows), F.timestamp_millis("recv_time_ts").alias(M.RECV_TIME),
        *[F.col(f).alias(names[f]) for f in fields],
        metadata_text(F.col("md_json"), "{}").alias("attrMetadata"),
    )


def mongo_column_documents(entities: DataFrame, names: list[str], opts: Options) -> DataFrame:
    """One document per entity with a field per attribute, without metadata."""
    if opts.data_model == O.BY_ATTRIBUTE:
        raise ValueError("column documents need a path or entity collection")
    key = (
        [F.col("entity_id").alias(M.ENTITY_ID), F.col("entity_type").alias(M.ENTITY_TYPE)]
        if opts.data_model == O.BY_SERVICE_PATH else []
    )
    return entities.select(
        *_carried(entities),
        F.timestamp_millis("recv_time_ts").alias(M.RECV_TIME), F.col("recv_time_ts").alias(M.RECV_TIME_TS),
        *key, *_attribute_columns(names, "{}", keep=False),
    )


def with_geometry(entities: DataFrame, opts: Options = Options()) -> DataFrame:
    """Adds ``the_geom`` and its web-mercator twin from the first geo attribute."""
    geo = F.get(F.filter("attrs", lambda a: G.is_geo(a["type"])), F.lit(0))
    geom = G.geometry(F.col("_geo.type"), F.col("_geo.value"), opts.swap_coordinates)
    return (
        entities.withColumn("_geo", geo)
        .withColumn("the_geom", geom)
        .withColumn("the_geom_webmercator", G.geometry_webmercator(F.col("the_geom")))
        .drop("_geo")
    )


def carto_raw_layout(entities: DataFrame, names: list[str], opts: Options = Options()) -> DataFrame:
    """Raw geographic layout: geometry pair and every attribute but the location.

    The row id is added by ``trajectory.with_row_ids``.
    """
    kept = [n for n in names if n.lower() != "location"]
    return with_geometry(entities, opts).select(
        *_carried(entities), *_event_fields(), "the_geom", "the_geom_webmercator",
        *_attribute_columns(kept, opts.md_default),
    )


def dynamo_layout(layout: DataFrame) -> DataFrame:
    """Item types of a row or column layout made with ``strip_path=False``;
    the numeric ``ID`` comes from ``trajectory.with_row_ids``."""
    return layout.withColumn(M.RECV_TIME_TS, F.col(M.RECV_TIME_TS).cast("double"))


def cassandra_layout(rows: DataFrame) -> DataFrame:
    """Row layout with one UUID key per row."""
    layout = row_layout(rows)
    return layout.select(F.uuid().alias("id"), *layout.columns)


def json_value(text: Column) -> Column:
    """JSON form of an attribute value: numbers, literals and nested values as
    they are, anything else as a JSON string."""
    number = text.rlike(JSON_NUMBER)
    literal = text.isin("true", "false", "null")
    nested = text.rlike(r"^\s*[{\[]") & F.try_parse_json(text).isNotNull()
    quoted = F.to_json(F.array(text))
    return F.when(number | literal | nested, text).otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def _json_line(fixed: list[Column], raw: list[tuple[str, Column]]) -> Column:
    """JSON object text of string columns followed by raw JSON members."""
    head = F.to_json(F.struct(*fixed))
    members = [x for name, value in raw for x in (F.lit(f',"{name}":'), value)]
    return F.concat(F.substring(head, F.lit(1), F.length(head) - 1), *members, F.lit("}"))


def _md_array(md: Column) -> Column:
    return F.coalesce(F.to_json(md), F.lit("[]"))


def json_row_lines(rows: DataFrame) -> DataFrame:
    """``json-row`` file lines: time in seconds, values as JSON."""
    fixed = [T.seconds(F.col("recv_time_ts")).cast("string").alias(M.RECV_TIME_TS)]
    fixed += _event_fields(strip_path=False)[1:]
    fixed += [F.col("attr_name").alias(M.ATTR_NAME), F.col("attr_type").alias(M.ATTR_TYPE)]
    line = _json_line(fixed, [(M.ATTR_VALUE, json_value(F.col("attr_value"))), (M.ATTR_MD, _md_array(F.col("md")))])
    return rows.select(*_carried(rows), line.alias("line"))


def json_column_lines(entities: DataFrame) -> DataFrame:
    """``json-column`` file lines: only the attributes an entity really has."""
    def member(a: Column) -> Column:
        name = F.to_json(F.array(a["name"]))
        bare = F.substring(name, F.lit(3), F.length(name) - 4)
        return F.concat(
            F.lit(',"'), bare, F.lit('":'), json_value(a["value"]), F.lit(',"'), bare, F.lit('_md":'), _md_array(a["md"])
        )

    head = F.to_json(F.struct(*_event_fields(strip_path=False)[1:]))
    line = F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.array_join(F.transform("attrs", member), ""), F.lit("}"),
    )
    return entities.select(*_carried(entities), line.alias("line"))


def _md_link(username: str, md_file: Column) -> Column:
    return F.concat(F.lit(f"hdfs:///user/{username}/"), md_file)


def _side_lines(md_file: Column, md: Column) -> Column:
    """What belongs into the side file of an attribute, as an array of records."""
    return F.transform(md, lambda item: F.struct(
        md_file.alias("md_file"), F.col("recv_time_ts").alias(M.RECV_TIME_TS), item["name"].alias("name"), item["type"].alias("type"),
        item["value"].alias("value")))


def csv_row_layout(rows: DataFrame, username: str, side: bool = False) -> DataFrame:
    """``csv-row`` columns; metadata is a link to the side file (``md_file``). With
    ``side`` the records of that file come along (``metadata``)."""
    records = [_side_lines(F.col("md_file"), F.col("md")).alias("metadata")] if side else []
    return rows.select(
        *_carried(rows), T.seconds(F.col("recv_time_ts")).alias(M.RECV_TIME_TS),
        *_event_fields(strip_path=False)[1:],
        F.col("attr_name").alias(M.ATTR_NAME), F.col("attr_type").alias(M.ATTR_TYPE),
        F.regexp_replace("attr_value", '"', "").alias(M.ATTR_VALUE),
        _md_link(username, F.col("md_file")).alias(M.ATTR_MD_FILE), *records,
    )


def csv_column_layout(entities: DataFrame, names: list[str], username: str, md_file, side: bool = False) -> DataFrame:
    """``csv-column`` columns; ``md_file(attribute)`` gives the side file name. With
    ``side`` the records of these files come along (``metadata``)."""
    # columns of their own: each attribute is looked up and its file named once
    found = {f"_at_{i}": _find(F.col("attrs"), name) for i, name in enumerate(names)}
    staged = entities.withColumns(found)
    staged = staged.withColumns({f"_file_{i}": md_file(F.col(f"_at_{i}")) for i in range(len(names))})
    out, records = [], []
    for i, name in enumerate(names):
        attribute, file = F.col(f"_at_{i}"), F.col(f"_file_{i}")
        out.append(F.regexp_replace(attribute["value"], '"', "").alias(name))
        out.append(F.when(attribute.isNotNull(), _md_link(username, file)).alias(f"{name}_md_file"))
        records.append(F.coalesce(_side_lines(file, attribute["md"]), F.array()))
    if side:
        out.append(F.concat(*records).alias("metadata"))
    return staged.select(*_carried(entities), *_event_fields(strip_path=False)[1:], *out)


def csv_metadata_layout(md_rows: DataFrame) -> DataFrame:
    """Lines of the metadata side files."""
    return md_rows.select(
        *_carried(md_rows), F.col("recv_time_ts").alias(M.RECV_TIME_TS),
        F.col("md_name").alias("name"), F.col("md_type").alias("type"), F.col("md_value").alias("value"),
    )
