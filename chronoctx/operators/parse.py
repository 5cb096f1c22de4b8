"""From raw notifications to entities and attributes.

A body is parsed once, in one projection, into an array of entities; a
notification with a broken part is rejected whole, with its first reason, as
the stores take a notification all or nothing. Nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoctx import model as M
from chronoctx.options import Options

_DOCUMENT = "struct<data:array<map<string,string>>>"
_OBJECT = "map<string,string>"
_OBJECTS = "map<string,map<string,string>>"

# Keys that are not attributes, LD attribute kinds and the
# sub-attributes that are plain literals.
RESERVED = {"v2": ("id", "type"), "ld": ("id", "type", "@context")}
VALUE_KINDS = ("Property", "GeoProperty")
LITERAL_SUB_ATTRIBUTES = ("observedAt", "unitCode")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_entries(entries: Column) -> Column:
    """A map of ``(key, value)`` entries; of equal keys the first one counts."""
    def is_first(entry: Column, place: Column, all_: Column) -> Column:
        return F.array_position(all_["key"], entry["key"]) == place + 1

    def build(all_: Column) -> Column:
        keys = all_["key"]
        # nearly always the keys are all different, which one pass over them tells
        return F.when(
            F.size(F.array_compact(F.array_distinct(keys))) == F.size(keys), F.map_from_entries(all_)
        ).otherwise(F.map_from_entries(
            F.filter(all_, lambda entry, place: entry["key"].isNotNull() & is_first(entry, place, all_))))

    return bind(entries, build)


def lower_headers(headers: Column) -> Column:
    """Headers under lower-case names; of names that differ by case the first counts."""
    return first_entries(F.transform(
        F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))


def capture_headers(headers: Column) -> Column:
    """Keep the three protocol headers, under lower-case names."""
    kept = (M.HEADER_SERVICE, M.HEADER_SERVICE_PATH, M.HEADER_CORRELATOR)
    return lower_headers(F.map_filter(headers, lambda k, _: F.lower(k).isin(*kept)))


def _own_correlator(df: DataFrame) -> Column:
    """A correlator made from the notification, so that every evaluation of the
    same notification gives the same one."""
    body = F.col("body") if "body" in df.columns else F.lit("")
    digest = F.md5(F.concat_ws("\n", body, F.col("ingest_ts").cast("string"), F.to_json(F.map_entries("headers"))))
    return F.concat_ws("-", *[F.substring(digest, place, length) for place, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def with_event_columns(df: DataFrame, opts: Options = Options()) -> DataFrame:
    """Tenant, paths, correlator and reception time of every notification.

    A missing service, or one sent as ``nd`` in any case, becomes the default;
    the same holds for the service path. LD notifications have no path.
    """
    headers = F.col("_headers")
    service = F.coalesce(headers[M.HEADER_SERVICE], F.lit("nd"))
    path = F.coalesce(headers[M.HEADER_SERVICE_PATH], F.lit("/nd"))
    if opts.version == "ld":
        path = F.lit("")
    return df.withColumn("_headers", capture_headers(F.col("headers"))).withColumns({
        "service": F.when(F.lower(service) == "nd", F.lit(opts.default_service)).otherwise(service),
        "service_paths": F.split(
            F.when(F.lower(path) == "/nd", F.lit(opts.default_service_path)).otherwise(path), r"\s*,\s*"
        ),
        "correlator": F.coalesce(headers[M.HEADER_CORRELATOR], _own_correlator(df)),
        "recv_time_ts": F.unix_millis("ingest_ts"),
    }).drop("_headers")


def parse(df: DataFrame, opts: Options = Options()) -> DataFrame:
    """One row per notification with ``entities`` or a ``reject_reason``.

    ``df`` has RAW_SCHEMA plus any columns to carry along.
    """
    attribute = _v2_attribute if opts.version == "v2" else _ld_attribute
    reserved = RESERVED[opts.version]

    def entity(item: Column) -> Column:
        attributes = F.map_entries(F.map_filter(item, lambda k, _: ~k.isin(*reserved)))
        return F.struct(
            item["id"].alias("id"), item["type"].alias("type"),
            F.transform(attributes, attribute).alias("attrs"),
        )

    data = F.from_json("body", _DOCUMENT)["data"]
    paths = F.col("service_paths")
    checked = bind(
        F.transform(data, entity),
        lambda entities: bind(
            _event_problem(entities, paths),
            lambda problem: F.struct(
                F.when(problem.isNull(), entities).alias("entities"), problem.alias("reject_reason")
            ),
        ),
    )
    events = with_event_columns(df, opts)
    return events.withColumn("_parsed", checked).select(
        *events.columns, F.col("_parsed.entities"), F.col("_parsed.reject_reason")
    )


def _repeats(entity: Column) -> Column:
    """Whether a name stands twice among the attributes."""
    names = entity["attrs"]["name"]
    return F.size(F.array_distinct(names)) < F.size(names)


def _event_problem(entities: Column, paths: Column) -> Column:
    problems = F.filter(
        F.flatten(F.transform(entities, lambda e: e["attrs"]["problem"])), lambda p: p.isNotNull()
    )
    return (
        F.when(entities.isNull(), F.lit("malformed-notification"))
        .when(F.exists(entities, lambda e: e["id"].isNull()), F.lit("entity-id-missing"))
        .when(F.exists(entities, lambda e: e["type"].isNull()), F.lit("entity-type-missing"))
        .when((F.size(paths) > 1) & (F.size(paths) != F.size(entities)), F.lit("service-path-count"))
        .when(F.exists(entities, _repeats), F.lit("attribute-repeated"))
        .otherwise(F.get(problems, F.lit(0)))
    )


def _object(text: Column) -> Column:
    """Members of a JSON object text; anything else is NULL without a try."""
    return F.when(F.startswith(text, F.lit("{")), F.from_json(text, _OBJECT))


def _text(obj: Column, key: str) -> Column:
    """Value of a key that is present; a JSON null is the text ``null``."""
    return F.when(F.map_contains_key(obj, key), F.coalesce(obj[key], F.lit("null")))


def _v2_attribute(entry: Column) -> Column:
    def build(obj: Column, md: Column) -> Column:
        broken_md = F.exists(
            F.map_values(md),
            lambda item: item.isNull() | item["type"].isNull() | ~F.map_contains_key(item, "value"),
        )
        problem = (
            F.when(obj.isNull(), F.lit("attribute-not-an-object"))
            .when(obj["type"].isNull(), F.lit("attribute-type-missing"))
            .when(~F.map_contains_key(obj, "value"), F.lit("attribute-value-missing"))
            .when(md.isNull(), F.lit("attribute-metadata-missing"))
            .when(broken_md, F.lit("metadata-item-invalid"))
        )
        items = F.transform(
            F.map_entries(md),
            lambda e: F.struct(
                e["key"].alias("name"), e["value"]["type"].alias("type"), _text(e["value"], "value").alias("value")
            ),
        )
        return F.struct(
            entry["key"].alias("name"), obj["type"].alias("type"), _text(obj, "value").alias("value"),
            items.alias("md"), obj["metadata"].alias("md_json"), problem.alias("problem"),
        )

    return bind(
        _object(entry["value"]),
        lambda obj: bind(_metadata(obj["metadata"]), lambda md: build(obj, md)),
    )


def _metadata(text: Column) -> Column:
    empty = F.create_map().cast(_OBJECTS)
    return F.when(text == "{}", empty).when(F.startswith(text, F.lit("{")), F.from_json(text, _OBJECTS))


def _ld_value(obj: Column) -> Column:
    return (
        F.when(obj["type"] == "Relationship", _text(obj, "object"))
        .when(obj["type"].isin(*VALUE_KINDS), _text(obj, "value"))
    )


def _ld_problem(obj: Column, prefix: str) -> Column:
    return (
        F.when(obj.isNull(), F.lit(f"{prefix}-not-an-object"))
        .when(obj["type"].isNull(), F.lit(f"{prefix}-type-missing"))
        .when(
            obj["type"].isin("Relationship", *VALUE_KINDS) & _ld_value(obj).isNull(),
            F.lit(f"{prefix}-value-missing"),
        )
    )


def _ld_attribute(entry: Column) -> Column:
    def sub_attribute(item: Column) -> Column:
        literal = item["key"].isin(*LITERAL_SUB_ATTRIBUTES)
        return bind(
            F.when(~literal, _object(item["value"])),
            lambda obj: F.struct(
                item["key"].alias("name"),
                F.when(~literal, obj["type"]).alias("type"),
                F.when(literal, item["value"]).otherwise(_ld_value(obj)).alias("value"),
                F.when(~literal, _ld_problem(obj, "sub-attribute"))
                .when(item["value"].isNull(), F.lit("sub-attribute-value-missing")).alias("problem"),
            ),
        )

    def build(obj: Column, subs: Column) -> Column:
        sub_problems = F.filter(subs["problem"], lambda p: p.isNotNull())
        return F.struct(
            entry["key"].alias("name"), obj["type"].alias("type"), _ld_value(obj).alias("value"),
            F.transform(
                subs, lambda s: F.struct(s["name"].alias("name"), s["type"].alias("type"), s["value"].alias("value"))
            ).alias("sub_attrs"),
            F.coalesce(_ld_problem(obj, "attribute"), F.get(sub_problems, F.lit(0))).alias("problem"),
        )

    def sub_attributes(obj: Column) -> Column:
        nested = F.map_filter(obj, lambda k, _: ~k.isin("type", "value"))
        return F.when(
            obj["type"] == "Property", F.transform(F.map_entries(nested), sub_attribute)
        ).otherwise(F.array().cast("array<struct<name:string,type:string,value:string,problem:string>>"))

    return bind(
        _object(entry["value"]),
        lambda obj: bind(sub_attributes(obj), lambda subs: build(obj, subs)),
    )


_INTERNAL = ("headers", "body", "ingest_ts", "service_paths", "entities", "reject_reason")


def _event_columns(parsed: DataFrame) -> list[str]:
    return [c for c in parsed.columns if c not in _INTERNAL]


def entity_rows(parsed: DataFrame) -> DataFrame:
    """One row per entity that has attributes, with them as an array."""
    entity = F.col("_entity")
    # the condition keeps the optimizer from deriving a filter that would
    # evaluate the whole parse a second time below the generator
    accepted = F.when(F.col("reject_reason").isNull(), F.col("entities"))
    rows = parsed.select(
        *_event_columns(parsed), "service_paths", F.posexplode(accepted).alias("entity_pos", "_entity")
    )
    # one path serves every entity, several go to the entity at their position
    path = F.when(F.size("service_paths") > 1, F.get("service_paths", F.col("entity_pos"))).otherwise(
        F.get("service_paths", F.lit(0))
    )
    return rows.select(
        *_event_columns(parsed), path.alias("service_path"), "entity_pos",
        entity["id"].alias("entity_id"), entity["type"].alias("entity_type"), entity["attrs"].alias("attrs"),
    ).filter(F.size("attrs") > 0)


def attribute_rows(parsed: DataFrame) -> DataFrame:
    """One row per attribute, in document order."""
    return explode_attributes(entity_rows(parsed))


def explode_attributes(entities: DataFrame) -> DataFrame:
    """One row per attribute of entity rows; what is computed per entity
    (its destination) is best added before. Entities without them give none."""
    kept = [c for c in entities.columns if c != "attrs"]
    rows = entities.select(*kept, F.posexplode("attrs").alias("attr_pos", "_attr"))
    fields = ["name", "type", "value"]
    out = [F.col("_attr")[f].alias(f"attr_{f}") for f in fields]
    names = rows.schema["_attr"].dataType.fieldNames()
    out += [F.col("_attr")[f].alias(f) for f in names if f not in (*fields, "problem")]
    return rows.select(*kept, "attr_pos", *out)


def rejects(parsed: DataFrame) -> DataFrame:
    """Notifications that were not accepted, as received, with the reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).drop("entities", "service_paths")


def metadata_rows(rows: DataFrame) -> DataFrame:
    """One row per metadata item of every attribute."""
    item = F.col("_md")
    kept = [c for c in rows.columns if c not in ("md", "md_json")]
    return rows.select(*kept, F.posexplode("md").alias("md_pos", "_md")).select(
        *kept, "md_pos",
        item["name"].alias("md_name"), item["type"].alias("md_type"), item["value"].alias("md_value"),
    )


def sub_attribute_rows(rows: DataFrame) -> DataFrame:
    """One row per sub-attribute of every LD attribute."""
    item = F.col("_sub")
    kept = [c for c in rows.columns if c != "sub_attrs"]
    return rows.select(*kept, F.posexplode("sub_attrs").alias("sub_pos", "_sub")).select(
        *kept, "sub_pos",
        item["name"].alias("sub_name"), item["type"].alias("sub_type"), item["value"].alias("sub_value"),
    )


def use_time_instant(rows: DataFrame) -> DataFrame:
    """A ``TimeInstant`` metadata item replaces the reception time."""
    instant = F.get(F.filter("md", lambda m: m["name"] == "TimeInstant"), F.lit(0))["value"]
    return rows.withColumn(
        "recv_time_ts", F.coalesce(F.unix_millis(F.try_to_timestamp(instant)), F.col("recv_time_ts"))
    )


def is_valid_json(text: Column) -> Column:
    """True for the text of a JSON object or array."""
    return F.coalesce(F.trim(text).rlike(r"^[{\[]") & F.try_parse_json(text).isNotNull(), F.lit(False))
