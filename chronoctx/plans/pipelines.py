"""Whole pipelines from raw notifications to a named, stored layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoctx.functions import geo as G
from chronoctx.operators import layout as L
from chronoctx.operators import naming as N
from chronoctx.operators import parse as P
from chronoctx.operators import trajectory as T
from chronoctx.options import BY_ATTRIBUTE, Options
from chronoctx.plans.session import store as stored_copy


@dataclass(frozen=True)
class Outcome:
    """What a pipeline made of its input. Nothing is swallowed: a notification
    is in ``rejects`` or its rows are in ``accepted`` or ``misnamed``."""

    accepted: DataFrame
    rejects: DataFrame
    misnamed: DataFrame


def history(
    raw: DataFrame, store: str = "postgresql", opts: Options = Options(), persistence: str = "row",
    names: list[str] | dict[str, list[str]] | None = None,
) -> Outcome:
    """Parse, name and lay out notifications for one kind of store.

    ``names`` are the attributes that become columns in the ``column``
    persistence (LD: with their sub-attributes); without them they are looked
    up in the data, which takes one more pass over it.
    """
    return history_of(P.parse(raw, opts), store, opts, persistence, names)


def history_of(
    parsed: DataFrame, store: str = "postgresql", opts: Options = Options(), persistence: str = "row",
    names: list[str] | dict[str, list[str]] | None = None,
) -> Outcome:
    """The same for notifications that are parsed already."""
    entities = P.entity_rows(parsed)
    if opts.data_model == BY_ATTRIBUTE:
        named = N.NAMERS[store](P.explode_attributes(entities), opts)
        good = named.filter(F.col("name_reject").isNull())
        out = _row(good, store, opts)
    else:
        if persistence != "row" and names is None:
            entities = stored_copy(entities, "entities")
            names = _names(entities, opts)
        # named per entity, before the attributes multiply the rows
        named = N.NAMERS[store](entities, opts)
        valid = F.col("name_reject").isNull()
        if persistence == "row":
            # no attributes, no rows: cheaper than a filter, which would
            # evaluate the names once more below the explode
            good = named.withColumn("attrs", F.when(valid, F.col("attrs")))
            out = _row(P.explode_attributes(good), store, opts)
        else:
            out = _column(named.filter(valid), store, opts, names)
    return Outcome(out, P.rejects(parsed), N.rejected_names(named))


def _names(entities: DataFrame, opts: Options):
    rows = P.explode_attributes(entities)
    return L.discover_sub_attributes(rows) if opts.version == "ld" else L.discover_attributes(rows)


def _row(rows: DataFrame, store: str, opts: Options) -> DataFrame:
    if opts.time_instant and "md" in rows.columns:
        rows = P.use_time_instant(rows)
    if store == "mongo":
        return L.mongo_row_documents(rows, opts)
    if store == "hdfs":
        return L.json_row_lines(rows)
    if store == "cassandra":
        return L.cassandra_layout(rows)
    if store == "dynamo":
        return L.dynamo_layout(L.row_layout(rows, opts, strip_path=False))
    if store == "ckan":
        return L.ckan_row_records(rows, opts)
    return L.row_layout(rows, opts)


def _column(entities: DataFrame, store: str, opts: Options, names) -> DataFrame:
    if store == "mongo":
        return L.mongo_column_documents(entities, names, opts)
    if store == "hdfs":
        return L.json_column_lines(entities)
    if store == "ckan":
        return L.ckan_records(entities, names)
    if opts.version == "ld":
        return L.ld_column_layout(entities, names, opts)
    if store == "carto":
        return L.carto_raw_layout(entities, names, opts)
    if store == "dynamo":
        return L.dynamo_layout(L.column_layout(entities, names, opts, strip_path=False))
    return L.column_layout(entities, names, opts)


def located_points(raw: DataFrame, opts: Options = Options(), tie_breaker: str = "event_id") -> DataFrame:
    """Named positions of the entities that have a geo attribute, stored, since
    the statistics below pass over them more than once."""
    named = N.accepted_names(N.carto_names(P.entity_rows(P.parse(raw, opts)), opts))
    located = L.with_geometry(named, opts)
    points = located.select(
        "dest_db", "dest_table", tie_breaker, "entity_pos", "recv_time_ts", "service_path", "entity_id", "entity_type",
        F.col("the_geom.lon").alias("lon"), F.col("the_geom.lat").alias("lat"),
        G.as_text(F.col("the_geom")).alias("the_geom"), G.as_text(F.col("the_geom_webmercator")).alias("the_geom_webmercator"),
    )
    return stored_copy(points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()), "points")


def distance_history(
    raw: DataFrame, opts: Options = Options(), stored: DataFrame | None = None, tie_breaker: str = "event_id",
    per_entity: bool = True, **settings,
) -> DataFrame:
    """Trajectory statistics of geographic notifications.

    ``per_entity`` compares a point with the previous one of the same entity;
    without it, with the previous one of the destination. ``stored`` is an
    earlier result of this function, which is continued. ``trajectory_layout``
    gives the columns to store.
    """
    keys = ["dest_db", "dest_table"] + (["entity_id"] if per_entity else [])
    before = None if stored is None else T.last_rows(stored, keys)
    points = located_points(raw, opts, tie_breaker)
    return T.trajectory(points, keys, [tie_breaker, "entity_pos"], stored=before, **settings)
