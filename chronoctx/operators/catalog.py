"""Dataset catalogue: metadata of events, packages, resources and vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoctx.functions.vocab import vocabulary
from chronoctx.operators.parse import lower_headers

# Catalogue fields of an event, in order.
FIELDS = [
    "organizationName", "organizationType", "packageDescription", "packageName",
    "contactPoint", "contactName", "contactEmail", "keywords", "publisherURL",
    "spatialUri", "spatialCoverage", "temporalStart", "temporalEnd", "themes",
    "version", "landingPage", "visibility", "datasetRights", "accessURL",
    "availability", "resourceDescription", "format", "mimeType", "license",
    "licenseType", "downloadURL", "byteSize", "resourceName", "resourceRights",
]
LIST_FIELDS = ("keywords", "themes")

# Key of every extra of a package and the field it shows.
PACKAGE_EXTRAS = {
    "publisher_type": "organizationType", "contact_uri": "contactPoint", "contact_name": "contactName",
    "contact_email": "contactEmail", "spatial_uri": "spatialUri", "spatial": "spatialCoverage",
    "temporal_start": "temporalStart", "temporal_end": "temporalEnd", "theme": "themes",
    "access_rights": "datasetRights",
}

# Properties of a resource record and the field each one shows.
RESOURCE_PROPERTIES = {
    "access_url": "accessURL", "format": "format", "availability": "availability",
    "description": "resourceDescription", "mimetype": "mimeType", "license": "license",
    "download_url": "downloadURL", "size": "byteSize", "url": "downloadURL", "rights": "resourceRights",
}


def json_list(text: Column) -> Column:
    """``a,b`` as the JSON array ``["a","b"]``."""
    return F.to_json(F.split(text, ","))


def parse_list(text: Column) -> Column:
    """Items of a JSON array text; an event without the field has none."""
    return F.coalesce(
        F.split(F.regexp_replace(text, r'[\[\]"]', ""), ","), F.array().cast("array<string>")
    )


def enrich(events: DataFrame, metadata: dict[str, str]) -> DataFrame:
    """Add catalogue metadata to the headers of every event.

    The values are SQL expressions evaluated per event (write plain text as a
    quoted literal); one that gives NULL leaves the header as it was.
    """
    unknown = set(metadata) - set(FIELDS)
    if unknown:
        raise ValueError(f"unknown catalogue fields {sorted(unknown)}")
    entries = []
    for name, expression in metadata.items():
        value = F.expr(expression).cast("string")
        entries.append(F.struct(F.lit(name).alias("key"), (json_list(value) if name in LIST_FIELDS else value).alias("value")))
    # as columns of their own, so that they are not evaluated for each header
    staged = events.withColumn("_added", F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))
    staged = staged.withColumn("_names", F.transform("_added", lambda e: F.lower(e["key"])))
    kept = F.map_filter("headers", lambda k, _: ~F.array_contains(F.col("_names"), F.lower(k)))
    return staged.withColumn("headers", F.map_concat(kept, F.map_from_entries("_added"))).drop("_added", "_names")


def catalog_columns(events: DataFrame) -> DataFrame:
    """The catalogue fields of the (case-insensitive) headers as columns."""
    lowered = events.withColumn("_lower", lower_headers(F.col("headers")))
    columns = {}
    for name in FIELDS:
        value = F.col("_lower")[name.lower()]
        columns[name] = parse_list(value) if name == "keywords" else value
    return lowered.withColumns(columns).drop("_lower")


def join_catalog(events: DataFrame, catalog: DataFrame, on: list[str]) -> DataFrame:
    """Catalogue metadata from a table instead; Spark broadcasts it when its
    size allows and joins by shuffle when not."""
    return events.join(catalog, on, "left")


def organization_records(df: DataFrame) -> DataFrame:
    return df.select(F.col("org_name").alias("name"), F.col("org_name").alias("title")).distinct()


def package_records(df: DataFrame) -> DataFrame:
    """One record per package, from named events with catalogue columns."""
    one = _one_per(df, ["org_name", "pkg_name"], FIELDS)
    extras = F.array(*[
        F.struct(F.lit(key).alias("key"), F.col(source).alias("value")) for key, source in PACKAGE_EXTRAS.items()
    ])
    return one.select(
        F.col("pkg_name").alias("name"), F.col("org_name").alias("owner_org"),
        F.col("packageDescription").alias("notes"), F.col("pkg_name").alias("title"), "version",
        F.col("landingPage").alias("url"), "visibility", "publisherURL", extras.alias("extras"),
        F.transform("keywords", lambda k: F.struct(k.alias("name"))).alias("tags"),
    )


def resource_records(df: DataFrame) -> DataFrame:
    """One record per resource, from named events with catalogue columns."""
    sources = sorted(set(RESOURCE_PROPERTIES.values()) | {"licenseType"})
    one = _one_per(df, ["org_name", "pkg_name", "res_name"], sources)
    return one.select(
        F.col("pkg_name").alias("package_id"), F.col("org_name").alias("owner_org"), F.col("res_name").alias("name"),
        *[F.col(source).alias(name) for name, source in RESOURCE_PROPERTIES.items()],
    )


def _one_per(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One set of fields per key: that of the first event that created it.

    Events are reduced to the distinct sets of fields before one is chosen.
    """
    sets = df.groupBy(*keys, *fields).agg(F.min("recv_time_ts").alias("_since"))
    choice = F.struct("_since", *fields)
    first = sets.groupBy(*keys).agg(F.min(choice).alias("_first"))
    return first.select(*keys, *[F.col("_first")[f].alias(f) for f in fields])


def missing_records(wanted: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Records to create: wanted ones that do not exist yet."""
    return wanted.join(existing.select(*keys), keys, "left_anti")


def known_records(wanted: DataFrame, existing: DataFrame, keys: list[str], id_: str) -> DataFrame:
    """Ids to reuse for the wanted records that exist."""
    return wanted.join(existing.select(*keys, id_), keys)


def lookup_or_create(
    named: DataFrame, organizations: DataFrame, packages: DataFrame, resources: DataFrame
) -> DataFrame:
    """Every wanted (organisation, package, resource) with the level from which
    on it has to be created, and the id of the resource when it exists.

    The three tables have ``org_name`` / + ``pkg_name`` / + ``res_name`` and
    ``res_id``. Creating a parent always means creating what is below it.
    """
    wanted = named.select("org_name", "pkg_name", "res_name").distinct()
    levels = [
        (organizations, ["org_name"], "_has_org"),
        (packages, ["org_name", "pkg_name"], "_has_pkg"),
        (resources, ["org_name", "pkg_name", "res_name"], "_has_res"),
    ]
    for table, keys, flag in levels:
        known = table.groupBy(*keys).agg(F.min("res_id").alias("res_id")) if flag == "_has_res" else table.select(*keys).distinct()
        wanted = wanted.join(known.withColumn(flag, F.lit(True)), keys, "left")
    create = (
        F.when(F.col("_has_org").isNull(), F.lit("organization"))
        .when(F.col("_has_pkg").isNull(), F.lit("package"))
        .when(F.col("_has_res").isNull(), F.lit("resource"))
    )
    return wanted.select(
        "org_name", "pkg_name", "res_name", create.alias("create_from"),
        F.when(create.isNull(), F.col("res_id")).alias("res_id"),
    )


def check_vocabulary(df: DataFrame, spark: SparkSession, valid: bool = True) -> DataFrame:
    """Rows of (field, value) inside or outside the controlled vocabularies.

    The vocabulary is a fixed table of under 200 rows, so it is broadcast.
    """
    how = "left_semi" if valid else "left_anti"
    return df.join(F.broadcast(vocabulary(spark)), ["field", "value"], how)
