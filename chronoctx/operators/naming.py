"""Destination names as computed columns, one rule set per kind of store.

Every function adds its name columns plus ``name_reject`` (NULL when the names
respect the limits of the store) and, where the case exists, ``name_warning``.
Rows come in with ``service``, ``service_path``, ``entity_id``,
``entity_type`` and, for the per-attribute model, ``attr_name``.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoctx import options as O
from chronoctx.functions import encode as E
from chronoctx.options import Options

# Longest (and shortest) names of each store.
MAX_NAME = {
    "postgresql": 63, "carto": 63, "mysql": 64, "cassandra": 48,
    "dynamo": 255, "hdfs": 255, "mongo_bytes": 113, "ckan": 100,
}
MIN_NAME = {"dynamo": 3, "ckan": 2}


def _maybe_lower(value: Column, on: bool) -> Column:
    return F.lower(value) if on else value


def _join(separator: str, parts: list[Column]) -> Column:
    return F.concat(*[x for p in parts for x in (F.lit(separator), p)][1:])


def _limits(checks: list[tuple[str, Column, int, int | None]]) -> Column:
    """First broken limit of (label, length, max, min) as a reason, or NULL."""
    reasons = []
    for label, length, most, least in checks:
        reasons.append(F.when(length > most, F.lit(f"{label}-too-long")))
        if least is not None:
            reasons.append(F.when(length < least, F.lit(f"{label}-too-short")))
    return F.coalesce(*reasons)


def _model(opts: Options, choices: dict) -> object:
    if opts.data_model not in choices:
        raise ValueError(f"data model {opts.data_model!r} is not one of {sorted(choices)}")
    return choices[opts.data_model]


_ROOT_WARNING = "root path cannot be used with the service-path model"


def _path_entity_table(opts: Options, encoder) -> tuple[Column, Column]:
    """(name, warning) of the table of a v2 entity in a relational-like store."""
    path, eid, etype = (
        _maybe_lower(F.col(c), opts.enable_lowercase) for c in ("service_path", "entity_id", "entity_type")
    )
    warning = F.lit(None).cast("string")
    by_path = opts.data_model == O.BY_SERVICE_PATH
    _model(opts, {O.BY_SERVICE_PATH: 1, O.BY_ENTITY: 1})
    if opts.enable_encoding and not opts.ckan_compatible:
        parts = [path] if by_path else [path, eid, etype]
        return _join(E.CONCATENATOR, [encoder(p) for p in parts]), warning
    if by_path:
        warning = F.when(path == "/", F.lit(_ROOT_WARNING))
        return (path if opts.ckan_compatible else E.encode_old(path, delete_slash=True)), warning
    prefix = E.encode_old(path, delete_slash=True)
    entity = [eid, etype] if opts.ckan_compatible else [E.encode_old(eid), E.encode_old(etype)]
    return F.concat(F.when(prefix == "", F.lit("")).otherwise(F.concat(prefix, F.lit("_"))), _join("_", entity)), warning


def _service(opts: Options, encoder) -> Column:
    service = _maybe_lower(F.col("service"), opts.enable_lowercase)
    if opts.ckan_compatible:
        return service
    return encoder(service) if opts.enable_encoding else E.encode_old(service)


def _relational(df: DataFrame, opts: Options, store: str, encoder) -> DataFrame:
    table, warning = _path_entity_table(opts, encoder)
    named = df.withColumns({"dest_db": _service(opts, encoder), "dest_table": table, "name_warning": warning})
    return named.withColumn("name_reject", _limits([
        ("database-name", F.length("dest_db"), MAX_NAME[store], None),
        ("table-name", F.length("dest_table"), MAX_NAME[store], None),
    ]))


def postgresql_names(df: DataFrame, opts: Options = Options()) -> DataFrame:
    """Schema and table. LD tables depend on the entity id or type only, and a
    table name over the limit is a warning there instead of a reject."""
    if opts.version == "v2":
        return _relational(df, opts, "postgresql", E.encode_postgresql)
    part = _model(opts, {O.BY_ENTITY: "entity_id", O.BY_ENTITY_TYPE: "entity_type"})
    encoder = E.encode_postgresql if opts.enable_encoding else E.encode_ld_table
    named = df.withColumns({
        "dest_db": _service(opts, E.encode_postgresql),
        "dest_table": encoder(_maybe_lower(F.col(part), opts.enable_lowercase)),
    })
    return named.withColumns({
        "name_warning": F.when(F.length("dest_table") > MAX_NAME["postgresql"], F.lit("table-name-too-long")),
        "name_reject": _limits([("database-name", F.length("dest_db"), MAX_NAME["postgresql"], None)]),
    })


def carto_names(df: DataFrame, opts: Options = Options(data_model=O.BY_SERVICE_PATH)) -> DataFrame:
    return _relational(df, opts.but(ckan_compatible=False), "carto", E.encode_postgresql)


def mysql_names(df: DataFrame, opts: Options = Options()) -> DataFrame:
    return _relational(df, opts, "mysql", E.encode_mysql)


def cassandra_names(df: DataFrame, opts: Options = Options()) -> DataFrame:
    """Keyspace and table."""
    return _relational(df, opts, "cassandra", E.encode_cassandra)


def dynamo_names(df: DataFrame, opts: Options = Options()) -> DataFrame:
    table, warning = _path_entity_table(opts, E.encode_dynamo)
    named = df.withColumns({"dest_table": table, "name_warning": warning})
    return named.withColumn("name_reject", _limits(
        [("table-name", F.length("dest_table"), MAX_NAME["dynamo"], MIN_NAME["dynamo"])]
    ))


def mongo_names(df: DataFrame, opts: Options = Options(data_model=O.BY_SERVICE_PATH)) -> DataFrame:
    """Database and collection; lower-casing follows the encoding here."""
    parts = _model(opts, {
        O.BY_SERVICE_PATH: ["service_path"],
        O.BY_ENTITY: ["service_path", "entity_id", "entity_type"],
        O.BY_ATTRIBUTE: ["service_path", "entity_id", "entity_type", "attr_name"],
    })
    if opts.enable_encoding:
        db_encoder, encoder, separator = E.encode_mongo_database, E.encode_mongo_collection, E.CONCATENATOR
    else:
        db_encoder, encoder, separator = E.encode_sth_database, E.encode_sth_collection, E.OLD_CONCATENATOR
    database = F.concat(db_encoder(F.lit(opts.db_prefix)), db_encoder(F.col("service")))
    collection = F.concat(encoder(F.lit(opts.collection_prefix)), _join(separator, [encoder(F.col(p)) for p in parts]))
    named = df.withColumns({"dest_db": database, "dest_table": collection})
    # the limits hold for the names before they are lower-cased
    named = named.withColumn("name_reject", _limits([
        ("database-name", F.length("dest_db"), MAX_NAME["mongo_bytes"], None),
        ("collection-name", F.octet_length("dest_table"), MAX_NAME["mongo_bytes"], None),
    ]))
    return named.withColumns({c: _maybe_lower(F.col(c), opts.enable_lowercase) for c in ("dest_db", "dest_table")})


def hdfs_names(df: DataFrame, opts: Options = Options(), destination: Column | None = None) -> DataFrame:
    """Folder and file of an entity (and ``dest_db``, the tenant part of both);
    ``destination`` defaults to the entity id."""
    dest = F.col("entity_id") if destination is None else destination
    slash = F.when(F.col("service_path") == "/", F.lit("")).otherwise(F.lit("/"))
    if opts.enable_encoding:
        service, path, leaf = (
            E.encode_hdfs(F.col("service")), E.encode_hdfs(F.col("service_path"), allow_slashes=True),
            E.encode_hdfs(dest),
        )
    else:
        service, path, leaf = (
            E.encode_old(F.col("service")), E.encode_old(F.col("service_path"), encode_slash=False),
            E.encode_old(dest),
        )
    folder = F.concat(service, path, slash, leaf)
    named = df.withColumns({"dest_db": service, "dest_folder": folder, "_leaf": leaf})
    named = named.withColumn("dest_file", F.concat("dest_folder", F.lit("/"), "_leaf", F.lit(".txt"))).drop("_leaf")
    named = named.withColumn("name_reject", _limits([
        ("folder-name", F.length("dest_folder"), MAX_NAME["hdfs"], None),
        ("file-name", F.length("dest_file"), MAX_NAME["hdfs"], None),
    ]))
    names = ("dest_db", "dest_folder", "dest_file")
    return named.withColumns({c: _maybe_lower(F.col(c), opts.enable_lowercase) for c in names})


def hdfs_metadata_folder(dest: Column, attr_name: Column, attr_type: Column) -> tuple[Column, Column]:
    """Folder of the metadata of one attribute of a row, and the last part of its path."""
    slash = F.when(F.col("service_path") == "/", F.lit("")).otherwise(F.lit("/"))
    parent = F.concat(
        E.encode_hdfs(F.col("service")), E.encode_hdfs(F.col("service_path"), allow_slashes=True), slash
    )
    leaf = _join(E.CONCATENATOR, [E.encode_hdfs(c) for c in (dest, attr_name, attr_type)])
    return F.concat(parent, leaf), leaf


def hdfs_metadata_names(df: DataFrame, destination: Column | None = None) -> DataFrame:
    """Folder and file of the metadata of one attribute."""
    dest = F.col("entity_id") if destination is None else destination
    folder, leaf = hdfs_metadata_folder(dest, F.col("attr_name"), F.col("attr_type"))
    named = df.withColumns({"md_folder": folder, "_leaf": leaf})
    return named.withColumn("md_file", F.concat("md_folder", F.lit("/"), "_leaf", F.lit(".txt"))).drop("_leaf")


def hdfs_metadata_file(attribute: Column) -> Column:
    """File of the metadata of an attribute (a struct) of an entity row."""
    folder, leaf = hdfs_metadata_folder(F.col("entity_id"), attribute["name"], attribute["type"])
    return F.concat(folder, F.lit("/"), leaf, F.lit(".txt"))


def hive_table_name(folder: Column, file_format: str, username: str, service_as_namespace: bool = True) -> Column:
    """Name of the external table over a folder."""
    tag = {"json-row": "_row", "csv-row": "_row", "json-column": "_column", "csv-column": "_column"}[file_format]
    owner = "" if service_as_namespace else f"{username}_"
    return F.concat(E.encode_hive(F.concat(F.lit(owner), folder)), F.lit(tag))


def ckan_names(df: DataFrame, opts: Options = Options(version="ld")) -> DataFrame:
    """Organisation, package and resource of LD entities.

    When ``df`` holds the catalogue columns ``organizationName``,
    ``packageName`` and ``resourceName`` they override the derived names, but
    only while lower-casing is off.
    """
    lower = opts.enable_lowercase
    by_id = _model(opts, {O.BY_ENTITY_ID: True, O.BY_ENTITY: False})
    empty = F.lit(None).cast("string")
    given = {c: F.col(c) if c in df.columns else empty for c in ("organizationName", "packageName", "resourceName")}

    def override(field: str, fallback: Column) -> Column:
        return F.lower(fallback) if lower else F.coalesce(given[field], fallback)

    def encoded(value: Column) -> Column:
        if by_id or opts.enable_encoding:
            return E.encode_ckan(value)
        return F.lower(E.encode_old(value))

    eid, etype = (_maybe_lower(F.col(c), lower) for c in ("entity_id", "entity_type"))
    if by_id:
        resource = eid
    elif opts.enable_encoding:
        resource = _join("_", [E.encode_ckan(eid), E.encode_ckan(etype)])
    else:
        resource = _join("_", [F.lower(E.encode_old(eid)), E.encode_old(etype)])
    named = df.withColumns({
        "org_name": encoded(override("organizationName", F.col("service"))),
        "pkg_name": encoded(override("packageName", F.col("entity_id"))),
        "res_name": F.when(given["resourceName"].isNotNull(), override("resourceName", F.col("entity_id")))
        .otherwise(resource),
    })
    if by_id:
        return named.withColumn("name_reject", empty)
    checks = [("organization-name", "org_name"), ("package-name", "pkg_name")]
    limits = [(label, F.length(c), MAX_NAME["ckan"], MIN_NAME["ckan"]) for label, c in checks]
    derived = F.when(given["resourceName"].isNull(), F.length("res_name"))
    limits.append(("resource-name", derived, MAX_NAME["ckan"], MIN_NAME["ckan"]))
    return named.withColumn("name_reject", _limits(limits))


NAMERS = {
    "postgresql": postgresql_names, "mysql": mysql_names, "carto": carto_names,
    "cassandra": cassandra_names, "dynamo": dynamo_names, "mongo": mongo_names,
    "hdfs": hdfs_names, "ckan": ckan_names,
}


def accepted_names(named: DataFrame) -> DataFrame:
    return named.filter(F.col("name_reject").isNull()).drop("name_reject")


def rejected_names(named: DataFrame) -> DataFrame:
    return named.filter(F.col("name_reject").isNotNull())


def destinations(named: DataFrame, keys: tuple[str, ...] = ("dest_db", "dest_table")) -> DataFrame:
    """The distinct destinations that a batch needs to exist."""
    return named.select(*keys).distinct()


def destination_counts(named: DataFrame, keys: tuple[str, ...] = ("dest_db", "dest_table")) -> DataFrame:
    """Rows per destination (sub-batch sizes, existing-row counts)."""
    return named.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def destination_columns(named: DataFrame, keys: tuple[str, ...] = ("dest_db", "dest_table")) -> DataFrame:
    """The distinct (destination, attribute) pairs: the columns to provide."""
    return named.select(*keys, "attr_name").distinct()
