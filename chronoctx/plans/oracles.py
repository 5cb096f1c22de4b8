"""The same results as plain SQL over the tables, for DuckDB.

Nothing here builds or parses a notification: the expected rows come straight
from the table columns.
"""

from __future__ import annotations

from chronoctx import model as M
from chronoctx.functions import vocab
from chronoctx.functions.geo import EARTH_RADIUS_M, FLATTENING, MERCATOR_RADIUS_M, SEMI_MAJOR_M

NOW_MS = 1705708800000
PATH = f'"{M.SERVICE_PATH}"'

# Fixed values, stated here on their own: what each encoder replaces.
DENIED = {
    "postgresql": "[^a-z0-9_]",
    "mysql": "[^A-Za-z0-9_]",
    "cassandra": "[^A-Za-z0-9_]",
    "mongo_database": r'[A-Z/\\."$=]',
    "mongo_collection": "[/$=]",
    "hdfs": "[=/]",
    "hdfs_path": "[=]",
    "dynamo": r"[^A-Za-z0-9_.\-]",
    "hive": "[^a-z0-9_]",
    "kafka": r"[^A-Za-z0-9_.\-]",
    "ckan": r"[^a-z0-9_\-]",
}
OLD_DENIED = {
    "plain": r"[^a-zA-Z0-9.\-]",
    "plain_slash": r"[^a-zA-Z0-9.\-/]",
    "ld_table": "[^a-zA-Z0-9/]",
    "sth_database": r'[=/\\.$" ]',
    "sth_collection": "[=$]",
}


def enc(text: str, kind: str) -> str:
    """Reversible encoding, character by character."""
    denied = DENIED[kind].replace("'", "''")
    escaped = f"regexp_replace({text}, 'x([0-9a-fA-F]{{4}})', 'xx\\1', 'g')"
    code = (
        "CASE WHEN unicode(c) > 65535 THEN printf('x%04xx%04x', 55296 + (unicode(c) - 65536) // 1024, "
        "56320 + (unicode(c) - 65536) % 1024) ELSE printf('x%04x', unicode(c)) END"
    )
    piece = f"CASE WHEN c = '=' THEN 'xffff' WHEN regexp_matches(c, '{denied}') THEN {code} ELSE c END"
    return f"array_to_string(list_transform(string_split({escaped}, ''), lambda c: {piece}), '')"


def old(text: str, kind: str = "plain") -> str:
    return f"regexp_replace({text}, '{OLD_DENIED[kind]}', '_', 'g')"


EV = f"""
ev AS (SELECT event_id, ts, epoch_us(ts) // 1000 AS ms, strftime(ts, '%m/%d/%Y %H:%M:%S') AS rt, user_id, event_type, value,
  '{{"k":' || json_extract_string(props, '$.k') || '}}' AS props, '/' || event_type AS path, 'user' || user_id AS eid,
  '{{"unit":{{"type":"Text","value":"ms"}},"TimeInstant":{{"type":"DateTime","value":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || '"}}}}' AS md
  FROM events)"""

# one row per attribute of the event notifications
AR = EV + """,
ar AS (
  SELECT *, 0 AS pos, 'value' AS name, 'Number' AS type, value AS num, '' AS txt, md AS mdj FROM ev
  UNION ALL BY NAME SELECT *, 1 AS pos, 'kind' AS name, 'Text' AS type, -1.0 AS num, event_type AS txt, '{}' AS mdj FROM ev
  UNION ALL BY NAME SELECT *, 2 AS pos, 'props' AS name, 'StructuredValue' AS type, -1.0 AS num, props AS txt, '{}' AS mdj FROM ev)"""

OD = """
od AS (SELECT o_orderkey AS event_id, o_orderdate AS ts, strftime(o_orderdate, '%m/%d/%Y %H:%M:%S') AS rt,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, o_totalprice AS total, o_orderpriority AS priority,
  o_orderstatus AS status, 'urn:ngsi-ld:Order:' || o_orderkey AS eid, 'urn:ngsi-ld:Customer:' || o_custkey AS customer,
  'urn:ngsi-ld:Clerk:' || o_orderstatus AS clerk,
  '{"type":"Point","coordinates":[' || (o_custkey % 360 - 180) || ',' || (o_orderkey % 180 - 90) || ']}' AS location
  FROM orders)"""

TE = """
te AS (SELECT p_partkey AS event_id, 'Big Service' AS service, CASE WHEN p_size % 5 = 0 THEN '/' ELSE '/' || p_brand END AS path,
  'urn:x00a1=' || p_name AS eid, p_type || '.' || p_brand AS etype, 'p.size$' AS attr FROM part)"""

RECORDS = f"""
rec AS (SELECT event_type AS dest, event_id AS _id, epoch_us(ts) // 1000 + (event_id * 37 % 11) * 86400000 AS recv_ms, props FROM events)"""


def row_columns(md_default: str = "[]", path: str = "event_type") -> str:
    return (
        f"event_id, ms AS \"{M.RECV_TIME_TS}\", rt AS \"{M.RECV_TIME}\", {path} AS {PATH}, eid AS \"{M.ENTITY_ID}\", "
        f"'User' AS \"{M.ENTITY_TYPE}\", name AS \"{M.ATTR_NAME}\", type AS \"{M.ATTR_TYPE}\", num AS value_num, txt AS value_text, "
        f"CASE WHEN mdj = '{{}}' THEN '{md_default}' ELSE mdj END AS \"{M.ATTR_MD}\""
    )


def column_columns(md: bool = True, path: str = "event_type") -> str:
    mds = ", md AS value_md, '[]' AS kind_md, '[]' AS props_md" if md else ""
    return (
        f"event_id, ms AS \"{M.RECV_TIME_TS}\", rt AS \"{M.RECV_TIME}\", {path} AS {PATH}, eid AS \"{M.ENTITY_ID}\", "
        f"'User' AS \"{M.ENTITY_TYPE}\", value, event_type AS kind, props{mds}"
    )


def entity_table(kind: str) -> str:
    return " || 'xffff' || ".join(enc(f"lower({c})", kind) for c in ("path", "eid", "'User'"))


LD_COLUMNS = (
    'total AS "totalPrice", iso AS "totalPrice_observedAt", \'EUR\' AS "totalPrice_unitCode", status AS "totalPrice_status", '
    'clerk AS "totalPrice_handledBy", priority, customer AS "placedBy", location'
)

# start of the bucket, its range start and its slot, per resolution
BUCKETS = {
    "second": ("minute", "second(ts)"), "minute": ("hour", "minute(ts)"), "hour": ("day", "hour(ts)"),
    "day": ("month", "day(ts)"), "month": ("year", "month(ts)"),
}


def numeric_bucket(resolution: str, keys: str, extra: str = "") -> str:
    rng, slot = BUCKETS[resolution]
    return (
        f"SELECT {keys}, '{resolution}' AS resolution, '{rng}' AS \"range\", strftime(date_trunc('{rng}', ts), '%Y-%m-%d %H:%M:%S') AS origin, "
        f"CAST({slot} AS BIGINT) AS \"offset\", count(*) AS samples, round(sum(value), 4) AS sum, round(sum(value * value), 4) AS sum2, "
        f"min(value) AS min, max(value) AS max{extra} FROM ev GROUP BY ALL"
    )


def numeric_buckets(resolutions: list[str], keys: str = "eid AS entity_id, 'value' AS attr_name", extra: str = "") -> str:
    return f"WITH {EV} " + " UNION ALL ".join(numeric_bucket(r, keys, extra) for r in resolutions)


def categorical_bucket(resolution: str) -> str:
    rng, slot = BUCKETS[resolution]
    return (
        f"SELECT eid AS entity_id, event_type AS attr_value, '{resolution}' AS resolution, '{rng}' AS \"range\", "
        f"strftime(date_trunc('{rng}', ts), '%Y-%m-%d %H:%M:%S') AS origin, CAST({slot} AS BIGINT) AS \"offset\", count(*) AS samples FROM ev GROUP BY ALL"
    )


# collection and key of a bucket document, per data model
DOCUMENT_KEYS = {
    "db-by-service-path": ("path", "eid || '|User|value'"), "db-by-entity": ("path || '|' || eid || '|User'", "'value'"),
    "db-by-attribute": ("path || '|' || eid || '|User|value'", "''"),
}


def documents(model: str, resolution: str) -> str:
    collection, key = DOCUMENT_KEYS[model]
    size = {"hour": 24, "month": 12}[resolution]
    keys = f"'{model}' AS model, {collection} AS collection, {key} AS doc_key, 'Number' AS \"attrType\", CAST({size} AS BIGINT) AS n_points"
    return numeric_bucket(resolution, keys)


def side_files() -> str:
    """Links of all rows, and the metadata lines behind them."""
    leaf = f"{enc('eid', 'hdfs')} || 'xffff' || name || 'xffff' || type"
    lines = "CASE WHEN name = 'value' THEN count(*) ELSE 0 END"
    return (
        f"SELECT 'hdfs:///user/hist/web' || path || '/' || {leaf} || '/' || {leaf} || '.txt' AS link, count(*) AS n_rows, 2 * {lines} AS n_lines, "
        f"CASE WHEN name = 'value' THEN min(ms) ELSE 0 END AS first_ms, CASE WHEN name = 'value' THEN max(ms) ELSE 0 END AS last_ms, "
        f"CASE WHEN name = 'value' THEN 'TimeInstant,unit' ELSE '' END AS names FROM ar GROUP BY path, eid, name, type"
    )


def dense(resolution: str, first: int, last: int) -> str:
    rng, slot = BUCKETS[resolution]
    return (
        f"SELECT k.entity_id, 'value' AS attr_name, '{resolution}' AS resolution, '{rng}' AS \"range\", k.origin, s.o AS \"offset\", "
        "coalesce(b.samples, 0) AS samples, coalesce(b.sum, 0.0) AS sum, coalesce(b.sum2, 0.0) AS sum2, "
        "coalesce(b.min, 'Infinity'::DOUBLE) AS min, coalesce(b.max, '-Infinity'::DOUBLE) AS max "
        f"FROM (SELECT DISTINCT eid AS entity_id, strftime(date_trunc('{rng}', ts), '%Y-%m-%d %H:%M:%S') AS origin FROM ev) k "
        f"CROSS JOIN (SELECT unnest(range({first}, {last + 1})) AS o) s LEFT JOIN ({numeric_bucket(resolution, 'eid AS entity_id')}) b "
        "ON b.entity_id = k.entity_id AND b.origin = k.origin AND b.\"offset\" = s.o"
    )


HAVERSINE = (
    f"{2 * EARTH_RADIUS_M!r} * asin(sqrt(least(1.0, pow(sin(radians(lat - lat0) / 2), 2) "
    "+ cos(radians(lat0)) * cos(radians(lat)) * pow(sin(radians(lon - lon0) / 2), 2))))"
)


def ellipsoid(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Metres between two points on the ellipsoid; NaN and its like are never reached."""
    def beta(lat: str) -> str:
        return f"atan2((1 - {FLATTENING!r}) * sin(radians({lat})), cos(radians({lat})))"

    return (
        f"(SELECT {SEMI_MAJOR_M!r} * (s - {FLATTENING!r} / 2 * ((s - sin(s)) * coalesce(pow(sin(p) * cos(q), 2) / nullif(1 - h, 0), 0) "
        f"+ (s + sin(s)) * coalesce(pow(cos(p) * sin(q), 2) / nullif(h, 0), 0))) FROM (SELECT *, 2 * asin(sqrt(h)) AS s FROM "
        f"(SELECT (b1 + b2) / 2 AS p, (b2 - b1) / 2 AS q, greatest(0.0, least(1.0, pow(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2) * pow(sin(radians({lon2} - {lon1}) / 2), 2))) AS h "
        f"FROM (SELECT {beta(lat1)} AS b1, {beta(lat2)} AS b2))))"
    )


def exact(value: str, window: str) -> str:
    """Running sum as a decimal, read as the nearest double."""
    return f"CAST(CAST(sum({value}) OVER {window} AS VARCHAR) AS DOUBLE)"


def trajectory(key: str, metres: str = HAVERSINE) -> str:
    """CTEs up to ``r``: every point with its stages and running values."""
    frame = f"(PARTITION BY {key} ORDER BY ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    running = ", ".join(
        f"{exact(f'CAST({m} AS DECIMAL(30,3))', frame)} AS sum{m}, greatest(max(CASE WHEN rn > 1 THEN {m} END) OVER {frame}, 1.4e-45) AS max{m}, "
        f"least(min(CASE WHEN rn > 1 THEN {m} END) OVER {frame}, 3.4028235e38) AS min{m}" for m in ("D", "T", "S")
    )
    return f"""{EV},
p AS (SELECT *, CAST((user_id * 37 + event_id * 13) % 360 - 180 AS DOUBLE) AS lon, CAST((user_id * 17 + event_id * 7) % 180 - 90 AS DOUBLE) AS lat FROM ev),
l AS (SELECT *, row_number() OVER w AS rn, lag(lon) OVER w AS lon0, lag(lat) OVER w AS lat0, lag(ms) OVER w AS ms0 FROM p
  WINDOW w AS (PARTITION BY {key} ORDER BY ms, event_id)),
s AS (SELECT *, CASE WHEN rn = 1 THEN 0.0::DOUBLE ELSE round({metres}, 3) END AS D, CAST(CASE WHEN rn = 1 THEN 0 ELSE ms - ms0 END AS DOUBLE) AS T FROM l),
v AS (SELECT *, CASE WHEN rn = 1 THEN 0.0::DOUBLE ELSE round(D / nullif(T, 0), 3) END AS S FROM s),
r AS (SELECT *, {running} FROM v)"""


def moments() -> str:
    frame = "(PARTITION BY eid ORDER BY ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    columns = []
    for m in ("D", "T", "S"):
        value = f"CAST(CASE WHEN rn > 1 THEN coalesce({m}, 0) ELSE 0 END AS DECIMAL(19,3))"
        columns.append(f"sum(CASE WHEN rn > 1 AND {m} IS NOT NULL THEN 1 ELSE 0 END) OVER {frame} AS n{m}")
        columns.append(f"{exact(value, frame)} AS m1{m}")
        columns.append(f"{exact(f'CAST({value} * {value} AS DECIMAL(38,6))', frame)} AS m2{m}")

    def mean(m: str, name: str) -> str:
        return f'coalesce(m1{m} / nullif(n{m}, 0), -1.0) AS "{name}"'

    def variance(m: str, name: str) -> str:
        average = f"(m1{m} / nullif(n{m}, 0))"
        return f'CASE WHEN n{m} = 0 THEN -1.0 ELSE greatest(m2{m} / nullif(n{m}, 0) - {average} * {average}, 0.0) END AS "{name}"'

    return (
        f"WITH {trajectory('eid')}, x AS (SELECT *, {', '.join(columns)} FROM v) SELECT event_id, eid AS entity_id, {mean('D', 'avgDistance')}, "
        f"{variance('D', 'varDistance')}, {mean('T', 'avgTime')}, {variance('T', 'varTime')}, {mean('S', 'avgSpeed')} FROM x"
    )


RESUMED = (
    "SELECT event_id, eid AS entity_id, rn AS cartodb_id, D AS \"stageDistance\", T AS \"stageTime\", \"sumD\" AS \"sumDistance\", "
    "\"sumT\" AS \"sumTime\", \"sumS\" AS \"sumSpeed\", \"maxT\" AS \"maxTime\", \"minT\" AS \"minTime\", rn AS \"numSamples\" FROM r"
)

REJECTS = f"""WITH {EV} SELECT event_id, CASE event_id % 8
  WHEN 1 THEN 'malformed-notification' WHEN 2 THEN 'malformed-notification' WHEN 3 THEN 'entity-id-missing'
  WHEN 4 THEN 'attribute-metadata-missing' WHEN 5 THEN 'attribute-type-missing' WHEN 6 THEN 'attribute-not-an-object'
  WHEN 7 THEN 'accepted null' ELSE 'accepted ' || event_type END AS outcome FROM ev"""


def destination_names() -> str:
    parts = []
    limits = {"postgresql": 63, "mysql": 64, "cassandra": 48, "dynamo": 255}
    warning = "root path cannot be used with the service-path model"
    for store, limit in limits.items():
        for encoding in (False, True):
            for by_path in (False, True):
                cols = ["path"] if by_path else ["path", "eid", "etype"]
                if encoding:
                    service = enc("service", store)
                    table = " || 'xffff' || ".join(enc(c, store) for c in cols)
                else:
                    service = old("lower(service)")
                    prefix = old("lower(substr(path, 2))")
                    entity = f"{old('lower(eid)')} || '_' || {old('lower(etype)')}"
                    table = prefix if by_path else f"CASE WHEN path = '/' THEN '' ELSE {prefix} || '_' END || {entity}"
                rule = f"{store}-{'new' if encoding else 'old'}-{'path' if by_path else 'entity'}"
                db = "" if store == "dynamo" else "db || '.' || "
                db_check = "" if store == "dynamo" else f"WHEN length(db) > {limit} THEN 'database-name-too-long' "
                low = "WHEN length(t) < 3 THEN 'table-name-too-short' " if store == "dynamo" else ""
                warn = f"CASE WHEN path = '/' THEN '{warning}' ELSE '' END" if by_path and not encoding else "''"
                parts.append(
                    f"SELECT event_id, '{rule}' AS rule, {db}t AS name, CASE {db_check}WHEN length(t) > {limit} THEN 'table-name-too-long' {low}ELSE '' END AS reject, "
                    f"{warn} AS warning FROM (SELECT *, {service} AS db, {table} AS t FROM te)"
                )
    return f"WITH {TE} " + " UNION ALL ".join(parts)


def document_store_names() -> str:
    parts = []
    for encoding in (False, True):
        tag = "new" if encoding else "old"
        for model, cols in (
            ("db-by-service-path", ["path"]), ("db-by-entity", ["path", "eid", "etype"]), ("db-by-attribute", ["path", "eid", "etype", "attr"]),
        ):
            if encoding:
                name = f"'sth_' || {enc('service', 'mongo_database')} || '.sth_' || " + " || 'xffff' || ".join(enc(c, "mongo_collection") for c in cols)
            else:
                name = f"'sth_' || {old('service', 'sth_database')} || '.sth_' || " + " || '_' || ".join(old(c, "sth_collection") for c in cols)
            parts.append(f"SELECT event_id, '{model}-{tag}' AS rule, {name} AS name FROM te")
        if encoding:
            service, path, leaf = enc("service", "hdfs"), enc("path", "hdfs_path"), enc("eid", "hdfs")
        else:
            service, path, leaf = old("service"), old("path", "plain_slash"), old("eid")
        slash = "CASE WHEN path = '/' THEN '' ELSE '/' END"
        folder = f"{service} || {path} || {slash} || {leaf}"
        md_leaf = f"{enc('eid', 'hdfs')} || 'xffff' || {enc('attr', 'hdfs')} || 'xffffInteger'"
        md_parent = f"{enc('service', 'hdfs')} || {enc('path', 'hdfs_path')} || {slash}"
        for rule, name in (
            ("folder", folder), ("file", f"{folder} || '/' || {leaf} || '.txt'"), ("md", f"{md_parent} || {md_leaf} || '/' || {md_leaf} || '.txt'"),
            ("hive", enc(f"('hist_' || {folder})", "hive") + " || '_row'"),
        ):
            parts.append(f"SELECT event_id, '{rule}-{tag}' AS rule, {name} AS name FROM te")
    return f"WITH {TE} " + " UNION ALL ".join(parts)


def catalog_names() -> str:
    def check(res: str) -> str:
        return (
            "CASE WHEN length(o) > 100 THEN 'organization-name-too-long' WHEN length(p) > 100 THEN 'package-name-too-long' "
            f"WHEN {res} AND length(r) > 100 THEN 'resource-name-too-long' ELSE '' END"
        )

    def part(label: str, org: str, pkg: str, res: str, reject: str) -> str:
        return (
            f"SELECT event_id, '{label}' AS rule, o AS org_name, p AS pkg_name, r AS res_name, {reject} AS reject "
            f"FROM (SELECT *, {org} AS o, {pkg} AS p, {res} AS r FROM te)"
        )

    e = lambda c: enc(c, "ckan")
    low = f"{e('lower(eid)')} || '_' || {e('lower(etype)')}"
    given = "event_id % 5 <> 0"
    return f"WITH {TE} " + " UNION ALL ".join([
        part("plain-new", e("lower(service)"), e("lower(eid)"), low, check("true")),
        part("plain-old", f"lower({old('lower(service)')})", f"lower({old('lower(eid)')})",
             f"lower({old('lower(eid)')}) || '_' || {old('lower(etype)')}", check("true")),
        part("plain-id", e("lower(service)"), e("lower(eid)"), "lower(eid)", "''"),
        part("given-keep", e("CASE WHEN event_id % 2 = 0 THEN 'Org X' ELSE service END"), e("CASE WHEN event_id % 3 = 0 THEN 'Pkg/Y' ELSE eid END"),
             f"CASE WHEN event_id % 5 = 0 THEN 'Res Z' ELSE {e('eid')} || '_' || {e('etype')} END", check(given)),
        part("given-lower", e("lower(service)"), e("lower(eid)"), f"CASE WHEN event_id % 5 = 0 THEN lower(eid) ELSE {low} END", check(given)),
    ])


def encode_all() -> str:
    texts = (
        "SELECT 'url' AS kind, page_id AS id, url AS s FROM pages UNION ALL SELECT 'part', p_partkey, p_name FROM part "
        "UNION ALL SELECT 'customer', c_custkey, c_name || '=x00ffé' FROM customer UNION ALL SELECT 'text', doc_id, text FROM documents"
    )
    columns = {f"enc_{kind}": enc("s", kind) for kind in DENIED}
    columns.update({
        "old": old("s"), "old_path": old("s", "plain_slash"), "old_table": old("substr(s, 2)"), "ld_table": old("s", "ld_table"),
        "sth_database": old("s", "sth_database"), "sth_collection": old("s", "sth_collection"),
    })
    out = ", ".join(f"CASE WHEN length(s) > 200 THEN md5({v}) ELSE {v} END AS {k}" for k, v in columns.items())
    return f"SELECT kind, id, {out} FROM ({texts})"


FORMAT_VALUES = ", ".join(
    "('{}', '{}', {})".format(n.replace("'", "''"), d.replace("'", "''"), f"'{m}'" if m else "NULL") for n, d, m in vocab.format_rows()
)
VOCABULARY = (
    "voc AS (SELECT 'availability' AS field, unnest([" + ", ".join(f"'{a}'" for a in vocab.AVAILABILITY) + "]) AS value "
    f"UNION SELECT 'format', n FROM (VALUES {FORMAT_VALUES}) f(n, d, m) WHERE m IS NOT NULL "
    f"UNION SELECT 'mimetype', m FROM (VALUES {FORMAT_VALUES}) f(n, d, m) WHERE m IS NOT NULL)"
)
USED = """used AS (SELECT p_partkey, CASE WHEN p_partkey % 6 < 3 THEN 'format' WHEN p_partkey % 6 < 5 THEN 'mimetype' ELSE 'availability' END AS field,
  CASE p_partkey % 6 WHEN 0 THEN 'CSV' WHEN 1 THEN 'SHP' WHEN 2 THEN p_type WHEN 3 THEN 'text/csv' WHEN 4 THEN 'text/' || p_brand
  ELSE 'http://data.europa.eu/r5r/availability/' || CASE WHEN p_size % 2 = 0 THEN 'stable' ELSE 'never' END END AS value FROM part)"""

FRAGMENTS = f"""
fr AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, l_orderkey % 40 AS bad,
  CASE l_orderkey % 40 WHEN 1 THEN NULL WHEN 2 THEN 'two' WHEN 3 THEN '0' WHEN 4 THEN CAST(l_linenumber AS VARCHAR) ELSE CAST(l_orderkey % 7 + 1 AS VARCHAR) END AS cnt,
  CASE l_orderkey % 40 WHEN 5 THEN NULL WHEN 6 THEN 'x1' WHEN 7 THEN CAST(-l_linenumber AS VARCHAR) WHEN 8 THEN '3' ELSE CAST(l_linenumber - 1 AS VARCHAR) END AS idx,
  {NOW_MS} - (l_orderkey % 100) * 1000 AS q FROM lineitem),
g AS (SELECT id, count(*) AS n, count(cnt) AS nc, count(TRY_CAST(cnt AS INT)) AS nci, min(TRY_CAST(cnt AS INT)) AS lo, max(TRY_CAST(cnt AS INT)) AS hi,
  count(idx) AS ni, count(TRY_CAST(idx AS INT)) AS nii, min(TRY_CAST(idx AS INT)) AS li, count(DISTINCT TRY_CAST(idx AS INT)) AS di, max(q) AS q FROM fr GROUP BY id),
st AS (SELECT id, n, CASE WHEN n = 1 AND nc = 0 THEN '' WHEN nc < n THEN 'count-missing' WHEN nci < nc THEN 'count-not-an-integer' WHEN lo < 1 THEN 'count-not-positive'
  WHEN lo <> hi THEN 'count-inconsistent' WHEN ni < n THEN 'index-missing' WHEN nii < ni THEN 'index-not-an-integer' WHEN li < 0 THEN 'index-negative'
  WHEN di < nii THEN 'index-duplicate' WHEN n <> hi AND {NOW_MS} - q > 50000 THEN 'timeout' ELSE '' END AS reason, nc, hi FROM g),
fs AS (SELECT id, n, CASE WHEN reason <> '' THEN 'INVALID' WHEN (n = 1 AND nc = 0) OR n = hi THEN 'READY' ELSE 'WAIT' END AS status, reason FROM st)"""
READY = f"WITH {FRAGMENTS} SELECT fr.id AS fragment_identifier, coalesce(idx, '') AS fragment_index FROM fr JOIN fs ON fs.id = fr.id WHERE status = 'READY'"

EXTRAS = (
    "'publisher_type=-;contact_uri=-;contact_name=' || CASE WHEN g > 3 THEN 'Ann' ELSE '-' END || ';contact_email=-;spatial_uri=-;spatial=-;"
    "temporal_start=-;temporal_end=-;theme=[\"economy\",\"trade\"];access_rights=-'"
)

PG_ROW = f"WITH {AR} SELECT 'web' AS dest_db, {entity_table('postgresql')} AS dest_table, {row_columns()} FROM ar"


def oracle_sql() -> dict[str, str]:
    by_path = "'x002f' || event_type"
    return {
        "v2_row_history": PG_ROW,
        "stream_row_history": PG_ROW,
        "v2_column_history": f"WITH {EV} SELECT 'web' AS dest_db, {entity_table('postgresql')} AS dest_table, {column_columns()} FROM ev",
        "v2_discovered_columns": f"WITH {EV} SELECT 'web' AS dest_db, {entity_table('mysql')} AS dest_table, {column_columns()} FROM ev",
        "v2_column_map": f"WITH {EV} SELECT event_id, eid AS \"{M.ENTITY_ID}\", 'kind,props,value' AS names, event_type AS kind, '[]' AS kind_md, value FROM ev",
        "v2_ckan_compat_rows": f"WITH {AR} SELECT 'web' AS dest_db, event_type || '_' || eid || '_user' AS dest_table, CAST(pos AS BIGINT) AS _id, {row_columns()} FROM ar",
        "v2_metadata_rows": f"""WITH {EV} SELECT event_id, eid AS entity_id, 'value' AS attr_name, CAST(0 AS BIGINT) AS md_pos, 'unit' AS md_name, 'Text' AS md_type, 'ms' AS md_value FROM ev
            UNION ALL SELECT event_id, eid, 'value', 1, 'TimeInstant', 'DateTime', strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') FROM ev""",
        "v2_time_instant": f"""WITH {AR}, t AS (SELECT *, CASE WHEN name = 'value' THEN ms ELSE ms + 90000 END AS moment FROM ar)
            SELECT event_id, name AS attr_name, moment AS recv_time_ts, strftime(make_timestamp(moment * 1000), '%m/%d/%Y %H:%M:%S') AS recv_time FROM t""",
        "v2_multi_path": """SELECT event_id, 'test' AS service, CASE WHEN event_id % 3 = 0 THEN '/only' WHEN p = 0 THEN '/first' ELSE '/second' END AS service_path,
            CAST(p AS BIGINT) AS entity_pos, 'user' || user_id || CASE p WHEN 0 THEN 'a' ELSE 'b' END AS entity_id, event_type AS attr_value
            FROM events CROSS JOIN (SELECT unnest([0, 1]) AS p)""",
        "v2_rejects": REJECTS,
        "stream_dead_letter": "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'malformed-notification' ELSE 'accepted' END AS reject_reason FROM events",
        "stream_versions": "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'malformed-notification' ELSE 'accepted 3' END AS reject_reason FROM events",
        "ld_column_history": f"WITH {OD} SELECT event_id, 'sales' AS dest_db, 'order' AS dest_table, rt AS \"{M.RECV_TIME}\", eid AS \"{M.ENTITY_ID}\", 'Order' AS \"{M.ENTITY_TYPE}\", {LD_COLUMNS} FROM od",
        "ld_attribute_rows": f"""WITH {OD} SELECT event_id, eid AS entity_id, 'totalPrice' AS name, 'Property' AS type, total AS value_num, '' AS value_text FROM od
            UNION ALL SELECT event_id, eid, 'priority', 'Property', -1.0, priority FROM od
            UNION ALL SELECT event_id, eid, 'placedBy', 'Relationship', -1.0, customer FROM od
            UNION ALL SELECT event_id, eid, 'location', 'GeoProperty', -1.0, location FROM od
            UNION ALL SELECT event_id, eid, 'totalPrice_observedAt', '', -1.0, iso FROM od
            UNION ALL SELECT event_id, eid, 'totalPrice_unitCode', '', -1.0, 'EUR' FROM od
            UNION ALL SELECT event_id, eid, 'totalPrice_status', 'Property', -1.0, status FROM od
            UNION ALL SELECT event_id, eid, 'totalPrice_handledBy', 'Relationship', -1.0, clerk FROM od""",
        "ld_edges": f"""WITH {OD} SELECT event_id, eid AS source, 'placedBy' AS predicate, customer AS target FROM od
            UNION ALL SELECT event_id, eid, 'totalPrice_handledBy', clerk FROM od""",
        "ld_nodes": f"WITH {OD} SELECT DISTINCT eid AS id, 'Order' AS type FROM od",
        "mysql_rows": f"WITH {AR} SELECT 'web' AS dest_db, event_type || '_' || eid || '_user' AS dest_table, {row_columns()} FROM ar",
        "cassandra_rows": f"WITH {AR} SELECT 'web' AS dest_db, {by_path} AS dest_table, {row_columns()} FROM ar",
        "dynamo_items": f"""WITH {AR}, k AS (SELECT * REPLACE (event_id * 10 + pos AS event_id) FROM ar)
            SELECT {entity_table('dynamo')} AS dest_table, * EXCLUDE (path, eid) REPLACE (CAST("{M.RECV_TIME_TS}" AS DOUBLE) AS "{M.RECV_TIME_TS}"),
            {NOW_MS} - 1 + row_number() OVER (ORDER BY event_id) AS "ID" FROM (SELECT {row_columns(path='path')}, path, eid FROM k)""",
        "dynamo_column_items": f"""WITH {EV} SELECT {entity_table('dynamo')} AS dest_table, * EXCLUDE (path, eid) REPLACE (CAST("{M.RECV_TIME_TS}" AS DOUBLE) AS "{M.RECV_TIME_TS}")
            FROM (SELECT {column_columns(path='path')}, path, eid FROM ev)""",
        "mongo_docs_by_path": f"""WITH {AR} SELECT event_id, 'sth_web' AS dest_db, 'sth_x002f' || event_type AS dest_table, ms AS "{M.RECV_TIME}", eid AS "{M.ENTITY_ID}",
            'User' AS "{M.ENTITY_TYPE}", name AS "{M.ATTR_NAME}", type AS "{M.ATTR_TYPE}", num AS value_num, txt AS value_text, mdj AS "attrMetadata" FROM ar""",
        "mongo_docs_by_attribute": f"""WITH {AR} SELECT event_id, 'sth_web' AS dest_db, 'sth_' || path || '_' || eid || '_user_' || name AS dest_table, ms AS "{M.RECV_TIME}",
            type AS "{M.ATTR_TYPE}", num AS value_num, txt AS value_text, mdj AS "attrMetadata" FROM ar""",
        "mongo_column_docs": f"""WITH {EV} SELECT event_id, 'sth_web' AS dest_db, 'sth_x002f' || event_type AS dest_table, ms AS "{M.RECV_TIME}", ms AS "{M.RECV_TIME_TS}",
            eid AS "{M.ENTITY_ID}", 'User' AS "{M.ENTITY_TYPE}", value, event_type AS kind, props FROM ev""",
        "ckan_records": f"""WITH {OD} SELECT event_id, 'sales' AS org_name, {enc('lower(eid)', 'ckan')} AS pkg_name, {enc('lower(eid)', 'ckan')} || '_order' AS res_name,
            strftime(ts, '%Y-%m-%dT%H:%M:%S.0Z') AS "{M.RECV_TIME}", eid AS "{M.ENTITY_ID}", 'Order' AS "{M.ENTITY_TYPE}", {LD_COLUMNS} FROM od""",
        "ckan_row_records": f"""WITH {AR} SELECT * REPLACE ("{M.RECV_TIME_TS}" AS "{M.RECV_TIME}", CASE WHEN "{M.ATTR_NAME}" = 'kind' THEN '"' || value_text || '"' ELSE value_text END AS value_text)
            FROM (SELECT {row_columns(path='path')} FROM ar)""",
        "ckan_fields": """WITH f AS (SELECT event_type, arg_min(user_id, event_id) % 7 AS u FROM events GROUP BY event_type)
            SELECT event_type, CAST(p AS BIGINT) AS field_pos, CASE p WHEN 0 THEN 'recvTime' WHEN 1 THEN event_type ELSE 'u' || u END AS field, 'text' AS type
            FROM f CROSS JOIN (SELECT unnest([0, 1, 2]) AS p)""",
        "ckan_upsert": """SELECT event_id, CASE WHEN event_type = 'error' THEN '-' ELSE event_type END AS event_type, CASE WHEN event_type = 'error' THEN user_id ELSE -1 END AS user_id FROM events""",
        "hdfs_json_rows": f"""WITH {AR} SELECT 'web' AS dest_db, ms // 1000 AS "{M.RECV_TIME_TS}", rt AS "{M.RECV_TIME}", path AS {PATH}, eid AS "{M.ENTITY_ID}", 'User' AS "{M.ENTITY_TYPE}",
            name AS "{M.ATTR_NAME}", type AS "{M.ATTR_TYPE}", num AS value_num, txt AS value_text,
            CASE WHEN name = 'value' THEN 'ms|' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') ELSE '' END AS "{M.ATTR_MD}" FROM ar""",
        "hdfs_json_columns": f"""WITH {EV} SELECT 'web' AS dest_db, rt AS "{M.RECV_TIME}", path AS {PATH}, eid AS "{M.ENTITY_ID}", 'User' AS "{M.ENTITY_TYPE}", value,
            'unit|TimeInstant' AS value_md, event_type AS kind, CAST(0 AS BIGINT) AS kind_md, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM ev""",
        "hdfs_csv_rows": f"""WITH {AR} SELECT event_id, 'web' AS dest_db, ms // 1000 AS "{M.RECV_TIME_TS}", rt AS "{M.RECV_TIME}", path AS {PATH}, eid AS "{M.ENTITY_ID}", 'User' AS "{M.ENTITY_TYPE}",
            name AS "{M.ATTR_NAME}", type AS "{M.ATTR_TYPE}", num AS value_num, replace(txt, '"', '') AS value_text,
            'hdfs:///user/hist/web' || path || '/' || {enc('eid', 'hdfs')} || 'xffff' || name || 'xffff' || type || '/' || {enc('eid', 'hdfs')} || 'xffff' || name || 'xffff' || type || '.txt'
            AS "{M.ATTR_MD_FILE}" FROM ar""",
        "hdfs_csv_columns": f"""WITH {EV} SELECT event_id, 'web' AS dest_db, 'web' || path || '/' || eid AS dest_folder, 'web' || path || '/' || eid || '/' || eid || '.txt' AS dest_file,
            rt AS "{M.RECV_TIME}", path AS {PATH}, eid AS "{M.ENTITY_ID}", 'User' AS "{M.ENTITY_TYPE}", value, event_type AS kind, replace(props, '"', '') AS props,
            'hdfs:///user/hist/md/value/Number' AS value_md_file, 'hdfs:///user/hist/md/kind/Text' AS kind_md_file, 'hdfs:///user/hist/md/props/StructuredValue' AS props_md_file FROM ev""",
        "hdfs_md_files": f"""WITH {EV}, m AS (SELECT *, 'unit' AS name, 'Text' AS type, 'ms' AS v FROM ev UNION ALL SELECT *, 'TimeInstant', 'DateTime', strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') FROM ev),
            n AS (SELECT *, eid || 'xffffvaluexffffNumber' AS leaf FROM m)
            SELECT event_id, 'web' || path || '/' || leaf || '/' || leaf || '.txt' AS md_file, ms AS "{M.RECV_TIME_TS}", name, type, v AS value FROM n""",
        "hdfs_csv_row_side_files": f"WITH {AR} {side_files()}",
        "hdfs_csv_column_side_files": f"WITH {AR} {side_files()}",
        "external_table_scan": f"""WITH {AR} SELECT eid || ',' || name || ',' || count(*) || ',' || max(ms // 1000) AS row FROM ar WHERE name <> 'props' GROUP BY eid, name""",
        "encode_all": encode_all(),
        "destination_names": destination_names(),
        "document_store_names": document_store_names(),
        "catalog_names": catalog_names(),
        "destination_counts": f"WITH {AR} SELECT 'web' AS dest_db, {entity_table('postgresql')} AS dest_table, count(*) AS n_rows FROM ar GROUP BY ALL",
        "destination_columns": f"WITH {AR} SELECT DISTINCT 'web' AS dest_db, {by_path} AS dest_table, name AS attr_name FROM ar",
        "destinations": f"WITH {OD} SELECT DISTINCT 'sales' AS dest_db, {enc('lower(eid)', 'postgresql')} AS dest_table FROM od",
        "bucket_numeric": numeric_buckets(list(BUCKETS), extra=", 'Number' AS attr_type"),
        "bucket_hot_path": numeric_buckets(["hour", "day", "month"], "path AS service_path, 'value' AS attr_name"),
        "bucket_merge": numeric_buckets(["minute", "day"]),
        "stream_buckets": numeric_buckets(["minute", "day"]),
        "stream_live_buckets": numeric_buckets(["day"], "event_type"),
        "stream_live_months": numeric_buckets(["hour", "day", "month"]),
        "bucket_documents": f"WITH {EV} " + " UNION ALL ".join(documents(m, r) for m in DOCUMENT_KEYS for r in ("hour", "month")),
        "stored_documents": f"WITH {EV} SELECT * FROM ({documents('db-by-entity', 'hour')}) WHERE origin >= '2024-01-10 00:00:00'",
        "merged_occurrences": f"""WITH {EV}, c AS (SELECT path, eid, event_type, day(ts) AS slot, strftime(date_trunc('month', ts), '%Y-%m-%d %H:%M:%S') AS origin, count(*) AS n FROM ev GROUP BY ALL)
            SELECT 'db-by-attribute' AS model, path || '|' || eid || '|User|kind' AS collection, '' AS doc_key, 'day' AS resolution, 'month' AS "range", origin, 'Text' AS "attrType", CAST(31 AS BIGINT) AS n_points,
            CAST(slot AS BIGINT) AS "offset", CAST(sum(n) AS BIGINT) AS samples, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS occur FROM c GROUP BY path, eid, slot, origin""",
        "bucket_dense": f"WITH {EV} {dense('hour', 0, 23)} UNION ALL {dense('month', 1, 12)}",
        "bucket_categorical": f"WITH {EV} " + " UNION ALL ".join(categorical_bucket(r) for r in ("hour", "day", "month")),
        "stream_occurrences": f"WITH {EV} " + " UNION ALL ".join(categorical_bucket(r) for r in ("hour", "day", "month")),
        "v2_hostile_input": """SELECT event_id, CASE WHEN event_id % 8 = 5 THEN 'first' ELSE 'web' END AS service,
            CASE event_id % 8 WHEN 0 THEN 'attribute-repeated' WHEN 6 THEN 'malformed-notification' ELSE 'accepted' END AS outcome,
            CAST(CASE WHEN event_id % 8 IN (0, 1, 6) THEN 0 ELSE 1 END AS BIGINT) AS n_attrs,
            CASE WHEN event_id % 8 IN (5, 7) THEN CAST(event_id AS DOUBLE) END AS number FROM events""",
        "bucket_occurrences": f"""WITH {EV}, f AS ({categorical_bucket('day')}),
            k AS (SELECT DISTINCT entity_id, origin FROM f), s AS (SELECT unnest(range(1, 32)) AS o)
            SELECT k.entity_id, k.origin, s.o AS "offset", CAST(coalesce(sum(f.samples), 0) AS BIGINT) AS samples,
            coalesce(string_agg(f.attr_value || ':' || f.samples, ',' ORDER BY f.attr_value), '') AS occur
            FROM k CROSS JOIN s LEFT JOIN f ON f.entity_id = k.entity_id AND f.origin = k.origin AND f."offset" = s.o GROUP BY ALL""",
        "trajectory_stats": f"""WITH {trajectory('eid')} SELECT rn AS cartodb_id, ms AS "{M.RECV_TIME_TS}", path AS {PATH}, eid AS "{M.ENTITY_ID}", 'User' AS "{M.ENTITY_TYPE}",
            'SRID=4326;POINT(' || CAST(lon AS BIGINT) || '.0 ' || CAST(lat AS BIGINT) || '.0)' AS the_geom, D AS "stageDistance", T AS "stageTime", coalesce(S, -1.0) AS "stageSpeed",
            "sumD" AS "sumDistance", "sumT" AS "sumTime", "sumS" AS "sumSpeed", "sumD" * "sumD" AS "sum2Distance", "sumT" * "sumT" AS "sum2Time", "sumS" * "sumS" AS "sum2Speed",
            "maxD" AS "maxDistance", "minD" AS "minDistance", "maxT" AS "maxTime", "minT" AS "minTime", "maxS" AS "maxSpeed", "minS" AS "minSpeed", rn AS "numSamples" FROM r""",
        "trajectory_by_path": f"""WITH {trajectory('path')} SELECT event_id, path AS service_path, rn AS cartodb_id, D AS "stageDistance", T AS "stageTime", coalesce(S, -1.0) AS "stageSpeed",
            "sumD" AS "sumDistance", "sumT" AS "sumTime", "sumS" AS "sumSpeed", "maxD" AS "maxDistance", "minD" AS "minDistance", "maxS" AS "maxSpeed", "minS" AS "minSpeed", rn AS "numSamples" FROM r""",
        "trajectory_resume": f"WITH {trajectory('eid')} {RESUMED}",
        "stream_trajectory": f"WITH {trajectory('eid')} {RESUMED}",
        "trajectory_moments": moments(),
        "trajectory_raw": f"""WITH {EV} SELECT 'web' AS dest_db, {by_path} AS dest_table, {column_columns()}, CAST((user_id * 37 + event_id * 13) % 360 - 180 AS DOUBLE) AS lon,
            CAST((user_id * 17 + event_id * 7) % 180 - 90 AS DOUBLE) AS lat, CAST(3857 AS BIGINT) AS srid,
            row_number() OVER (PARTITION BY path ORDER BY ms, event_id) AS cartodb_id FROM ev""",
        "continued_ids": f"""WITH {EV} SELECT event_id, eid AS "{M.ENTITY_ID}", row_number() OVER (PARTITION BY path, eid ORDER BY event_id % 3, event_id) AS "ID" FROM ev""",
        "ellipsoid_distance": f"""WITH p AS (SELECT event_id, CAST((user_id * 37 + event_id * 13) % 360 - 180 AS DOUBLE) AS lon, CAST((user_id * 17 + event_id * 7) % 180 - 90 AS DOUBLE) AS lat FROM events)
            SELECT event_id, round({ellipsoid('lon', 'lat', '-3.7', '40.4')} / 1000, 3) AS km, round({ellipsoid('lon', 'lat', '0.0', '-90.0')} / 1000, 3) AS pole_km FROM p""",
        "trajectory_ellipsoid": f"""WITH {trajectory('eid', ellipsoid('lon0', 'lat0', 'lon', 'lat'))} SELECT event_id, eid AS entity_id, D AS "stageDistance", "sumD" AS "sumDistance" FROM r""",
        "web_mercator": f"""WITH p AS (SELECT event_id, CAST((user_id * 37 + event_id * 13) % 360 - 180 AS DOUBLE) AS lon, CAST((user_id * 17 + event_id * 7) % 180 - 90 AS DOUBLE) * 0.9 AS lat FROM events)
            SELECT event_id, round({MERCATOR_RADIUS_M!r} * radians(lon), 2) AS x, round({MERCATOR_RADIUS_M!r} * ln(tan(pi() / 4 + radians(lat) / 2)), 2) AS y, CAST(3857 AS BIGINT) AS srid FROM p""",
        "latest_per_destination": f"""WITH {AR} SELECT 'web' AS dest_db, {by_path} AS dest_table, name AS attr_name, arg_max(eid, event_id) AS entity_id, max(event_id) AS event_id,
            arg_max(ms, event_id) AS recv_time_ts FROM ar GROUP BY ALL""",
        "stored_retention": f"WITH {RECORDS} SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY dest ORDER BY _id DESC) <= 500",
        "stored_age": f"WITH {RECORDS} SELECT * FROM rec WHERE recv_ms >= {NOW_MS} - 864000000",
        "stored_prefix": f"""WITH {RECORDS}, f AS (SELECT dest, min(_id) AS first_live FROM rec WHERE recv_ms >= {NOW_MS} + 864000000 - 604800000 GROUP BY dest)
            SELECT rec.* FROM rec JOIN f USING (dest) WHERE _id >= first_live""",
        "stored_bytes": f"""WITH {RECORDS} SELECT * FROM rec QUALIFY sum(strlen(props)) OVER (PARTITION BY dest ORDER BY _id DESC) <= 6000
            AND row_number() OVER (PARTITION BY dest ORDER BY _id DESC) <= 900""",
        "stored_delete": f"WITH {RECORDS} SELECT * FROM rec WHERE _id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)",
        "file_statistics": f"WITH {RECORDS} SELECT strftime(make_timestamp(recv_ms * 1000), '%Y-%m-%d') AS day, count(*) AS n_rows, min(recv_ms) AS low, max(recv_ms) AS high FROM rec GROUP BY 1",
        "atomic_append": f"""WITH {EV} SELECT event_id, a AS "{M.ATTR_NAME}", '' AS reject_reason FROM ev, unnest(['value', 'kind', 'props']) t(a) WHERE event_id % 5 <> 0
            UNION ALL SELECT event_id, '', 'malformed-notification' FROM ev WHERE event_id % 5 = 0""",
        "page_read": f"WITH {RECORDS} SELECT * FROM rec WHERE dest = 'click' ORDER BY _id LIMIT 25 OFFSET 40",
        "existing_row_counts": f"WITH {RECORDS} SELECT dest, count(*) AS n_rows FROM rec GROUP BY dest",
        "retain_newest": f"WITH {RECORDS} SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY dest ORDER BY _id DESC) <= 500",
        "retain_age": f"WITH {RECORDS} SELECT * FROM rec WHERE recv_ms >= {NOW_MS} - 864000000",
        "retain_prefix": f"""WITH {RECORDS}, f AS (SELECT dest, min(_id) AS first_live FROM rec WHERE recv_ms >= {NOW_MS} + 864000000 - 604800000 GROUP BY dest)
            SELECT rec.*, strftime(make_timestamp(recv_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS "recvTime" FROM rec JOIN f USING (dest) WHERE _id >= first_live""",
        "retain_bytes": f"""WITH {RECORDS} SELECT * FROM rec QUALIFY sum(strlen(props)) OVER (PARTITION BY dest ORDER BY _id DESC) <= 6000
            AND row_number() OVER (PARTITION BY dest ORDER BY _id DESC) <= 900""",
        "delete_by_id": f"WITH {RECORDS} SELECT * FROM rec WHERE _id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)",
        "catalog_packages": f"""WITH p AS (SELECT DISTINCT o_orderkey % 7 AS g FROM orders) SELECT 'pkg_' || g AS name, CASE WHEN g < 5 THEN 'sales_org' ELSE 'other_org' END AS owner_org, 'Orders of group ' || g AS notes, 'pkg_' || g AS title,
            '1.0' AS version, 'https://example.org/orders' AS url, 'public' AS visibility, {EXTRAS} AS extras, 'orders;group' || g AS tags FROM p""",
        "catalog_resources": """WITH p AS (SELECT DISTINCT o_orderkey % 7 AS g, o_orderkey % 14 AS h FROM orders) SELECT 'pkg_' || g AS package_id, CASE WHEN g < 5 THEN 'sales_org' ELSE 'other_org' END AS owner_org, 'res ' || h AS name,
            'JSON' AS format, 'https://example.org/' || g || '/' || h AS download_url, 'https://example.org/' || g || '/' || h AS url FROM p""",
        "catalog_organizations": "SELECT DISTINCT CASE WHEN o_orderkey % 7 < 5 THEN 'sales_org' ELSE 'other_org' END AS name, CASE WHEN o_orderkey % 7 < 5 THEN 'sales_org' ELSE 'other_org' END AS title FROM orders",
        "catalog_missing": """WITH p AS (SELECT DISTINCT o_orderkey % 7 AS g, o_orderkey % 14 AS h FROM orders)
            SELECT CASE WHEN g < 5 THEN 'sales_org' ELSE 'other_org' END AS org_name, 'pkg_' || g AS pkg_name, 'res ' || h AS res_name, CASE WHEN g >= 5 THEN 'organization' WHEN g >= 4 THEN 'package' WHEN h >= 9 THEN 'resource' ELSE '' END AS create_from,
            CASE WHEN g >= 4 OR h >= 9 THEN '' ELSE 'id-' || h END AS res_id FROM p""",
        "catalog_join": """SELECT o_orderkey, c_mktsegment AS segment, CASE WHEN c_nationkey < 20 THEN n_name ELSE 'none' END AS publisher FROM orders
            JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""",
        "vocab_invalid": f"WITH {VOCABULARY}, {USED} SELECT p_partkey, field, value FROM used ANTI JOIN voc USING (field, value)",
        "vocab_valid": f"WITH {VOCABULARY}, {USED} SELECT p_partkey, field, value FROM used SEMI JOIN voc USING (field, value)",
        "format_lookup": f"""WITH {USED} SELECT p_partkey, value, coalesce(d, '') AS description, coalesce(m, '') AS mimetype FROM used LEFT JOIN (VALUES {FORMAT_VALUES}) f(n, d, m) ON n = value
            WHERE field = 'format'""",
        "new_columns": """SELECT DISTINCT '/' || event_type AS dest, c AS "column" FROM events CROSS JOIN (SELECT unnest(['kind', 'props']) AS c) WHERE NOT (event_type = 'view' AND c = 'kind')""",
        "typed_params": """WITH o AS (SELECT o_orderkey, o_orderkey % 5 AS k, CASE WHEN o_orderkey % 5 = 0 THEN CASE WHEN o_custkey % 2 = 0 THEN 'TRUE' ELSE 'no' END
            WHEN o_orderkey % 10 = 2 THEN CAST(o_custkey AS VARCHAR) WHEN o_orderkey % 10 = 3 THEN CAST(o_totalprice AS VARCHAR) ELSE o_orderpriority END AS v, o_totalprice FROM orders)
            SELECT o_orderkey, ['boolean', 'string', 'integer', 'float'][k + 1] AS param_type, 'p' || o_orderkey % 3 AS param_name,
            CAST(CASE WHEN k = 0 THEN CASE WHEN lower(v) = 'true' THEN 1 ELSE 0 END ELSE -1 END AS BIGINT) AS boolean_value,
            CAST(CASE WHEN k = 2 THEN coalesce(TRY_CAST(v AS BIGINT), -1) ELSE -1 END AS BIGINT) AS integer_value,
            CASE WHEN k = 3 THEN coalesce(TRY_CAST(v AS DOUBLE), -1.0) ELSE -1.0 END AS float_value, CASE WHEN k = 1 THEN v ELSE '' END AS string_value,
            CAST(CASE WHEN (k = 2 AND TRY_CAST(v AS BIGINT) IS NULL) OR (k = 3 AND TRY_CAST(v AS DOUBLE) IS NULL) THEN 1 ELSE 0 END AS BIGINT) AS invalid FROM o WHERE k < 4""",
        "fragments_status": f"WITH {FRAGMENTS} SELECT id AS fragment_identifier, n AS fragments, status, reason FROM fs",
        "fragments_ready": READY,
        "stream_fragments": READY,
        "stream_fragments_mixed": """WITH s AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS l, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
            SELECT CAST(k AS VARCHAR) AS fragment_identifier, CASE k % 40 WHEN 10 THEN '' WHEN 11 THEN 'x1' WHEN 12 THEN CAST(-l AS VARCHAR) WHEN 13 THEN '0' ELSE CAST(l - 1 AS VARCHAR) END AS fragment_index,
            CASE WHEN k % 40 = 1 THEN 'two' WHEN k % 40 = 2 THEN '0' WHEN k % 40 = 3 THEN CAST(n + l AS VARCHAR) ELSE CAST(n AS VARCHAR) END AS fragment_count,
            CASE WHEN k % 40 = 1 THEN 'count-not-an-integer' WHEN k % 40 = 2 THEN 'count-not-positive' WHEN k % 40 = 3 THEN 'count-inconsistent'
              WHEN k % 40 = 10 THEN 'index-missing' WHEN k % 40 = 11 THEN 'index-not-an-integer' WHEN k % 40 = 12 THEN 'index-negative'
              WHEN k % 40 = 13 AND n > 1 THEN 'index-duplicate' ELSE '' END AS reason
            FROM s WHERE k % 40 NOT IN (0, 4, 5, 6, 7, 8, 9) AND NOT (k % 40 = 3 AND n = 1)""",
        "failed_rows": "SELECT event_id, CASE WHEN event_id % 4999 = 7 THEN 'failed' ELSE 'committed' END AS outcome FROM events",
        "json_valid": """WITH t AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN substr(props, 1, event_id % 11 + 1) ELSE '[' || event_id % 5 || CASE WHEN event_id % 2 = 0 THEN ']' ELSE '' END END AS s FROM events)
            SELECT event_id, CAST(CASE WHEN regexp_matches(s, '^[{\\[]') AND json_valid(s) THEN 1 ELSE 0 END AS BIGINT) AS valid FROM t""",
        "sql_functions": f"""WITH {EV} SELECT event_id, {enc("('/' || event_type || '=X' || user_id)", 'postgresql')} AS name,
            strftime(ts, '%Y-%m-%dT%H:%M:%S.') || CAST(ms % 1000 AS VARCHAR) || 'Z' AS recv, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS origin, day(ts) AS slot, 'hour' AS bucket_range,
            round({2 * EARTH_RADIUS_M!r} * asin(sqrt(pow(sin(radians(45) / 2), 2) + cos(radians(45)) * pow(sin(radians(user_id) / 2), 2))) / 1000, 3) AS km FROM ev""",
        "header_capture": f"""WITH {EV} SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 3 THEN 's' ELSE 'test' END AS service,
            CASE event_id % 4 WHEN 2 THEN '/a' WHEN 3 THEN path ELSE '/path' END AS path, ms AS recv_time_ts,
            CAST(CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END AS BIGINT) AS generated, CAST(CASE WHEN event_id % 4 = 2 THEN 1 ELSE 2 END AS BIGINT) AS kept FROM ev""",
    }
