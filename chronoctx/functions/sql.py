"""The scalar functions as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from chronoctx.functions.encode import CONCATENATOR, DENIED, ESCAPED_X, OLD_DENIED, allowed
from chronoctx.functions.geo import EARTH_RADIUS_M, FLATTENING, SEMI_MAJOR_M
from chronoctx.functions.times import RESOLUTIONS


def _encoder(kind: str) -> str:
    escaped = f"regexp_replace(s, r'{ESCAPED_X}', 'xx')"
    parts = f"regexp_extract_all({escaped}, r'{allowed(kind)}+|(?s:.)', 0)"
    code = (
        f"CASE WHEN c = '=' THEN '{CONCATENATOR}' WHEN NOT c RLIKE r'{DENIED[kind]}' THEN c "
        "ELSE regexp_replace(lower(hex(encode(c, 'UTF-16BE'))), '(.{4})', 'x$1') END"
    )
    return f"CASE WHEN s RLIKE r'{DENIED[kind]}|{ESCAPED_X}' THEN array_join(transform({parts}, c -> {code}), '') ELSE s END"


def _old(kind: str) -> str:
    return f"regexp_replace(s, r'{OLD_DENIED[kind]}', '_')"


def _case(values: dict[str, str]) -> str:
    return "CASE resolution " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


def ellipsoid_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """``geo.distance_ellipsoid_m`` as SQL text."""
    def reduced(lat: str) -> str:
        return f"atan2({1 - FLATTENING!r}D * sin(radians({lat})), cos(radians({lat})))"

    one, two = reduced(lat1), reduced(lat2)
    mean, half = f"(({one} + {two}) / 2)", f"(({two} - {one}) / 2)"
    h = f"greatest(0D, least(1D, pow(sin{half}, 2) + cos({one}) * cos({two}) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))"
    angle = f"(2 * asin(sqrt({h})))"
    far = f"coalesce(pow(sin{mean} * cos{half}, 2) / nullif(1 - {h}, 0D), 0D)"
    near = f"coalesce(pow(cos{mean} * sin{half}, 2) / nullif({h}, 0D), 0D)"
    shrink = f"(({angle} - sin{angle}) * {far} + ({angle} + sin{angle}) * {near})"
    return f"{SEMI_MAJOR_M!r}D * ({angle} - {FLATTENING / 2!r}D * {shrink})"


def definitions() -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, result type, body)."""
    text = ("s STRING", "STRING")
    out = {f"encode_{kind}": (*text, _encoder(kind)) for kind in DENIED}
    out.update({
        "encode_old": (*text, _old("plain")),
        "encode_old_path": (*text, _old("plain_slash")),
        "encode_old_table": (*text, f"regexp_replace(substr(s, 2), r'{OLD_DENIED['plain']}', '_')"),
        "encode_ld_table": (*text, _old("ld_table")),
        "encode_sth_database": (*text, _old("sth_database")),
        "encode_sth_collection": (*text, _old("sth_collection")),
        "recv_time": ("ts BIGINT", "STRING", "date_format(timestamp_millis(ts), 'MM/dd/yyyy HH:mm:ss')"),
        "human_readable": (
            "ts BIGINT", "STRING",
            "concat(date_format(timestamp_millis(ts), \"yyyy-MM-dd'T'HH:mm:ss\"), '.', pmod(ts, 1000), 'Z')",
        ),
        "milliseconds": ("iso STRING", "BIGINT", "unix_millis(try_to_timestamp(iso))"),
        "bucket_range": (
            "resolution STRING", "STRING", _case({k: f"'{v[0]}'" for k, v in RESOLUTIONS.items()})
        ),
        "bucket_origin": (
            "ts TIMESTAMP, resolution STRING", "TIMESTAMP",
            _case({k: f"date_trunc('{v[0]}', ts)" for k, v in RESOLUTIONS.items()}),
        ),
        "bucket_offset": (
            "ts TIMESTAMP, resolution STRING", "INT",
            _case({"second": "second(ts)", "minute": "minute(ts)", "hour": "hour(ts)",
                   "day": "day(ts)", "month": "month(ts)"}),
        ),
        "geo_distance": (
            "lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE", "DOUBLE",
            f"{2 * EARTH_RADIUS_M!r}D * asin(sqrt(least(1.0D, pow(sin(radians(lat2 - lat1) / 2), 2) "
            "+ cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))",
        ),
        "geo_distance_ellipsoid": (
            "lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE", "DOUBLE", ellipsoid_sql("lon1", "lat1", "lon2", "lat2")),
        "is_json": (*text[:1], "BOOLEAN", r"coalesce(trim(s) RLIKE r'^[{\[]' AND try_parse_json(s) IS NOT NULL, false)"),
        "stored_path": (*text, "regexp_replace(s, '/', '')"),
        "unquoted": (*text, "regexp_replace(s, '\"', '')"),
    })
    return out


def register(spark: SparkSession, prefix: str = "ctx_") -> list[str]:
    """Create all functions as temporary SQL functions; gives their names."""
    names = []
    for name, (parameters, result, body) in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {result} RETURN {body}")
        names.append(prefix + name)
    return names
