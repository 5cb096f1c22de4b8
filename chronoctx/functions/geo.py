"""Geometry of ``geo:point`` and ``geo:json`` attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GEO_TYPES = ("geo:point", "geo:json")
EARTH_RADIUS_M = 6371008.8          # mean radius, metres
MERCATOR_RADIUS_M = 6378137.0       # EPSG:3857 sphere
# The WGS 84 ellipsoid.
SEMI_MAJOR_M = 6378137.0
FLATTENING = 1 / 298.257223563
GEOMETRY_TYPE = "struct<lon:double,lat:double,srid:int,geojson:string>"


def is_geo(attr_type: Column) -> Column:
    return F.lower(attr_type).isin(*GEO_TYPES)


def geometry(attr_type: Column, attr_value: Column, swap: bool = False, srid: int = 4326) -> Column:
    """Geometry struct of an attribute, NULL when it is not geographic.

    The first number of a point text is X (longitude) unless ``swap``.
    """
    kind = F.lower(attr_type)
    parts = F.split(attr_value, ",")
    first = F.trim(F.get(parts, F.lit(0))).try_cast("double")
    second = F.trim(F.get(parts, F.lit(1))).try_cast("double")
    lon, lat = (second, first) if swap else (first, second)
    point = F.struct(
        lon.alias("lon"), lat.alias("lat"), F.lit(srid).alias("srid"),
        F.lit(None).cast("string").alias("geojson"),
    )
    is_point = F.get_json_object(attr_value, "$.type") == "Point"
    json = F.struct(
        F.when(is_point, F.get_json_object(attr_value, "$.coordinates[0]").try_cast("double")).alias("lon"),
        F.when(is_point, F.get_json_object(attr_value, "$.coordinates[1]").try_cast("double")).alias("lat"),
        F.lit(srid).alias("srid"),
        attr_value.alias("geojson"),
    )
    return (
        F.when((kind == "geo:point") & first.isNotNull() & second.isNotNull(), point)
        .when(kind == "geo:json", json)
        .cast(GEOMETRY_TYPE)
    )


def geometry_webmercator(geom: Column, project: bool = False) -> Column:
    """SRID 3857 twin of a geometry: relabelled, or really projected."""
    lon, lat = geom["lon"], geom["lat"]
    if project:
        x = F.lit(MERCATOR_RADIUS_M) * F.radians(lon)
        y = F.lit(MERCATOR_RADIUS_M) * F.log(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / 2))
        lon, lat = x, y
    twin = F.struct(
        lon.alias("lon"), lat.alias("lat"), F.lit(3857).alias("srid"), geom["geojson"].alias("geojson")
    )
    return F.when(geom.isNotNull(), twin).cast(GEOMETRY_TYPE)


def distance_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def distance_ellipsoid_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Geodesic distance in metres on the WGS 84 ellipsoid, in closed form: the
    great circle between the reduced latitudes with the flattening's first-order
    terms, as Lambert gives them for long lines. Within 50 m in 1,000 km of the
    geodesic but for nearly antipodal points; 0 for equal points, half a meridian
    for the poles."""
    def reduced(lat: Column) -> Column:
        # atan2 keeps the poles, where the tangent has no end
        return F.atan2(F.lit(1 - FLATTENING) * F.sin(F.radians(lat)), F.cos(F.radians(lat)))

    one, two = reduced(lat1), reduced(lat2)
    mean, half = (one + two) / 2, (two - one) / 2
    across = F.sin(F.radians(lon2 - lon1) / 2)
    h = F.greatest(F.lit(0.0), F.least(
        F.sin(half) * F.sin(half) + F.cos(one) * F.cos(two) * across * across, F.lit(1.0)))
    angle = F.lit(2.0) * F.asin(F.sqrt(h))
    none = F.lit(0.0)
    # Neither quotient is above 1; both have no value where the points meet or face each other.
    far = F.coalesce(F.sin(mean) * F.sin(mean) * F.cos(half) * F.cos(half) / F.nullif(1 - h, none), none)
    near = F.coalesce(F.cos(mean) * F.cos(mean) * F.sin(half) * F.sin(half) / F.nullif(h, none), none)
    shrink = (angle - F.sin(angle)) * far + (angle + F.sin(angle)) * near
    return F.lit(SEMI_MAJOR_M) * (angle - F.lit(FLATTENING / 2) * shrink)


#: How the distance between two points is measured.
MEASURES = {"sphere": distance_m, "ellipsoid": distance_ellipsoid_m}


def as_text(geom: Column) -> Column:
    """``SRID=4326;POINT(lon lat)`` or the GeoJSON text, as the stores keep it."""
    point = F.concat(
        F.lit("SRID="), geom["srid"].cast("string"), F.lit(";POINT("),
        geom["lon"].cast("string"), F.lit(" "), geom["lat"].cast("string"), F.lit(")"),
    )
    return F.coalesce(geom["geojson"], point)
