"""Notifications made from the analytic tables.

The bodies are built as JSON text, so that the whole parser is in the path of
every query that runs over them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoctx import model as M

#: Bytes of Parquet that one task parses, some 100,000 events.
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _headers(service: Column, path: Column) -> Column:
    # mixed case on purpose: header names are case-insensitive
    return F.create_map(
        F.lit("Content-Type"), F.lit("application/json"),
        F.lit(M.HEADER_SERVICE.title()), service,
        F.lit(M.HEADER_SERVICE_PATH), path,
    )


def _attribute(type_: str, value: Column, metadata: Column | None = None) -> Column:
    md = metadata if metadata is not None else F.from_json(F.lit("{}"), "map<string,string>")
    return F.struct(F.lit(type_).alias("type"), value.alias("value"), md.alias("metadata"))


def position(user_id: Column, event_id: Column) -> tuple[Column, Column]:
    """Synthetic (lon, lat) of an event."""
    lon = F.pmod(user_id * 37 + event_id * 13, F.lit(360)) - 180
    lat = F.pmod(user_id * 17 + event_id * 7, F.lit(180)) - 90
    return lon, lat


def v2_body(*attributes: Column, entity_id: Column, entity_type: Column) -> Column:
    entity = F.struct(entity_id.alias("id"), entity_type.alias("type"), *attributes)
    return F.to_json(F.struct(F.lit("sub-1").alias("subscriptionId"), F.array(entity).alias("data")))


def event_notifications(events: DataFrame, geo: bool = False) -> DataFrame:
    """One v2 notification per event, about the user as entity."""
    instant = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    unit = F.create_map(
        F.lit("unit"), F.struct(F.lit("Text").alias("type"), F.lit("ms").alias("value")),
        F.lit("TimeInstant"), F.struct(F.lit("DateTime").alias("type"), instant.alias("value")),
    )
    attributes = [
        _attribute("Number", F.col("value"), unit).alias("value"),
        _attribute("Text", F.col("event_type")).alias("kind"),
        _attribute("StructuredValue", F.from_json("props", "struct<k:bigint>")).alias("props"),
    ]
    if geo:
        lon, lat = position(F.col("user_id"), F.col("event_id"))
        text = F.concat(lat.cast("string"), F.lit(", "), lon.cast("string"))
        attributes.append(_attribute("geo:point", text).alias("location"))
    body = v2_body(
        *attributes, entity_id=F.concat(F.lit("user"), F.col("user_id").cast("string")), entity_type=F.lit("User")
    )
    return events.select(
        "event_id",
        _headers(F.lit("web"), F.concat(F.lit("/"), F.col("event_type"))).alias("headers"),
        body.alias("body"),
        F.col("ts").cast("timestamp").alias("ingest_ts"),
    )


def order_notifications(orders: DataFrame) -> DataFrame:
    """One LD notification per order."""
    day = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def urn(kind: str, key: str) -> Column:
        return F.concat(F.lit(f"urn:ngsi-ld:{kind}:"), F.col(key).cast("string"))

    status = F.struct(F.lit("Property").alias("type"), F.col("o_orderstatus").alias("value"))
    handler = F.struct(F.lit("Relationship").alias("type"), urn("Clerk", "o_orderstatus").alias("object"))
    total = F.struct(
        F.lit("Property").alias("type"), F.col("o_totalprice").alias("value"),
        day.alias("observedAt"), F.lit("EUR").alias("unitCode"), status.alias("status"), handler.alias("handledBy"),
    )
    point = F.struct(
        F.lit("Point").alias("type"),
        F.array(
            F.pmod(F.col("o_custkey"), F.lit(360)) - 180, F.pmod(F.col("o_orderkey"), F.lit(180)) - 90
        ).alias("coordinates"),
    )
    entity = F.struct(
        urn("Order", "o_orderkey").alias("id"), F.lit("Order").alias("type"),
        F.lit("https://schema.org").alias("@context"),
        total.alias("totalPrice"),
        F.struct(F.lit("Property").alias("type"), F.col("o_orderpriority").alias("value")).alias("priority"),
        F.struct(F.lit("Relationship").alias("type"), urn("Customer", "o_custkey").alias("object")).alias("placedBy"),
        F.struct(F.lit("GeoProperty").alias("type"), point.alias("value")).alias("location"),
    )
    body = F.to_json(F.struct(
        F.lit("urn:ngsi-ld:Notification:1").alias("id"), F.lit("Notification").alias("type"),
        F.array(entity).alias("data"),
    ))
    return orders.select(
        F.col("o_orderkey").alias("event_id"),
        _headers(F.lit("Sales"), F.lit("/ignored")).alias("headers"),
        body.alias("body"),
        F.col("o_orderdate").cast("timestamp").alias("ingest_ts"),
    )


def pieces(df: DataFrame) -> int:
    """How many tasks the rows of few large files should be dealt to: every core has
    one, and none has more than ``PIECE_BYTES`` of the files. 0 for enough files."""
    spark = df.sparkSession
    cores, paths = spark.sparkContext.defaultParallelism, df.inputFiles()
    if len(paths) >= cores:
        return 0
    size, conf = 0, spark._jsc.hadoopConfiguration()
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        size += path.getFileSystem(conf).getFileStatus(path).getLen()
    return max(cores, -(-size // PIECE_BYTES))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread the rows of few large files over all cores by a key, because
    parsing is bound by CPU. Tables of enough files stay as they are."""
    count = pieces(df)
    return df.repartition(count, key) if count else df
