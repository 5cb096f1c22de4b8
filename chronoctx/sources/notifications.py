"""Readers of raw notifications, batch and streaming.

Each gives RAW_SCHEMA rows: headers, body and ingest_ts. The HTTP listener is
replaced by landing files or a Kafka topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoctx import model as M
from chronoctx.operators.parse import first_entries


def _header_map(headers: dict[str, str] | None) -> Column:
    pairs = [F.lit(x) for item in (headers or {}).items() for x in item]
    return F.create_map(*pairs).cast("map<string,string>")


def from_bodies(df: DataFrame, headers: dict[str, str] | None = None) -> DataFrame:
    """Files read as text: the reception time is the time the file landed."""
    return df.select(
        _header_map(headers).alias("headers"), F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("ingest_ts"),
    )


def read_bodies(
    spark: SparkSession, path: str, headers: dict[str, str] | None = None, one_per_file: bool = False
) -> DataFrame:
    """One JSON body per line, or per file."""
    return from_bodies(spark.read.text(path, wholetext=one_per_file), headers)


def stream_bodies(
    spark: SparkSession, path: str, headers: dict[str, str] | None = None, one_per_file: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    reader = spark.readStream.format("text").option("wholetext", one_per_file)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return from_bodies(reader.load(path), headers)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the members of RAW_SCHEMA."""
    return spark.read.schema(M.RAW_SCHEMA).json(path)


def stream_envelopes(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(M.RAW_SCHEMA).format("json")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def from_kafka(records: DataFrame) -> DataFrame:
    """Records of Spark's Kafka source read with ``includeHeaders``."""
    headers = first_entries(F.transform(
        F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>")),
        lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")),
    ))
    return records.select(
        headers.alias("headers"), F.col("value").cast("string").alias("body"), F.col("timestamp").alias("ingest_ts")
    )
