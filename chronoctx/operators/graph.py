"""Entities and their relationships as node and edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges(rows: DataFrame) -> DataFrame:
    """Relationship attributes and sub-attributes as (source, predicate, target).

    Takes LD attribute rows; the predicate of a sub-attribute is
    ``<attribute>_<sub-attribute>``.
    """
    own = F.struct(
        F.col("attr_name").alias("predicate"), F.col("attr_type").alias("type"), F.col("attr_value").alias("target")
    )
    nested = F.transform("sub_attrs", lambda s: F.struct(
        F.concat_ws("_", F.col("attr_name"), s["name"]).alias("predicate"), s["type"].alias("type"),
        s["value"].alias("target"),
    ))
    links = F.filter(F.concat(F.array(own), nested), lambda e: e["type"] == "Relationship")
    kept = [c for c in ("event_id", "recv_time_ts") if c in rows.columns]
    return rows.select(*kept, F.col("entity_id").alias("source"), F.inline(links)).drop("type")


def nodes(rows: DataFrame) -> DataFrame:
    """Distinct entities."""
    return rows.select(F.col("entity_id").alias("id"), F.col("entity_type").alias("type")).distinct()
