"""Growing schemas: new columns and appends of different width."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_columns(existing: list[str], incoming: list[str]) -> list[str]:
    """Incoming names, lower-cased, that are not among the existing ones."""
    known = set(existing)
    return list(dict.fromkeys(c.lower() for c in incoming if c.lower() not in known))


def new_column_rows(wanted: DataFrame, existing: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The same for many destinations at once."""
    lowered = wanted.select(*keys, F.lower(column).alias(column)).distinct()
    return lowered.join(existing.select(*keys, column), [*keys, column], "left_anti")


def append(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows of both; columns that one side lacks are NULL there."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def add_columns(spark: SparkSession, table: str, columns: list[str]) -> None:
    """Add text columns to a catalog table."""
    if columns:
        declared = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({declared})")
