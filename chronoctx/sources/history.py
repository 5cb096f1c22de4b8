"""Reading stored history back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoctx.functions.params import run_statement


def page(
    records: DataFrame, offset: int, limit: int, condition: Column | None = None, order: tuple[str, ...] = ("_id",)
) -> DataFrame:
    """One page of the records that meet ``condition``, in id order."""
    if condition is not None:
        records = records.filter(condition)
    return records.orderBy(*order).offset(offset).limit(limit)


def page_after(records: DataFrame, last: Column | int | None, limit: int, order: str = "_id") -> DataFrame:
    """The page behind the record ``last`` (None: the first page). However deep,
    no task holds more than ``limit`` rows; ``page`` holds the offset's too."""
    behind = records if last is None else records.filter(F.col(order) > last)
    return behind.orderBy(order).limit(limit)


def query_text(spark: SparkSession, statement: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Rows of a stored query as comma-joined text."""
    result = run_statement(spark, statement, properties)
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")) for c in result.columns]
    return result.select(F.concat_ws(",", *parts).alias("row"))


def row_counts(records: DataFrame, keys: tuple[str, ...] = ("dest_db", "dest_table")) -> DataFrame:
    """Stored rows per destination."""
    return records.groupBy(*keys).agg(F.count("*").alias("n_rows"))
