"""Retention of stored records per destination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronoctx.operators.ordered import HOT_ROWS, OrderedGroups


def expired(recv_time_ms: Column, now_ms: Column | int, expiration_s: int) -> Column:
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    return recv_time_ms < now - F.lit(expiration_s * 1000)


def retain_newest(
    df: DataFrame, keys: list[str], max_records: int, id_: str = "_id"
) -> DataFrame:
    """The ``max_records`` rows with the greatest id of every destination. Each
    task keeps so many of a destination before the shuffle, so a large one sends
    no more than that from any task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(id_).desc()))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= max_records).drop("_rank")


def retain_age(df: DataFrame, recv_time_ms: Column, now_ms: int, expiration_s: int) -> DataFrame:
    """Rows that have not expired (time to live)."""
    return df.filter(~expired(recv_time_ms, now_ms, expiration_s))


def retain_after_prefix(
    df: DataFrame, keys: list[str], recv_time_ms: Column, now_ms: int, expiration_s: int, id_: str = "_id"
) -> DataFrame:
    """Drop the expired rows in front of the first live one, in id order; later
    expired rows stay, and a destination without live rows loses all."""
    live = ~expired(recv_time_ms, now_ms, expiration_s)
    first_live = df.groupBy(*keys).agg(F.min(F.when(live, F.col(id_))).alias("_first_live"))
    first_live = first_live.filter(F.col("_first_live").isNotNull())
    return df.join(first_live, keys).filter(F.col(id_) >= F.col("_first_live")).select(*df.columns)


def retain_capped(
    df: DataFrame, keys: list[str], size: Column, max_bytes: int, max_documents: int, id_: str = "_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Newest rows that fit both a byte and a document cap; the caps only hold
    when both are set."""
    if not max_bytes or not max_documents:
        return df
    sized = df.withColumn("_size", size)
    ranked = OrderedGroups.of(sized, keys, [f"-{id_}"], hot_rows).running(
        _bytes=("sum", F.col("_size").cast("bigint")), _rank=("sum", F.lit(1).cast("bigint"))
    ).result()
    kept = ranked.filter((F.col("_bytes") <= max_bytes) & (F.col("_rank") <= max_documents))
    return kept.drop("_size", "_bytes", "_rank")


def delete_records(df: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """Everything but the records named by ``doomed``."""
    return df.join(doomed.select(*keys), keys, "left_anti")
