"""Ids that go on where the last append ended.

A ledger beside a stored table (``sinks.versions``) has the largest id that each
batch gave out for each destination. A batch adds its own consecutive numbers to
that, and rows and ledger become visible in one version, so an id is never given
twice: a repeated batch finds its first attempt, and of two writers at once the later
one reads the ledger again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoctx import model as M
from chronoctx.operators.ordered import HOT_ROWS
from chronoctx.operators.trajectory import with_row_ids
from chronoctx.plans.session import store
from chronoctx.sinks import versions as V

ATTEMPTS = 5


def largest(spark: SparkSession, root: str, table: str, keys: list[str], version: int | None = None) -> DataFrame | None:
    """The largest id of every destination, as ``last_id``."""
    ledger = V.read(spark, root, f"{table}_ids", version)
    return None if ledger is None else ledger.groupBy(*keys).agg(F.max("last_id").alias("last_id"))


def append_with_ids(
    spark: SparkSession, root: str, table: str, rows: DataFrame, keys: list[str], by: list[str], name: str = "_id",
    start: int = 1, token: str | None = None, time_ms: str = M.RECV_TIME_TS, hot_rows: int = HOT_ROWS, **layout,
) -> int:
    """Append ``rows`` with consecutive ids per destination, ordered ``by`` columns whose order is
    total. The first id of a destination is ``start``. Keys are not null. Returns the version."""
    for number, record in V.versions(spark, root).items():
        if token is not None and record.get("token") == token:
            return number
    rows = store(rows, "rows")  # counted before they are numbered
    fresh = store(with_row_ids(rows, keys, by, name, 1, hot_rows), "fresh-ids")
    given = fresh.groupBy(*keys).agg(F.max(name).alias("_n"))
    for _ in range(ATTEMPTS):
        version = max(V.versions(spark, root), default=0)
        before = largest(spark, root, table, keys, version)
        offset = F.lit(start - 1).cast("long")
        if before is None:
            numbered, last = fresh.withColumn(name, F.col(name) + offset), given.withColumn("last_id", F.col("_n") + offset)
        else:
            # Both sides meet on their keys only; a hot destination is split as any skewed join is.
            known = before.withColumnRenamed("last_id", "_last")
            base = F.coalesce("_last", offset)
            numbered = fresh.join(known, keys, "left").withColumn(name, F.col(name) + base).select(*fresh.columns)
            last = given.join(known, keys, "left").withColumn("last_id", F.col("_n") + base)
        try:
            return V.commit(
                spark, root, {table: numbered, f"{table}_ids": last.select(*keys, "last_id")}, time_ms=time_ms, token=token,
                based_on=version, **layout)
        except V.Conflict:
            continue
    raise V.Conflict(f"{ATTEMPTS} other writers came first")


def compact(spark: SparkSession, root: str, table: str, keys: list[str]) -> int | None:
    """One row per destination instead of one per batch."""
    version = max(V.versions(spark, root), default=0)
    last = largest(spark, root, table, keys, version)
    if last is None:
        return None
    old = V.file_list(spark, root, version).filter(F.col("table") == f"{table}_ids")
    return V.commit(spark, root, {f"{table}_ids": last}, partitions=(), order=(), taken_out=store(old, "ledger"), based_on=version)
