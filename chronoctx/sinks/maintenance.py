"""Retention and deletion on stored tables (``sinks.versions``).

Each operation makes at most one new version. Which files it has to touch follows
from the listed ranges of times, or from a pass over the few columns that decide;
only those files are read whole and written anew. The rows that stay are those of
the operators in ``operators.retention``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoctx import model as M
from chronoctx.operators import retention as R
from chronoctx.operators.ordered import HOT_ROWS
from chronoctx.plans.session import store
from chronoctx.sinks import versions as V


def drop_expired(spark: SparkSession, root: str, table: str, now_ms: int, expiration_s: int, time_ms: str = M.RECV_TIME_TS, **layout) -> int | None:
    """Rows older than ``expiration_s`` go. No file is read to find out which ones
    hold any: files with nothing else are taken out, those with both are rewritten."""
    files = V.file_list(spark, root).filter(F.col("table") == table)
    old = R.expired(F.col("low"), now_ms, expiration_s)
    all_old = R.expired(F.col("high"), now_ms, expiration_s)
    return V.rewrite(
        spark, root, table, files.filter(old & ~all_old), lambda rows: R.retain_age(rows, F.col(time_ms), now_ms, expiration_s),
        emptied=files.filter(all_old), time_ms=time_ms, **layout)


def _above(spark: SparkSession, root: str, table: str, keys: list[str], id_: str, limits: DataFrame, **layout) -> int | None:
    """Rows whose id is under their destination's ``_limit`` go; a destination
    without a limit loses all. One pass over keys and ids finds their files."""
    limits = store(limits, "limits")
    rows = V.read(spark, root, table)
    if rows is None:
        return None

    def limited(part: DataFrame) -> DataFrame:
        return part.join(limits, keys, "left")

    doomed = F.coalesce(F.col(id_) < F.col("_limit"), F.lit(True))
    touched = limited(rows.select(*keys, id_, F.col("_metadata.file_path").alias("path"))).filter(doomed).select("path").distinct()
    return V.rewrite(spark, root, table, touched, lambda part: limited(part).filter(~doomed).select(*part.columns), **layout)


def keep_newest(spark: SparkSession, root: str, table: str, keys: list[str], max_records: int, id_: str = "_id", **layout) -> int | None:
    """The ``max_records`` rows with the greatest ids of every destination stay.
    Ids are unique within a destination; keys are not null."""
    rows = V.read(spark, root, table)
    if rows is None:
        return None
    kept = R.retain_newest(rows.select(*keys, id_), keys, max_records, id_)
    return _above(spark, root, table, keys, id_, kept.groupBy(*keys).agg(F.min(id_).alias("_limit")), **layout)


def drop_prefix(
    spark: SparkSession, root: str, table: str, keys: list[str], now_ms: int, expiration_s: int, time_ms: str = M.RECV_TIME_TS,
    id_: str = "_id", **layout,
) -> int | None:
    """The expired rows in front of a destination's first live one go."""
    rows = V.read(spark, root, table)
    if rows is None:
        return None
    live = ~R.expired(F.col(time_ms), now_ms, expiration_s)
    first = rows.groupBy(*keys).agg(F.min(F.when(live, F.col(id_))).alias("_limit"))
    return _above(spark, root, table, keys, id_, first, time_ms=time_ms, **layout)


def keep_capped(
    spark: SparkSession, root: str, table: str, keys: list[str], size: Column, max_bytes: int, max_documents: int,
    id_: str = "_id", hot_rows: int = HOT_ROWS, **layout,
) -> int | None:
    """The newest rows within a byte and a document cap stay; the caps only hold
    when both are set."""
    rows = V.read(spark, root, table)
    if rows is None or not max_bytes or not max_documents:
        return None
    narrow = rows.select(*keys, id_, size.cast("bigint").alias("_size"))
    kept = R.retain_capped(narrow, keys, F.col("_size"), max_bytes, max_documents, id_, hot_rows)
    return _above(spark, root, table, keys, id_, kept.groupBy(*keys).agg(F.min(id_).alias("_limit")), **layout)


def delete_records(spark: SparkSession, root: str, table: str, doomed: DataFrame, keys: list[str], **layout) -> int | None:
    """The records that ``doomed`` names go."""
    rows = V.read(spark, root, table)
    if rows is None:
        return None
    doomed = store(doomed.select(*keys).distinct(), "doomed")
    touched = rows.select(*keys, F.col("_metadata.file_path").alias("path")).join(doomed, keys, "left_semi").select("path").distinct()
    return V.rewrite(spark, root, table, touched, lambda part: R.delete_records(part, doomed, keys), **layout)
