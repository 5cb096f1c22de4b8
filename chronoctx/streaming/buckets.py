"""Streaming time buckets.

Every micro-batch writes its own partial buckets, without any state; readers
merge them. Late rows simply make one more partial, as an upsert would. A
compaction replaces many partial batches by one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoctx.operators import buckets as B
from chronoctx.sinks.files import write_batch
from chronoctx.streaming.runtime import batches, read_committed


def bucket_writer(
    out: str, rows_of: Callable[[DataFrame], DataFrame], keys: list[str], value: str = "value",
    resolutions: tuple[str, ...] = B.ALL_RESOLUTIONS,
) -> Callable[[DataFrame, int], None]:
    """Batch handler for numeric buckets; ``rows_of`` turns a micro-batch into
    rows with the keys, the value and ``recv_time_ts``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        partial = B.numeric_buckets(rows_of(batch), keys, value, resolutions=resolutions)
        write_batch(partial, f"{out}/partials", batch_id)

    return write


def categorical_writer(
    out: str, rows_of: Callable[[DataFrame], DataFrame], keys: list[str], value: str = "value",
    resolutions: tuple[str, ...] = B.ALL_RESOLUTIONS,
) -> Callable[[DataFrame, int], None]:
    """Batch handler for categorical buckets, as ``bucket_writer``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        partial = B.categorical_buckets(rows_of(batch), keys, value, resolutions=resolutions)
        write_batch(partial, f"{out}/partials", batch_id)

    return write


def read_occurrences(spark: SparkSession, out: str, keys: list[str], value: str = "value") -> DataFrame:
    """The merged occurrences of all committed batches."""
    return B.merge_categorical(read_committed(spark, out, "partials"), keys, value)


def read_buckets(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The merged buckets of all committed batches."""
    partials = read_committed(spark, out, "partials")
    done = batches(spark, f"{out}/compacted", "upto")
    if done:
        # The folder is named after the batch it reaches to: the newest one holds all before.
        compacted = spark.read.parquet(f"{out}/compacted/upto={done[-1]}")
        partials = partials.filter(F.col("batch_id") > done[-1]).drop("batch_id").unionByName(compacted)
    return B.merge_numeric(partials, keys)


def compact(spark: SparkSession, out: str, keys: list[str], upto: int) -> int:
    """Merge the committed batches up to ``upto`` into one table; says how far it
    reaches. A batch that waits in ``retry`` may still come, so it ends before that."""
    waiting = batches(spark, f"{out}/retry")
    upto = min([upto, *(number - 1 for number in waiting)])
    partials = read_committed(spark, out, "partials").filter(F.col("batch_id") <= upto).drop("batch_id")
    older = [number for number in batches(spark, f"{out}/compacted", "upto") if number <= upto]
    if older:
        partials = read_committed(spark, out, "partials").filter(F.col("batch_id").between(older[-1] + 1, upto)).drop("batch_id").unionByName(
            spark.read.parquet(f"{out}/compacted/upto={older[-1]}"))
    if upto >= 0 and upto not in older:
        B.merge_numeric(partials, keys).write.mode("overwrite").parquet(f"{out}/compacted/upto={upto}")
    return upto
