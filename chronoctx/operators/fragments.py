"""Assembly of transactions that arrive in numbered fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

READY, WAIT, INVALID = "READY", "WAIT", "INVALID"


#: What can be wrong with one fragment, counts before indices.
FAULTS = ("count-missing", "count-not-an-integer", "count-not-positive", "index-missing", "index-not-an-integer", "index-negative")


def integer(text: Column) -> Column:
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))


def faults(index: Column, count: Column) -> dict[str, Column]:
    """A condition, never null, for each of ``FAULTS``."""
    total, place = integer(count), integer(index)
    found = (
        count.isNull(), count.isNotNull() & total.isNull(), total < 1,
        index.isNull(), index.isNotNull() & place.isNull(), place < 0,
    )
    return {name: F.coalesce(condition, F.lit(False)) for name, condition in zip(FAULTS, found)}


def fragment_status(
    df: DataFrame, now_ms: int, timeout_ms: int | None = None,
    identifier: str = "fragment_identifier", index: str = "fragment_index", count: str = "fragment_count",
    queued: str = "last_queue_ts",
) -> DataFrame:
    """READY, WAIT or INVALID (with ``reason``) for every identifier.

    A lone fragment without a count is READY. When several rules are broken the
    first in the order below is the reason. Fragments are combined per (identifier,
    index) before they are combined per identifier.
    """
    total, place = integer(F.col(count)), integer(F.col(index))
    flags = faults(F.col(index), F.col(count))
    names = {reason: f"_{i}" for i, reason in enumerate(flags)}
    per_index = df.groupBy(identifier, place.alias("_place")).agg(
        F.count("*").alias("_rows"), F.min(total).alias("_low"), F.max(total).alias("_high"),
        F.max(queued).alias("_queued"), *[F.max(flag).alias(names[r]) for r, flag in flags.items()],
    )
    whole = per_index.groupBy(identifier).agg(
        F.sum("_rows").alias("fragments"), F.min("_low").alias("_low"), F.max("_high").alias("expected"),
        F.max("_queued").alias("_queued"), F.max((F.col("_rows") > 1) & F.col("_place").isNotNull()).alias("_twice"),
        *[F.max(c).alias(c) for c in names.values()],
    )
    broken = dict(names)
    reasons = [F.when(F.col(broken.pop(r)), F.lit(r)) for r in ("count-missing", "count-not-an-integer", "count-not-positive")]
    reasons.append(F.when(F.col("_low") != F.col("expected"), F.lit("count-inconsistent")))
    reasons += [F.when(F.col(c), F.lit(r)) for r, c in broken.items()]
    reasons.append(F.when(F.col("_twice"), F.lit("index-duplicate")))
    lone = (F.col("fragments") == 1) & F.col(names["count-missing"])
    complete = F.col("fragments") == F.col("expected")
    late = F.lit(False)
    if timeout_ms is not None:
        late = (F.col("_queued") > 0) & (F.lit(now_ms) - F.col("_queued") > timeout_ms)
    reason = F.when(~lone, F.coalesce(*reasons, F.when(~complete & late, F.lit("timeout"))))
    return whole.withColumn("reason", reason).select(
        identifier, "fragments",
        F.when(F.col("reason").isNotNull(), F.lit(INVALID))
        .when(lone | complete, F.lit(READY)).otherwise(F.lit(WAIT)).alias("status"),
        "reason",
    )


def split_by_status(df: DataFrame, status: DataFrame, identifier: str = "fragment_identifier") -> dict[str, DataFrame]:
    """The fragments themselves, by the status of their transaction."""
    joined = df.join(status.select(identifier, "status", "reason"), identifier)
    return {s: joined.filter(F.col("status") == s).drop("status") for s in (READY, WAIT, INVALID)}
