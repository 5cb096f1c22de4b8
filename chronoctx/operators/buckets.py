"""Multi-resolution time buckets.

A bucket is one slot (``offset``) of a range that starts at ``origin``. Every
row takes part once per resolution, in one aggregation with one shuffle: what a
task has seen of a bucket is combined before it is sent, at every resolution, so
a hot key costs one row per bucket and task. Rolling up from the finest
resolution would send nearly all of its buckets twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoctx import options as O
from chronoctx.functions import times as T
from chronoctx.operators.layout import JSON_NUMBER

ALL_RESOLUTIONS = tuple(T.RESOLUTIONS)

# What identifies a bucket document besides its collection.
MODEL_KEYS = {
    O.BY_SERVICE_PATH: ["entity_id", "entity_type", "attr_name"],
    O.BY_ENTITY: ["attr_name"],
    O.BY_ATTRIBUTE: [],
}

BUCKET = ["resolution", "range", "origin", "offset"]


def numeric_value(text: Column) -> Column:
    """Number of an attribute value. NULL when the text is no JSON number, or
    one beyond the doubles: one of those would spoil its bucket for good."""
    number = F.when(text.rlike(JSON_NUMBER), text.try_cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def numeric_buckets(
    rows: DataFrame, keys: list[str], value: str = "value", ts: str = "recv_time_ts",
    resolutions: tuple[str, ...] = ALL_RESOLUTIONS, attr_type: str | None = None,
) -> DataFrame:
    """samples, sum, sum2 (sum of squares), min and max per bucket.

    ``attr_type`` names a column whose latest value is kept per bucket.
    """
    x = F.col(value)
    types = [attr_type] if attr_type else []
    rows = rolled(rows.filter(x.isNotNull()).select(*keys, *types, value, ts), ts, resolutions)
    buckets = rows.groupBy(*keys, *types, "resolution", "_start").agg(
        F.count("*").alias("samples"), F.sum(x).alias("sum"), F.sum(x * x).alias("sum2"),
        F.min(x).alias("min"), F.max(x).alias("max"), F.max(ts).alias("last_ts"),
    )
    if attr_type:
        # the type is a grouping key first, which keeps the large aggregation
        # on fixed-width buffers; few buckets have more than one type to merge
        buckets = merge_units(buckets, [*keys, "resolution", "_start"], attr_type)
    return labelled(buckets, keys)


def merge_units(partials: DataFrame, keys: list[str], attr_type: str | None = None) -> DataFrame:
    last_type = [F.max_by(attr_type, "last_ts").alias(attr_type)] if attr_type else []
    return partials.groupBy(*keys).agg(
        F.sum("samples").alias("samples"), F.sum("sum").alias("sum"), F.sum("sum2").alias("sum2"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.max("last_ts").alias("last_ts"), *last_type,
    )


def merge_numeric(partials: DataFrame, keys: list[str], attr_type: str | None = None) -> DataFrame:
    """Merge bucket tables of several batches; equals one run over all rows."""
    return merge_units(partials, [*keys, *BUCKET], attr_type)


def categorical_buckets(
    rows: DataFrame, keys: list[str], value: str = "value", ts: str = "recv_time_ts",
    resolutions: tuple[str, ...] = ALL_RESOLUTIONS,
) -> DataFrame:
    """Occurrences per bucket and value, one row each (``samples`` is how often
    the value was seen)."""
    rows = rolled(rows.filter(F.col(value).isNotNull()).select(*keys, value, ts), ts, resolutions)
    counts = rows.groupBy(*keys, value, "resolution", "_start").agg(
        F.count("*").alias("samples"), F.max(ts).alias("last_ts")
    )
    return labelled(counts, [*keys, value])


def merge_categorical(partials: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    return partials.groupBy(*keys, value, *BUCKET).agg(
        F.sum("samples").alias("samples"), F.max("last_ts").alias("last_ts")
    )


def occurrence_points(occurrences: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """The occurrence map of each bucket, and how many values it saw in all.

    Occurrences are counted per value before they meet, so a map gets one entry
    for each different value of its bucket."""
    point = [*keys, *BUCKET]
    counts = occurrences.groupBy(*point, value).agg(F.sum("samples").alias("samples"))
    return counts.groupBy(*point).agg(
        F.sum("samples").alias("samples"),
        F.map_from_entries(F.collect_list(F.struct(F.col(value), F.col("samples")))).alias("occur"),
    )


def dense_points(buckets: DataFrame, keys: list[str], **of_document: Column) -> DataFrame:
    """Bucket documents with every slot of their range, empty ones included:
    zero counts and sums, min +Infinity and max -Infinity. ``of_document`` are further
    aggregates over the buckets of a document."""
    stats = ["samples", "sum", "sum2", "min", "max"]
    documents = buckets.groupBy(*keys, "resolution", "range", "origin").agg(
        F.map_from_entries(F.collect_list(F.struct("offset", F.struct(*stats)))).alias("_seen"),  # at most 60 slots
        *[value.alias(name) for name, value in of_document.items()],
    )
    empty = F.struct(
        F.lit(0).cast("bigint").alias("samples"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("sum2"),
        F.lit(float("inf")).alias("min"), F.lit(float("-inf")).alias("max"),
    )
    points = F.transform(_slots(), lambda o: _point(o, F.coalesce(F.col("_seen")[o], empty), stats))
    return documents.withColumn("points", points).drop("_seen")


def dense_occurrences(points: DataFrame, keys: list[str]) -> DataFrame:
    """Categorical documents with every slot, empty ones with an empty map.

    Takes ``occurrence_points``; a document has at most 60 slots.
    """
    documents = points.groupBy(*keys, "resolution", "range", "origin").agg(
        F.map_from_entries(F.collect_list(F.struct("offset", F.struct("samples", "occur")))).alias("_seen")
    )
    empty = F.struct(
        F.lit(0).cast("bigint").alias("samples"), F.create_map().cast("map<string,bigint>").alias("occur")
    )
    filled = F.transform(_slots(), lambda o: _point(o, F.coalesce(F.col("_seen")[o], empty), ["samples", "occur"]))
    return documents.withColumn("points", filled).drop("_seen")


def explode_points(documents: DataFrame) -> DataFrame:
    kept = [c for c in documents.columns if c != "points"]
    return documents.select(*kept, F.inline("points"))


def _point(offset: Column, stats: Column, names: list[str]) -> Column:
    return F.struct(offset.alias("offset"), *[stats[n].alias(n) for n in names])


def _slots() -> Column:
    """All offsets of the row's resolution."""
    out = None
    for name, (_, size, first) in T.RESOLUTIONS.items():
        slots = F.sequence(F.lit(first), F.lit(first + size - 1))
        out = F.when(F.col("resolution") == name, slots) if out is None else out.when(F.col("resolution") == name, slots)
    return out


def rolled(rows: DataFrame, ts: str, resolutions: tuple[str, ...]) -> DataFrame:
    """Every row once per resolution, with the start of its bucket there."""
    if not resolutions or set(resolutions) - set(ALL_RESOLUTIONS):
        raise ValueError(f"resolutions must be some of {ALL_RESOLUTIONS}")
    moment = F.timestamp_millis(ts)
    starts = F.array(*[
        F.struct(F.lit(r).alias("resolution"), F.date_trunc(r, moment).alias("_start")) for r in resolutions
    ])
    return rows.select(*rows.columns, F.inline(starts))


def labelled(rolled: DataFrame, keys: list[str]) -> DataFrame:
    """Turn (resolution, start) into resolution, range, origin and offset."""
    start = F.col("_start")

    def by_resolution(value) -> Column:
        out = None
        for name in ALL_RESOLUTIONS:
            hit = F.col("resolution") == name
            out = F.when(hit, value(name)) if out is None else out.when(hit, value(name))
        return out

    rest = [c for c in rolled.columns if c not in (*keys, "resolution", "_start")]
    return rolled.select(
        *keys, "resolution",
        by_resolution(lambda r: F.lit(T.RESOLUTIONS[r][0])).alias("range"),
        by_resolution(lambda r: T.bucket_origin(start, r)).alias("origin"),
        by_resolution(lambda r: T.bucket_offset(start, r)).alias("offset"),
        *rest,
    )
