"""Distance, time and speed statistics along the path of a moving entity.

Points come in as rows with ``dest`` columns (the group), ``recv_time_ts``, a
tie-breaker and ``lon``/``lat``. Each row is compared with the previous row of
its group. Statistics stored earlier are continued by adding the last stored
row of each group in front of the new ones, so no join is needed for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronoctx import model as M
from chronoctx.functions import geo as G
from chronoctx.operators.ordered import HOT_ROWS, OrderedGroups

# Running extremes before the first movement.
MAX_SEED = 1.4e-45
MIN_SEED = 3.4028235e38

METRICS = ("Distance", "Time", "Speed")


def with_row_ids(
    df: DataFrame, keys: list[str], order: list[str], name: str = "cartodb_id", start: int = 1,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Consecutive row ids per group (or over all rows when ``keys`` is empty)."""
    return OrderedGroups.of(df, keys, order, hot_rows).numbered(name, start).result()


def trajectory(
    points: DataFrame,
    keys: list[str],
    tie_breaker: str | list[str],
    stored: DataFrame | None = None,
    scale: int | None = None,
    moments: bool = False,
    max_seed: float = MAX_SEED,
    min_seed: float = MIN_SEED,
    hot_rows: int = HOT_ROWS,
    measure: str = "sphere",
) -> DataFrame:
    """Add the stage and running columns of TRAJECTORY_COLUMNS to ``points``.

    ``points`` needs ``recv_time_ts``, ``lon``, ``lat`` and may hold
    ``stage_distance`` (metres) to be used instead of the computed distance.
    ``stored`` is the output of ``last_rows`` over earlier results.

    ``sum2X`` is the square of the running sum and a zero time difference gives
    a NULL speed that the sums skip. With ``scale`` the stages are rounded to
    that many decimals and added up exactly, as decimals, so the result does not
    depend on the order in which partial sums are added. ``moments`` adds the
    running mean and variance of the stages. ``measure`` is that of the distances,
    ``sphere`` or ``ellipsoid``.
    """
    points = points.withColumn("_old", F.lit(0))
    if stored is not None:
        points = points.unionByName(stored.withColumn("_old", F.lit(1)), allowMissingColumns=True)
    points = points.withColumn("_new", 1 - F.col("_old"))

    ties = [tie_breaker] if isinstance(tie_breaker, str) else tie_breaker
    groups = OrderedGroups.of(points, keys, ["_new", "recv_time_ts", *ties], hot_rows)
    groups = groups.map(lambda df: df.withColumn("_here", F.struct("lon", "lat", "recv_time_ts"))).lag(_before="_here")
    groups = groups.map(lambda df: _stages(df, scale, measure)).running(**_running(stored is not None, moments, scale))
    return groups.map(lambda df: _finish(df, moments, max_seed, min_seed)).result()


def _rounded(value: Column, scale: int | None) -> Column:
    return value if scale is None else F.round(value, scale)


def _stages(df: DataFrame, scale: int | None, measure: str) -> DataFrame:
    before = F.col("_before")
    first = before.isNull()
    metres = G.MEASURES[measure](before["lon"], before["lat"], F.col("lon"), F.col("lat"))
    if "stage_distance" in df.columns:
        metres = F.coalesce(F.col("stage_distance"), metres)
    zero = F.lit(0.0)
    fresh = df.withColumns({
        "_distance": F.when(first, zero).otherwise(_rounded(metres, scale)),
        "_time": F.when(first, F.lit(0)).otherwise(F.col("recv_time_ts") - before["recv_time_ts"]),
        "_first": first,
    })
    speed = F.when(F.col("_first"), zero).otherwise(
        _rounded(F.col("_distance") / F.nullif(F.col("_time"), F.lit(0)), scale)
    )
    return fresh.withColumns({"stageDistance": F.col("_distance"), "stageTime": F.col("_time"), "stageSpeed": speed})


def _running(resumed: bool, moments: bool, scale: int | None) -> dict[str, tuple[str, Column]]:
    """Running aggregates; a stored row contributes what it had reached."""
    def either(old: str, new: Column) -> Column:
        return F.when(F.col("_old") == 1, F.col(old)).otherwise(new) if resumed else new

    def addend(value: Column, digits: int = 30) -> Column:
        return value.cast("double" if scale is None else f"decimal({digits},{scale})")

    moved = ~F.col("_first")
    one = F.lit(1).cast("bigint")
    out = {"numSamples": ("sum", either("_old_numSamples", one)), "cartodb_id": ("sum", either("_old_cartodb_id", one))}
    for metric in METRICS:
        stage = F.col(f"stage{metric}")
        sample = F.when(moved, stage)
        out[f"sum{metric}"] = ("sum", addend(either(f"_old_sum{metric}", stage)))
        out[f"max{metric}"] = ("max", either(f"_old_max{metric}", sample))
        out[f"min{metric}"] = ("min", either(f"_old_min{metric}", sample))
        if moments:
            value = F.coalesce(sample, F.lit(0))
            out[f"_n{metric}"] = ("sum", F.when(moved & stage.isNotNull(), F.lit(1)).otherwise(F.lit(0)))
            out[f"_m1{metric}"] = ("sum", addend(value))
            out[f"_m2{metric}"] = ("sum", addend(value, 18) * addend(value, 18))
    return out


def _finish(df: DataFrame, moments: bool, max_seed: float, min_seed: float) -> DataFrame:
    out = df.filter(F.col("_old") == 0)
    columns = {}
    for metric in METRICS:
        total = F.col(f"sum{metric}").cast("double")
        columns[f"stage{metric}"] = F.col(f"stage{metric}").cast("double")
        columns[f"sum{metric}"] = total
        columns[f"sum2{metric}"] = total * total
        columns[f"max{metric}"] = F.greatest(F.col(f"max{metric}").cast("double"), F.lit(max_seed))
        columns[f"min{metric}"] = F.least(F.col(f"min{metric}").cast("double"), F.lit(min_seed))
        if moments:
            n = F.nullif(F.col(f"_n{metric}"), F.lit(0))
            mean = F.col(f"_m1{metric}").cast("double") / n
            spread = F.greatest(F.col(f"_m2{metric}").cast("double") / n - mean * mean, F.lit(0.0))
            columns[f"avg{metric}"] = mean
            columns[f"var{metric}"] = F.when(mean.isNotNull(), spread)
    return out.withColumns(columns).drop(*[c for c in df.columns if c.startswith("_")])


def last_rows(results: DataFrame, keys: list[str]) -> DataFrame:
    """Per group, the last stored row in the form ``trajectory`` continues from.

    ``results`` is earlier output of ``trajectory`` (with ``recv_time_ts``).
    """
    kept = ["recv_time_ts", "lon", "lat", "cartodb_id", "numSamples"]
    kept += [f"{kind}{metric}" for metric in METRICS for kind in ("sum", "max", "min")]
    last = latest(results.select(*keys, *kept), keys, "cartodb_id")
    carried = [c for c in kept if c not in ("recv_time_ts", "lon", "lat")]
    return last.select(
        *keys, "recv_time_ts", "lon", "lat",
        *[F.col(c).alias(f"_old_{c}") for c in carried],
    )


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` of every group. Each task keeps one
    row of a group before the shuffle, however large the group is."""
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    return df.withColumn("_newest", newest).filter(F.col("_newest") == 1).drop("_newest")


def trajectory_layout(results: DataFrame) -> DataFrame:
    """The stored columns in their order, from trajectory results that carry
    the entity columns and the two geometries."""
    named = results.withColumnsRenamed({
        "recv_time_ts": M.RECV_TIME_TS, "service_path": M.SERVICE_PATH,
        "entity_id": M.ENTITY_ID, "entity_type": M.ENTITY_TYPE,
    })
    extra = [c for c in ("dest_db", "dest_table") if c in named.columns]
    return named.select(*extra, *M.TRAJECTORY_COLUMNS)
