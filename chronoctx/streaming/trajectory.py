"""Streaming trajectory statistics.

Every group keeps its last row and its running values in keyed state, so a batch
reads and writes the state of the groups that it has rows of, and no other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from chronoctx.functions.geo import EARTH_RADIUS_M
from chronoctx.operators.trajectory import MAX_SEED, METRICS, MIN_SEED
from chronoctx.sinks.files import write_batch

_STATE = "recv_time_ts long, lon double, lat double, n long, " + ", ".join(
    f"sum{m} decimal(38,9), total{m} double, max{m} double, min{m} double" for m in METRICS)
_GIVEN = [f"{kind}{m}" for m in METRICS for kind in ("stage", "sum", "sum2", "max", "min")]


def great_circle_m(lon1: float, lat1: float, lon2: float, lat2: float) -> float:
    """``geo.distance_m`` of two points in a state."""
    dlat, dlon = math.radians(lat2 - lat1) / 2, math.radians(lon2 - lon1) / 2
    h = math.sin(dlat) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(dlon) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(h, 1.0)))


class Path(StatefulProcessor):
    """One group's path. Rows of one batch are put in order of time and of
    ``ties``; the batches follow each other as they arrive. What a group has in one
    batch is sorted in memory, so the size of a batch is the bound."""

    def __init__(
        self, schema: StructType, ties: list[str], scale: int | None, distance: Callable[[float, float, float, float], float],
    ):
        self.fields, self.ties, self.scale, self.distance = schema.fieldNames(), ties, scale, distance
        self.given = Row(*self.fields, "cartodb_id", "numSamples", *_GIVEN)

    def init(self, handle) -> None:
        self.state = handle.getValueState("last", _STATE)

    def close(self) -> None:
        pass

    def _rounded(self, value: float | None) -> float | None:
        if value is None or self.scale is None:
            return value
        return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-self.scale), ROUND_HALF_UP))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.state.get()
        ts, lon, lat, n = known[:4] if known is not None else (None, None, None, 0)
        running = [list(known[4 + 4 * i:8 + 4 * i]) if known is not None else [Decimal(0), 0.0, None, None] for i in range(len(METRICS))]
        own = "stage_distance" in self.fields
        for row in sorted(rows, key=lambda r: (r["recv_time_ts"], *(r[t] for t in self.ties))):
            if n == 0:
                stages = (0.0, 0.0, 0.0)
            else:
                metres = row["stage_distance"] if own else None
                if metres is None:
                    metres = self.distance(lon, lat, row["lon"], row["lat"])
                metres, passed = self._rounded(float(metres)), row["recv_time_ts"] - ts
                stages = (metres, float(passed), self._rounded(metres / passed) if passed else None)
            n += 1
            values: list[float | None] = []
            for stage, run in zip(stages, running):
                if stage is not None:
                    if self.scale is None:
                        run[1] += stage
                    else:
                        run[0] += Decimal(repr(stage))
                        run[1] = float(run[0])
                    if n > 1:
                        run[2] = stage if run[2] is None else max(run[2], stage)
                        run[3] = stage if run[3] is None else min(run[3], stage)
                most = MAX_SEED if run[2] is None else max(run[2], MAX_SEED)
                least = MIN_SEED if run[3] is None else min(run[3], MIN_SEED)
                values += [stage, run[1], run[1] * run[1], most, least]
            ts, lon, lat = row["recv_time_ts"], row["lon"], row["lat"]
            yield self.given(*(row[f] for f in self.fields), n, n, *values)
        self.state.update((ts, lon, lat, n, *(value for run in running for value in run)))


def trajectory_stream(
    points: DataFrame, keys: list[str], tie_breaker: str | list[str], scale: int | None = None,
    distance: Callable[[float, float, float, float], float] = great_circle_m,
) -> DataFrame:
    """A stream of points (``keys``, ``recv_time_ts``, ``lon``, ``lat``, ties, none
    of them null) with the stage and running columns of ``trajectory``, whose rules
    hold. ``scale`` is at most 9."""
    schema = points.schema
    given = StructType([*schema.fields]).add("cartodb_id", "long").add("numSamples", "long")
    for name in _GIVEN:
        given = given.add(name, "double")
    ties = [tie_breaker] if isinstance(tie_breaker, str) else tie_breaker
    named = points.withColumns({f"_key_{k}": F.col(k) for k in keys})
    return named.groupBy(*[f"_key_{k}" for k in keys]).transformWithState(Path(schema, ties, scale, distance), given, "Append", "None")


def trajectory_writer(out: str) -> Callable[[DataFrame, int], None]:
    """Batch handler of a stream of statistics: to ``<out>/trajectory``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{out}/trajectory", batch_id)

    write.stateful = True
    return write
