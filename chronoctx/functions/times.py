"""Reception-time functions. All of them assume a UTC session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Resolution -> (range, number of slots, first offset).
RESOLUTIONS = {
    "second": ("minute", 60, 0),
    "minute": ("hour", 60, 0),
    "hour": ("day", 24, 0),
    "day": ("month", 31, 1),
    "month": ("year", 12, 1),
}


def recv_time(ts_ms: Column) -> Column:
    """``MM/dd/yyyy HH:mm:ss`` text of an epoch in milliseconds."""
    return F.date_format(F.timestamp_millis(ts_ms), "MM/dd/yyyy HH:mm:ss")


def human_readable(ts_ms: Column, add_utc: bool = True) -> Column:
    """ISO text with the milliseconds not padded (``12:00:05.83Z``)."""
    ts = F.timestamp_millis(ts_ms)
    separator, zone = ("'T'", "Z") if add_utc else (" ", "")
    return F.concat(
        F.date_format(ts, f"yyyy-MM-dd{separator}HH:mm:ss"),
        F.lit("."), F.pmod(ts_ms, F.lit(1000)).cast("string"), F.lit(zone),
    )


def milliseconds(iso: Column) -> Column:
    """Epoch milliseconds of an ISO timestamp text; NULL when it is none.

    A fraction that ``human_readable`` wrote unpadded is read as milliseconds
    only by the caller who knows it; here it is an ordinary decimal fraction.
    """
    return F.unix_millis(F.try_to_timestamp(iso))


def seconds(ts_ms: Column) -> Column:
    return F.floor(ts_ms / 1000).cast("bigint")


def bucket_range(resolution: Column) -> Column:
    pairs = [F.lit(x) for r, (rng, _, _) in RESOLUTIONS.items() for x in (r, rng)]
    return F.try_element_at(F.create_map(*pairs), resolution)


def bucket_origin(ts: Column, resolution: str) -> Column:
    return F.date_trunc(RESOLUTIONS[resolution][0], ts)


_OFFSET = {
    "second": F.second, "minute": F.minute, "hour": F.hour,
    "day": F.dayofmonth, "month": F.month,
}


def bucket_offset(ts: Column, resolution: str) -> Column:
    return _OFFSET[resolution](ts)
