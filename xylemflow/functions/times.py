"""Time arithmetic on TIMESTAMP_NTZ columns (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_US = 60.0 * 1_000_000.0
YEAR_US = 365.25 * 24.0 * 60.0 * 60.0 * 1_000_000.0


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a naive timestamp read as UTC."""
    return F.unix_micros(ts.cast("timestamp_ltz"))


def local_to_utc_offset(zone: Column, local: Column) -> Column:
    """Seconds east of UTC at a local wall-clock time.

    An ambiguous time takes the larger offset (Spark resolves it so); a time inside a
    spring-forward gap does not survive the round trip and takes offset 0.
    """
    utc = F.convert_timezone(zone, F.lit("UTC"), local)
    back = F.convert_timezone(F.lit("UTC"), zone, utc)
    seconds = ((micros(local) - micros(utc)) / F.lit(1_000_000)).cast("int")
    return F.when(back == local, seconds).otherwise(
        F.when(back.isNotNull(), F.lit(0))
    )


def shift_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def utc_to_local(zone: Column, utc: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), zone, utc)


def rfc3339_micros(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def within(ts: Column, start: Column, end: Column) -> Column:
    """Half-open interval test; a null end is open."""
    return (ts >= start) & (end.isNull() | (ts < end))
