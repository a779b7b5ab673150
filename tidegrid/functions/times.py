"""Naive local time, without session-zone surprises: everything is TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/New_York"


def local_time(ts: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """A naive UTC time as naive local time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts) if isinstance(ts, str) else ts)


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def cyclical(name: str, column: Column, period: float) -> dict[str, Column]:
    """Sine and cosine of a value on a circle."""
    angle = F.lit(2.0) * F.pi() * column / F.lit(float(period))
    return {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}


def day_of_week(ts: Column) -> Column:
    """0 is Monday."""
    return F.weekday(ts)
