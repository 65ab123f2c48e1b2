"""Time bars: left-open, right-closed buckets of event time, and the 17-digit clock of the feeds.

A bar is named by its end: an instant on a boundary belongs to the bar that ends there, any other to the next boundary.
Times are wall-clock times without a zone (timestamp_ntz) throughout.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bar widths by name.
UNITS = ("minute", "hour", "day")


def _unit(unit: str) -> str:
    if unit not in UNITS:
        raise ValueError(f"unknown bar width {unit!r}")
    return unit


def bar_end(ts: Column, unit: str = "minute") -> Column:
    """End of the bar that holds ``ts``."""
    return F.date_trunc(_unit(unit), ts - F.expr("INTERVAL 1 MICROSECOND")).cast("timestamp_ntz") + F.expr(f"INTERVAL 1 {unit}")


def bar_start(end: Column, unit: str = "minute") -> Column:
    return end - F.expr(f"INTERVAL 1 {_unit(unit)}")


def bar_key(end: Column) -> Column:
    """``yyyyMMddHHmm`` of a bar's end, as files and folders are named."""
    return F.date_format(end, "yyyyMMddHHmm")


def key_to_end(key: Column) -> Column:
    """The bar end that a key names; null for anything but 12 digits that make a time."""
    return F.try_to_timestamp(F.when(key.rlike(r"^\d{12}$"), key), F.lit("yyyyMMddHHmm")).cast("timestamp_ntz")


def parse_digits(value: Column) -> Column:
    """Instant of a 17-digit number yyyyMMddHHmmssSSS; null if it isn't one."""
    dotted = F.regexp_replace(value.cast("string"), r"^(\d{14})(\d{3})$", "$1.$2")  # what isn't 17 digits gets no dot and doesn't parse
    return F.try_to_timestamp(dotted, F.lit("yyyyMMddHHmmss.SSS")).cast("timestamp_ntz")


def digits(ts: Column) -> Column:
    """The 17-digit number of an instant."""
    return F.date_format(ts, "yyyyMMddHHmmssSSS").cast("long")


def trading_date(ts: Column) -> Column:
    """The date of an instant itself, not of its bar: 23:59:30 stays on its day though its bar ends on the next."""
    return F.to_date(ts)


def bar_date(end: Column) -> Column:
    """The day that a bar's time lies in: a bar that ends at midnight belongs to the day before."""
    return F.to_date(end - F.expr("INTERVAL 1 MICROSECOND"))


def other_date(ts: Column, date: Column) -> Column:
    """Whether an instant isn't on the date that is being worked on."""
    return trading_date(ts) != date


def in_session(end: Column, first: str, last: str) -> Column:
    """Whether a bar's end lies in a trading session given as HHmm texts, both included."""
    return F.date_format(end, "HHmm").between(first, last)


def update_time(end: Column) -> Column:
    return F.date_format(end, "yyyyMMdd HH:mm:00")


def local_time(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def due(watermark: Column, end: Column, delay_minutes: int) -> Column:
    """Whether a bar can be emitted once data of the bar ``watermark`` has been seen: watermark >= end + delay."""
    return watermark >= end + F.expr(f"INTERVAL {int(delay_minutes)} MINUTE")
