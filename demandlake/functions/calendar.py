"""Buckets and periods of the ten frequencies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlake.spec import FREQUENCIES, frequency_step

# 1970-01-01 is a Thursday, so weekly windows shifted by four days start on Monday.
_WEEK_SHIFT = "4 days"


def bucket_start(timestamp: Column | str, frequency: str) -> Column:
    """Start of the bucket a timestamp falls in, always as a timestamp."""
    months, seconds = frequency_step(frequency)
    ts = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    if months:
        return F.date_trunc("year" if frequency == "Y" else "month", ts)
    width = f"{seconds} seconds"
    if frequency == "W":
        return F.window(ts, width, startTime=_WEEK_SHIFT).getField("start")
    return F.window(ts, width).getField("start")


def add_periods(timestamp: Column, frequency: str, count: Column | int) -> Column:
    """``timestamp`` moved by ``count`` steps; months and years are calendar steps."""
    months, seconds = frequency_step(frequency)
    n = (F.lit(count) if isinstance(count, int) else count).cast("int")
    if months:
        return timestamp + F.make_ym_interval(F.lit(0), n * F.lit(months))
    # bigint arithmetic: 15 years of minutes already pass 2^28, and steps are seconds
    return F.timestamp_micros(
        F.unix_micros(timestamp) + n.cast("bigint") * F.lit(seconds * 1_000_000)
    )


def periods_between(start: Column, end: Column, frequency: str) -> Column:
    """Whole steps from one bucket start to another."""
    months, seconds = frequency_step(frequency)
    if months:
        whole = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
        return F.floor(whole / F.lit(months)).cast("bigint")
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(seconds * 1_000_000)).cast("bigint")


def month_starting(timestamp: Column | str) -> Column:
    """First day of the month as ``yyyy-MM-dd`` text: the partition key of the consolidated table."""
    return F.date_format(F.date_trunc("month", timestamp), "yyyy-MM-dd")


def frequency_rank(frequency: Column) -> Column:
    """1 for the coarsest frequency up to 10 for the finest, null for an unknown one."""
    known = F.array(*[F.lit(name) for name in FREQUENCIES])
    return F.nullif(F.array_position(known, frequency), F.lit(0)).cast("int")
