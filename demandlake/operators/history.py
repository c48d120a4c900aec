"""Declared treatments of a bucketed history: gap filling, horizon, backtest windows, time zone.

All functions take bucketed frames: at most one row per series and period. That bounds a
series by its calendar, however many observations were summed into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from demandlake.functions.calendar import add_periods, periods_between
from demandlake.functions.text import latitude, longitude

FILLS = ("zero", "none", "median", "max")
# Long runs of periods are exploded in pieces, so no row carries an array longer than this.
_PIECE = 4096


def fill_gaps(
    df: DataFrame,
    keys: Sequence[str],
    frequency: str,
    middle: str = "none",
    front: str | None = None,
    back: str | None = None,
    future: str | None = None,
    horizon: int = 0,
    extent: DataFrame | None = None,
) -> DataFrame:
    """Give every series a row for every period.

    ``middle`` covers gaps between a series' first and last point, ``front`` the time from
    the earliest point of any series to its first, ``back`` from its last to the latest of
    any series, ``future`` the ``horizon`` periods after that. Each is ``zero``,
    ``median`` or ``max`` of the series' own values, ``none`` for a null, or left out for
    no rows at all. Missing values inside the history are filled like middle gaps.

    A row carries the gap up to its successor and is exploded into it, so the history is
    never joined to a calendar. The first and last period of all series come from ``extent``,
    a frame with the same extremes in ``timestamp``: rows before they were bucketed give
    them without grouping the history again. Left out, they come from ``df``.
    """
    extent = df if extent is None else extent
    for fill in (middle, front, back, future):
        if fill is not None and fill not in FILLS:
            raise ValueError(f"unknown fill {fill!r}, expected one of {', '.join(FILLS)}")
    keys = list(keys)
    ordered = Window.partitionBy(*keys).orderBy("timestamp")
    whole = Window.partitionBy(*keys)
    used = {middle, front, back, future}

    columns = {"_next": F.lead("timestamp").over(ordered)}
    if front:
        columns["_previous"] = F.lag("timestamp").over(ordered)
        columns["_earliest"] = extent.select(F.min("timestamp")).scalar()
    if back or future:
        columns["_latest"] = extent.select(F.max("timestamp")).scalar()
    if "median" in used:
        columns["_median"] = F.percentile("metric", F.lit(0.5)).over(whole)
    if "max" in used:
        columns["_max"] = F.max("metric").over(whole)

    def value(fill: str) -> Column:
        return {
            "zero": F.lit(0.0),
            "none": F.lit(None).cast("double"),
            "median": F.col("_median") if "_median" in columns else None,
            "max": F.col("_max") if "_max" in columns else None,
        }[fill]

    def segment(name: str, start: Column, count: Column, metric: Column) -> Column:
        return F.struct(
            F.lit(name).alias("segment"),
            start.alias("start"),
            count.cast("int").alias("count"),
            metric.cast("double").alias("metric"),
        )

    ts, following = F.col("timestamp"), F.col("_next")
    pieces = [
        segment("history", ts, F.lit(1), F.coalesce(F.col("metric"), value(middle))),
        segment(
            "middle",
            add_periods(ts, frequency, 1),
            F.coalesce(periods_between(ts, following, frequency) - 1, F.lit(0)),
            value(middle),
        ),
    ]
    if front:
        earliest = F.col("_earliest")
        count = F.when(F.col("_previous").isNull(), periods_between(earliest, ts, frequency))
        pieces.append(segment("front", earliest, F.coalesce(count, F.lit(0)), value(front)))
    if back or future:
        latest = F.col("_latest")
        is_last = following.isNull()
        if back:
            count = F.when(is_last, periods_between(ts, latest, frequency))
            pieces.append(
                segment("back", add_periods(ts, frequency, 1), F.coalesce(count, F.lit(0)), value(back))
            )
        if future:
            count = F.when(is_last, F.lit(horizon))
            pieces.append(
                segment(
                    "future", add_periods(latest, frequency, 1), F.coalesce(count, F.lit(0)), value(future)
                )
            )

    segments = (
        df.select(*keys, "timestamp", "metric", *[c.alias(n) for n, c in columns.items()])
        # outer: the array is never empty, and Spark need not build it twice to find out
        .select(*keys, F.explode_outer(F.array(*pieces)).alias("_s"))
        .select(*keys, "_s.*")
        .where(F.col("count") > 0)
    )
    return explode_periods(segments, "start", "count", frequency).select(
        *keys, "timestamp", "metric", "segment"
    )


def explode_periods(
    df: DataFrame, start: str, count: str, frequency: str, step: str = "step"
) -> DataFrame:
    """``count`` rows per input row: ``step`` from 0, ``timestamp`` running from ``start``."""
    pieces = df.select(
        "*", F.explode_outer(F.sequence(F.lit(0), F.col(count) - 1, F.lit(_PIECE))).alias("_from")
    )
    last = F.least(F.col("_from") + _PIECE, F.col(count)) - 1
    steps = pieces.select("*", F.explode_outer(F.sequence("_from", last)).alias(step)).drop("_from")
    return steps.withColumn("timestamp", add_periods(F.col(start), frequency, F.col(step)))


def horizon(df: DataFrame, keys: Sequence[str], frequency: str, length: int) -> DataFrame:
    """The ``length`` periods after each series' last point."""
    return after(df.groupBy(*keys).agg(F.max("timestamp").alias("timestamp")), frequency, length)


def after(df: DataFrame, frequency: str, length: int) -> DataFrame:
    """Each row once for every one of the ``length`` periods after its timestamp."""
    steps = df.select("*", F.explode_outer(F.sequence(F.lit(1), F.lit(length))).alias("step"))
    return steps.withColumn("timestamp", add_periods(F.col("timestamp"), frequency, F.col("step")))


def backtest_split(
    df: DataFrame,
    frequency: str,
    length: int,
    windows: int = 1,
    offset: int | None = None,
    extent: DataFrame | None = None,
) -> DataFrame:
    """Tag rows as train or test, once per backtest window.

    Window 1 splits ``offset`` periods before the end of the data (``length`` when not
    given), each further window ``length`` periods earlier. Rows before the split train,
    the ``length`` periods from it test, later rows are in neither part. ``extent`` is a
    frame with the same latest ``timestamp``, as for ``fill_gaps``.
    """
    offset = length if offset is None else offset
    if offset < length:
        raise ValueError("the offset must be at least the horizon")
    latest = (df if extent is None else extent).select(F.max("timestamp")).scalar()
    back = (F.lit(1 - offset) - (F.col("window") - 1) * F.lit(length)).cast("int")
    tagged = df.select("*", F.explode_outer(F.sequence(F.lit(1), F.lit(windows))).alias("window")).withColumn(
        "_split", add_periods(latest, frequency, back)
    )
    return (
        tagged.where(F.col("timestamp") < add_periods(F.col("_split"), frequency, length))
        .withColumn("part", F.when(F.col("timestamp") < F.col("_split"), "train").otherwise("test"))
        .drop("_split")
    )


def to_utc(df: DataFrame, column: str, time_zone: Column | str) -> DataFrame:
    """Local wall time in ``time_zone`` as UTC."""
    return df.withColumn(column, F.to_utc_timestamp(F.col(column), time_zone))


def split_geolocation(df: DataFrame, column: str) -> DataFrame:
    """``latitude_longitude`` text as two numbers, null when malformed or out of range."""
    return df.withColumns(
        {"latitude": latitude(F.col(column)), "longitude": longitude(F.col(column))}
    )
