"""Frames for charts: date range, quantile bands, the bridge from history to forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.operators.consolidate import quantile_columns


def date_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows from ``start`` to ``end``, both included."""
    return df.where(
        F.col(column).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    )


def quantile_bands(df: DataFrame, keys: Sequence[str], centre: str = "p50") -> DataFrame:
    """One row per key, quantile other than the centre, with the centre beside it."""
    bands = [q for q in quantile_columns(df.columns) if q != centre]
    return df.unpivot([*keys, centre], bands, "quantile", "value")


def forecast_bridge(
    history: DataFrame, forecast: DataFrame, keys: Sequence[str] = ("identifier",), centre: str = "p50"
) -> DataFrame:
    """Per series: its last actual point and its first forecast point."""
    keys = list(keys)
    last = history.groupBy(*keys).agg(
        F.max("timestamp").alias("last_timestamp"),
        F.max_by("metric", "timestamp").alias("last_metric"),
    )
    first = forecast.groupBy(*keys).agg(
        F.min("timestamp").alias("first_timestamp"),
        F.min_by(centre, "timestamp").alias("first_value"),
    )
    return last.join(first, keys)
