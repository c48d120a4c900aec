"""Quantile columns and the baseline forecast made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.operators.history import after
from demandlake.operators.running import running_total


def quantile_name(level: str) -> str:
    """``"0.10"`` gives ``p10``; ``mean`` stays."""
    if level == "mean":
        return level
    percent = round(float(level) * 100)
    if not 1 <= percent <= 99:
        raise ValueError(f"quantile {level!r} is outside 0.01 to 0.99")
    return f"p{percent}"


def quantile_aggregates(
    df: DataFrame, keys: Sequence[str], levels: Sequence[str], value: str = "metric"
) -> DataFrame:
    """One column per declared level, exact, per group.

    Meant for bucketed series. Percentiles are kept as (value, count) pairs and merged on
    the map side, so a group costs its distinct values, of which there are at most as many
    as periods.
    """
    return _quantiles(df, keys, levels, value, [])


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], levels: Sequence[str], value: str = "metric"
) -> DataFrame:
    """One column per declared level, exact, per group, where a group may hold all rows.

    As ``quantile_aggregates``, with the same interpolation, but for rows of any number: values are counted before
    the shuffle, the counts are added up over slices in order of value, and the values at the
    positions asked for are picked by an aggregate. No task sees more of a group than a slice, and no
    buffer holds its values. Nulls are left out; a group of nulls has null quantiles.
    """
    keys = list(keys)
    percents = {name: float(level) for level in levels if (name := quantile_name(level)) != "mean"}
    counted = df.groupBy(*keys, value).agg(F.count(value).alias("_n"))
    ordered = running_total(counted, keys, order=value, value="_n").withColumn("_key", F.struct(*keys))
    sums = [F.sum("_n").alias("_all"), F.sum(F.col(value) * F.col("_n")).alias("_sum")]
    totals = counted.groupBy(F.struct(*keys).alias("_key")).agg(*sums)
    up_to, here = F.col("cumulative"), F.col("_n")
    picks = []
    for name, level in percents.items():
        place = F.lit(level) * (F.col("_all") - 1)
        for side, index in (("low", F.floor(place)), ("high", F.ceil(place))):
            held = (up_to - here <= index) & (index < up_to)
            picks.append(F.max(F.when(held, F.col(value))).alias(f"_{side}_{name}"))
    found = ordered.join(totals, "_key").groupBy("_key", "_all", "_sum").agg(*picks)

    def between(name: str) -> Column:
        place, low, high = F.lit(percents[name]) * (F.col("_all") - 1), F.col(f"_low_{name}"), F.col(f"_high_{name}")
        mixed = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        return F.when(F.ceil(place) == F.floor(place), low).otherwise(mixed).cast("double").alias(name)

    average = [F.try_divide("_sum", "_all").cast("double").alias("mean")] if "mean" in levels else []
    named = [F.col(f"_key.`{k}`").alias(k) for k in keys]
    return found.select(*named, *[between(name) for name in percents], *average)


def baseline_forecast(
    df: DataFrame, keys: Sequence[str], frequency: str, length: int, levels: Sequence[str]
) -> DataFrame:
    """The empirical quantiles of each series, repeated over its horizon.

    The end of a series and its quantiles come from one aggregation.
    """
    summary = _quantiles(df, keys, levels, "metric", [F.max("timestamp").alias("timestamp")])
    return after(summary, frequency, length)


def _quantiles(
    df: DataFrame, keys: Sequence[str], levels: Sequence[str], value: str, also: list[Column]
) -> DataFrame:
    percents = {name: float(level) for level in levels if (name := quantile_name(level)) != "mean"}
    found = F.percentile(value, F.array(*[F.lit(q) for q in percents.values()])).alias("_q")
    average = [F.avg(value).alias("mean")] if "mean" in levels else []
    grouped = df.groupBy(*keys).agg(*also, *([found] if percents else []), *average)
    kept = [c for c in grouped.columns if c not in ("_q", "mean")]
    return grouped.select(
        *kept,
        *[F.col("_q")[i].alias(name) for i, name in enumerate(percents)],
        *(["mean"] if average else []),
    )
