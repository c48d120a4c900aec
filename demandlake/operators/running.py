"""Running totals and ranks, for keys of any size.

Rows are sorted into slices by key and order, so a key that holds all rows is spread over all
slices. What a slice holds of a key is one number there, and those numbers are added up
from slice to slice; only rows of one slice and key are ever walked through together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from demandlake.session import work_folder

# A running row number holds the task in its upper bits and the row of the task in the lower ones. What is above
# these is the slice: a task's rows are cut into slices of so many at most, however few tasks there are.
_ROW_BITS = 19
_PART, _ROW, _TIE = "_part", "_row", "_tie"


def slices(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` sorted into slices: ``_part`` is (slice, keys), ``_row`` the place of a row in its slice.

    Rows that compare alike are told apart by a number of their own, so that even equal rows
    spread. The slices are written to the shared folder: their borders are drawn from a
    sample and must be the same for everything that follows.
    """
    by = [F.col(f"`{k}`").asc() for k in keys] + [*order, F.col(_TIE).asc()]
    placed = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .drop(_TIE)
        .withColumn(_ROW, F.monotonically_increasing_id())
    )
    path = work_folder(df.sparkSession, "slices")
    placed.write.parquet(path)
    stored = df.sparkSession.read.schema(placed.schema).parquet(path)
    # a struct is never null itself, so nulls inside it join, and its one partitioning
    # serves joins and windows
    part = F.struct(F.shiftright(_ROW, _ROW_BITS).alias("slice"), *[F.col(f"`{k}`") for k in keys])
    return stored.withColumn(_PART, part).withColumn(_ROW, F.col(_ROW).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))


def _dealt(sliced: DataFrame) -> DataFrame:
    """``sliced`` dealt out by slice and key, to more tasks than usual where these would hold many slices each."""
    tasks = -(-sliced.count() // (1 << _ROW_BITS))
    usual = int(sliced.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sliced.repartition(tasks, _PART) if tasks > usual else sliced


def _earlier(keys: Sequence[str]) -> WindowSpec:
    """For one row per slice and key: the slices before this one that hold rows of the key."""
    own = Window.partitionBy(*[F.col(f"{_PART}.`{k}`") for k in keys]).orderBy(f"{_PART}.slice")
    return own.rowsBetween(Window.unboundedPreceding, -1)


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column], position: str = "position") -> DataFrame:
    """``df`` with the number of each row inside its key, from 1, in the given order.

    The order of rows that compare alike is left open; null keys are a key.
    """
    keys = list(keys)
    sliced = slices(df, keys, order)
    counted = sliced.groupBy(_PART).agg(F.min(_ROW).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(_earlier(keys)), F.lit(0))
    shifted = counted.select(_PART, (before - F.col("_first") + 1).alias("_shift"))
    return _dealt(sliced).join(shifted, _PART).select(*_all(df), (F.col(_ROW) + F.col("_shift")).alias(position))


def running_total(
    df: DataFrame, keys: Sequence[str], order: str = "timestamp", value: str = "metric"
) -> DataFrame:
    """Cumulative ``value`` per series, for frames with one row per series and period.

    Nulls add nothing, and the total is null as long as there was nothing else.
    """
    keys = list(keys)
    sliced = slices(df, keys, [F.col(f"`{order}`").asc()])
    sums = sliced.groupBy(_PART).agg(F.sum(value).alias("_sum"))
    before = sums.select(_PART, F.sum("_sum").over(_earlier(keys)).alias("_before"))
    within = Window.partitionBy(_PART).orderBy(_ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.sum(value).over(within)
    zero = F.lit(0)
    total = F.coalesce(F.coalesce("_before", zero) + here, "_before")
    return _dealt(sliced).join(before, _PART).withColumn("cumulative", total).select(*_all(df), "cumulative")


def rank_newest_first(
    df: DataFrame, keys: Sequence[str], moment: str, tie: str, rank: str = "position"
) -> DataFrame:
    """1 for the newest row of each key, without sorting a whole key in one task."""
    return positions(df, keys, [F.col(f"`{moment}`").desc(), F.col(f"`{tie}`").desc()], rank)


def _all(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]
