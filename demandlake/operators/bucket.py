"""Summing observations into time buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.functions.calendar import bucket_start

AGGREGATIONS = {"sum": F.sum}


def bucket(
    df: DataFrame, frequency: str, dimensions: Sequence[str] = (), aggregation: str = "sum"
) -> DataFrame:
    """One row per identifier, listed dimension values and bucket.

    Dimensions that are not listed are summed out. The aggregate combines on the map side
    first, so an identifier with most of the rows sends at most one row per bucket and
    task through the shuffle. A bucket of nulls stays null.
    """
    keys = ["identifier", *dimensions]
    combine = AGGREGATIONS[aggregation]
    return (
        df.select(*keys, bucket_start("timestamp", frequency).alias("timestamp"), "metric")
        .groupBy(*keys, "timestamp")
        .agg(combine("metric").alias("metric"))
    )
