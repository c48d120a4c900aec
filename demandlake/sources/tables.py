"""The consolidated table: written by month, read with month pruning, queried with SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from demandlake.sources.versions import VersionedTables

PARTITION = "month_starting"


def _laid_out(df: DataFrame, order: tuple[str, ...], widen: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Rows by month and in order, and only then with the columns that ``widen`` adds, so these are neither shuffled nor sorted.

    Of ``order`` the columns that ``widen`` adds are left out, as they are the same in all rows.
    """
    rows = df.hint("rebalance", F.col(PARTITION)).sortWithinPartitions(PARTITION, *[c for c in order if widen is None or c in df.columns])
    return rows if widen is None else widen(rows)


def write_by_month(
    df: DataFrame,
    table: str,
    path: str | None = None,
    order: tuple[str, ...] = ("identifier", "timestamp"),
    widen: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Write a catalog table partitioned by ``month_starting``.

    The rebalance hint lets the runtime split a month that holds most of the data over
    several tasks and merge months that hold little, so neither one task per month nor
    one file per task and month comes out. ``widen`` projects rows to the columns to be written.
    """
    writer = _laid_out(df, order, widen).write.mode("overwrite").format("parquet").partitionBy(PARTITION)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return table


def publish_by_month(
    df: DataFrame,
    table: str,
    path: str,
    order: tuple[str, ...] = ("identifier", "timestamp"),
    widen: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Write a table by month under a run folder of its own, and switch the view ``table`` to it at the end.

    Readers see the run before or this one, never a part: the view is replaced only after all rows have
    been counted in the new files, and a run that fails leaves the view as it was. Files
    of the run that was replaced stay until the next one, for readers that have begun; older ones go.
    """
    spark = df.sparkSession
    store = VersionedTables(spark, path)
    version = store.current() + 1
    sent = Observation()
    counted = df.observe(sent, F.count(F.lit(1)).alias("rows"))
    laid_out = _laid_out(counted, order, widen)
    store.write(laid_out, "months", version, PARTITION)
    stored = spark.read.schema(laid_out.schema).parquet(store.folder("months", version)).count()
    if stored != sent.get["rows"]:
        raise ValueError(f"{stored} rows in {store.folder('months', version)}, {sent.get['rows']} were written")
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in laid_out.schema.fields)
    spark.sql(f"CREATE OR REPLACE VIEW `{table}` AS SELECT {columns} FROM parquet.`{store.folder('months', version)}`")
    store.publish(version)
    if version > 2:
        store.remove(store.folder("months", version - 2))
    return table


def write_months(df: DataFrame, path: str, *extra_partitions: str) -> str:
    """Replace only the month partitions present in ``df``, rebalanced as in ``write_by_month``."""
    (
        df.hint("rebalance", F.col(PARTITION))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION, *extra_partitions)
        .parquet(path)
    )
    return path


def read_range(df: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Rows with ``start <= timestamp <= end``, reading only the months in between.

    The partition key is text derived from the timestamp, which Spark cannot infer a range
    for, so the implied months are stated as a second condition.
    """
    first = F.lit(start).cast("timestamp")
    last = F.lit(end).cast("timestamp")
    month = F.col(PARTITION).cast("string")
    return df.where(
        month.between(
            F.date_format(F.date_trunc("month", first), "yyyy-MM-dd"),
            F.date_format(F.date_trunc("month", last), "yyyy-MM-dd"),
        )
        & F.col("timestamp").between(first, last)
    )


def read_runs(spark: SparkSession, *paths: str) -> DataFrame:
    """Tables of several runs together; columns only some of them have are null in the others."""
    runs = [
        # the partition key looks like a date, and would be read back as one
        spark.read.parquet(path).withColumn(PARTITION, F.col(PARTITION).cast("string"))
        for path in paths
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)


def register(df: DataFrame, name: str) -> str:
    """Make a frame queryable with SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return name
