"""Newly arrived dataset files: clean, append, rebuild the buckets they touch.

A watermark would drop history that arrives late, which a full re-read would include.
So raw rows are kept, and a batch rebuilds every month it has rows for from all raw rows of
that month. Bucketed months never share a bucket: a bucket belongs to the month it
starts in, and raw rows are stored by the month of their bucket. Related series and item
metadata are replaced by their newest batch. A file that is written again under its old
name is not read again: the file source knows files by name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from demandlake.functions.calendar import bucket_start, month_starting
from demandlake.functions.text import dataset_type, delivered_file, file_prefix
from demandlake.operators.bucket import bucket
from demandlake.operators.clean import clean_input
from demandlake.sources.tables import PARTITION, write_months
from demandlake.spec import TARGET_TIME_SERIES, DatasetSpec


@dataclass(frozen=True)
class SideTable:
    """Where cleaned rows of related series or item metadata are kept, and what they look like."""

    spec: DatasetSpec
    path: str


def arrivals(
    spark: SparkSession, folder: str, specs: Sequence[DatasetSpec], group: str | None = None
) -> DataFrame:
    """Lines of CSV files as they arrive, as text, with the type their file name gives them.

    Lines are read with as many columns as the widest dataset has. With a ``group``, only
    files of that dataset group are taken, whose names begin with it up to the first dot.
    """
    widest = max(specs, key=lambda spec: len(spec.attributes))
    delivered = delivered_file(F.col("_metadata.file_path"))
    own = F.lit(True) if group is None else file_prefix(delivered) == group
    return (
        spark.readStream.schema(widest.text_struct)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .csv(folder)
        .withColumn("_type", dataset_type(delivered))
        .where(own)
    )


def without_header(lines: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Lines but those that hold the dataset's field names, each in any place, and nothing else."""
    columns = [F.col(name) for name in spec.text_struct.fieldNames()]
    names = F.sort_array(F.array(*columns)) == F.sort_array(F.array(*[F.lit(f) for f in spec.fields]))
    # one column tells nearly all lines apart, so fields are sorted for hardly any
    return lines.where(~F.coalesce(columns[0].isin(*spec.fields) & names, F.lit(False)))


def rebuild_batch(
    raw_path: str,
    bucket_path: str,
    spec: DatasetSpec,
    frequency: str,
    dimensions: Sequence[str],
    sides: Mapping[str, SideTable] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The work for one batch of arrived lines; doing it twice gives the same tables.

    Raw rows land in a partition named after the batch and each rebuilt month replaces
    what was there, so a batch that is retried after a lost driver overwrites itself.
    """

    def cleaned_of(batch: DataFrame, kind: str, kind_spec: DatasetSpec) -> DataFrame:
        lines = batch.where(F.col("_type") == kind).drop("_type")
        return clean_input(without_header(lines, kind_spec), kind_spec)

    def process(batch: DataFrame, batch_id: int) -> None:
        cleaned = cleaned_of(batch, TARGET_TIME_SERIES, spec).withColumn(
            PARTITION, month_starting(bucket_start("timestamp", frequency))
        )
        write_months(cleaned.withColumn("batch", F.lit(batch_id)), raw_path, "batch")

        stored = batch.sparkSession.read.schema(
            T.StructType([*cleaned.schema.fields, T.StructField("batch", T.LongType())])
        ).parquet(raw_path)
        # at most one value per calendar month; as literals they prune the partitions read
        touched = stored.where(F.col("batch") == batch_id).select(PARTITION).distinct().collect()
        if touched:
            months = stored.where(F.col(PARTITION).isin([row[0] for row in touched]))
            rebuilt = bucket(months, frequency, dimensions)
            write_months(rebuilt.withColumn(PARTITION, month_starting("timestamp")), bucket_path)

        for kind, side in (sides or {}).items():
            if batch.where(F.col("_type") == kind).take(1):
                newest = cleaned_of(batch, kind, side.spec).withColumn("batch", F.lit(batch_id))
                newest.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(side.path)

    return process


def start_ingest(
    spark: SparkSession,
    folder: str,
    raw_path: str,
    bucket_path: str,
    checkpoint: str,
    spec: DatasetSpec,
    frequency: str,
    dimensions: Sequence[str] = (),
    sides: Mapping[str, SideTable] | None = None,
    group: str | None = None,
) -> StreamingQuery:
    """Process everything that has arrived since the last run, then stop.

    ``sides`` says, per dataset type, where related series and item metadata go; types
    that are not named there are passed over, and so are files of groups other than ``group``.
    """
    specs = [spec, *[side.spec for side in (sides or {}).values()]]
    return (
        arrivals(spark, folder, specs, group)
        .writeStream.foreachBatch(
            rebuild_batch(raw_path, bucket_path, spec, frequency, dimensions, sides)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
