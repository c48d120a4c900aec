"""Helpers shared by the text operators: written intermediates and keys for samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.session import work_folder

Batches = Iterator[pa.RecordBatch]


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored in the shared folder and read from there.

    What follows neither repeats the work nor depends on the executors that did it.
    """
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_of(key: Column) -> Column:
    """CRC-32 of a key written as text; null for a null key."""
    return F.crc32(key.cast("string").cast("binary"))


def draw(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends on the key and the salt alone."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def in_batches(df: DataFrame, run: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``df.mapInArrow``, with workers that find this library where the driver has it, if not by themselves."""
    here = str(Path(__file__).resolve().parents[2])
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", here)
    return df.mapInArrow(run, schema)


def per_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply a function to each Arrow batch; ``make`` runs once in each task and sets the function up."""

    def run(batches: Batches) -> Batches:
        apply = make()
        for batch in batches:
            if batch.num_rows:
                yield apply(batch)

    return in_batches(df, run, schema)
