"""Signatures of files, to tell whether content has changed since it was imported."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.functions.text import dataset_name
from demandlake.operators.manifest import content_signature, content_sums, signature_of_sums


def file_signatures(spark: SparkSession, path: str) -> DataFrame:
    """(path, dataset, size, signature) of every CSV file at or below ``path``.

    Files of any size are split as usual and signed by their lines, whose order does not
    matter. A file without content is not listed, as it is nowhere else.
    """
    lines = (
        spark.read.options(recursiveFileLookup="true", pathGlobFilter="*.csv")
        .text(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), "value")
    )
    signed = content_signature(lines, ["path", "size"])
    return signed.select("path", dataset_name(F.col("path")).alias("dataset"), "size", "signature")


def dataset_signatures(spark: SparkSession, path: str, columns: Sequence[str], key: str) -> DataFrame:
    """(``key``, signature) of the datasets whose lines lie in the CSV files at or below ``path``, in any of them.

    The files have no header. A file costs much more to make and to open than a line, so datasets of
    few lines share files, and a column says whose each line is.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    lines = spark.read.schema(schema).option("recursiveFileLookup", "true").csv(path)
    sums = content_sums(lines, [key], [name for name in columns if name != key])
    return sums.select(key, signature_of_sums().alias("signature"))
