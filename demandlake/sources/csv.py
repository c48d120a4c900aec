"""CSV datasets and exports, always read as text; typing happens in ``operators.clean``."""

from __future__ import annotations

import csv as text_csv
from collections import Counter
from collections.abc import Mapping, Sequence
from contextlib import suppress

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.spec import DatasetSpec

SAMPLE_LINES = 100


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, modified) of every non-empty CSV file at or below ``path``; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(path)
        .where(F.col("length") > 0)
        .select(
            F.col("path"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
        )
    )


def first_nonempty(spark: SparkSession, path: str) -> str:
    """The first CSV file below ``path`` that has content."""
    found = list_files(spark, path).agg(F.min("path")).first()[0]
    if found is None:
        raise ValueError(f"no export data at {path}")
    return found


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first of several locations that is there: a copy at hand, then the original."""
    for path in paths:
        try:
            spark.read.format("binaryFile").load(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            return path
    raise ValueError(f"none of these exists: {', '.join(paths)}")


def has_header(spark: SparkSession, path: str, fields: Sequence[str]) -> bool:
    """Whether CSV data starts with a header line, judged on its first lines only."""
    if not path.endswith(".csv"):
        path = first_nonempty(spark, path)
    sample = [row.value for row in spark.read.text(path).limit(SAMPLE_LINES).collect() if row.value]
    return looks_like_header(sample, fields)


def looks_like_header(sample: Sequence[str], fields: Sequence[str]) -> bool:
    """Whether the first of some lines names the fields.

    It does if it holds each name once and nothing else, and doesn't if it holds none. A
    line that holds some of them is compared with the lines below it by the sniffer; where
    that finds no common delimiter, the line counts as data, and cleaning drops it if it is none.
    """
    names = Counter(sample[0].split(",")) if sample else Counter()
    shared = names & Counter(fields)
    if not shared:
        return False
    if shared == names and names.total() == len(fields):
        return True
    with suppress(text_csv.Error):
        return text_csv.Sniffer().has_header("\n".join([*sample, ""]))
    return False


def read_dataset(
    spark: SparkSession, path: str, spec: DatasetSpec, header: bool | None = None
) -> DataFrame:
    """An input dataset with one text column per declared attribute, by position.

    Lines with too many fields lose the rest, short lines are filled with nulls.
    ``header=None`` looks at the data to decide.
    """
    if header is None:
        header = has_header(spark, path, spec.fields)
    return spark.read.schema(spec.text_struct).option("header", header).csv(path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """An export, whose columns are named by its header line; every column is text.

    A part file with other columns, or the same in another order, fails the read.
    """
    options = {"header": "true", "enforceSchema": "false", "recursiveFileLookup": "true"}
    return spark.read.options(**options).csv(path)


def read_exports(
    spark: SparkSession, paths: Mapping[str, str], columns: Sequence[str]
) -> DataFrame:
    """Several exports side by side, each row tagged with its export's name."""
    if not paths:
        raise ValueError("no exports given")
    tagged = [
        read_export(spark, path).select(F.lit(name).alias("export"), *columns)
        for name, path in paths.items()
    ]
    combined = tagged[0]
    for frame in tagged[1:]:
        combined = combined.unionByName(frame)
    return combined


def write_csv(df: DataFrame, path: str, header: bool = False) -> str:
    df.write.mode("overwrite").option("header", header).csv(path)
    return path
