"""Registered queries: a DataFrame over the given tables and, where there is one, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its timestamps come out without a zone, as the SQL side has them."""

    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_timestamps(build(use_utc(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def plain_timestamps(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
