"""History, backtest and forecast in one wide frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.functions.calendar import month_starting
from demandlake.operators.attributes import GenericNames, drop_metadata
from demandlake.operators.clean import quantile_field
from demandlake.spec import DatasetSpec

DIMENSION_SLOTS = 10
METADATA_SLOTS = 10


def wide_schema() -> T.StructType:
    """The fixed columns of the consolidated table, without the partition column."""
    text, number = T.StringType(), T.DoubleType()
    fields = [("timestamp", T.TimestampType()), ("identifier", text), ("metric", number)]
    fields += [(f"p{n}", number) for n in range(1, 100)]
    fields += [("mean", number)]
    fields += [(f"dimension_{n}", text) for n in range(1, DIMENSION_SLOTS + 1)]
    fields += [(f"metadata_{n}", text) for n in range(1, METADATA_SLOTS + 1)]
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def union_frames(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag union by name: left's columns, then right's others, null where a side has none."""
    if left is None or right is None:
        raise ValueError("both frames of a union are required")
    return left.unionByName(right, allowMissingColumns=True)


def to_wide(df: DataFrame) -> DataFrame:
    """Project to the fixed columns, typed nulls where absent; unknown columns follow in order."""
    schema = wide_schema()
    known = set(schema.fieldNames())
    fixed = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*fixed, *[c for c in df.columns if c not in known])


def cut_history(history: DataFrame, backtest: DataFrame) -> DataFrame:
    """History before the earliest backtest timestamp; all of it when there is no backtest.

    The cutoff is a scalar subquery, computed inside the same job. As a plain comparison
    with the bucket it is also applied below the bucketing, before the shuffle.
    """
    latest_possible = F.timestamp_micros(F.lit(2**63 - 1))
    cutoff = backtest.select(F.coalesce(F.min("timestamp"), latest_possible)).scalar()
    return history.where(F.col("timestamp") < cutoff)


def join_metadata(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join on the identifier. Two metadata rows for one identifier double its rows."""
    return df.join(metadata, "identifier", "left")


def duplicate_identifiers(metadata: DataFrame) -> DataFrame:
    """Identifiers that would fan out in ``join_metadata``."""
    return (
        metadata.groupBy("identifier")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def consolidate(
    history: DataFrame,
    backtest: DataFrame,
    forecast: DataFrame,
    target_spec: DatasetSpec,
    metadata: DataFrame | None = None,
    metadata_spec: DatasetSpec | None = None,
    backtest_rows: DataFrame | None = None,
    wide: bool = True,
) -> DataFrame:
    """The consolidated table: bucketed history up to the backtest, backtest, forecast, metadata.

    Generic numbers are given in the order history, forecast, backtest, metadata. The
    cutoff of the history comes from ``backtest_rows`` if given: the backtest before its
    duplicates went, whose earliest timestamp is the same and takes no shuffle to find.
    Without ``wide`` there are only the columns that any frame has, for ``to_wide`` to be applied later.
    """
    names = GenericNames.for_spec(target_spec, metadata_spec)
    for frame in (history, forecast, backtest):
        names = names.discover(frame.columns)

    def generic(frame: DataFrame) -> DataFrame:
        return drop_metadata(frame.withColumnsRenamed(names.renames(frame.columns)))

    history, forecast, backtest = generic(history), generic(forecast), generic(backtest)
    cutoff = backtest if backtest_rows is None else backtest_rows
    combined = union_frames(cut_history(history, cutoff), backtest)
    combined = union_frames(combined, forecast)
    if metadata is not None:
        names = names.discover_metadata(metadata.columns)
        combined = join_metadata(
            combined, metadata.withColumnsRenamed(names.metadata_renames(metadata.columns))
        )
    return (to_wide(combined) if wide else combined).withColumn("month_starting", month_starting("timestamp"))


def quantile_columns(columns: list[str]) -> list[str]:
    """The quantile columns of a frame (``p1`` to ``p99``), without ``mean``."""
    return [c for c in columns if c != "mean" and quantile_field(c)]
