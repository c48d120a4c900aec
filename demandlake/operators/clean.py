"""From text columns to typed, renamed, complete rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.functions.text import is_input_timestamp
from demandlake.spec import DatasetSpec

BACKTEST_WINDOW_FIELDS = ("backtestwindow_start_time", "backtestwindow_end_time")
_QUANTILE = re.compile(r"^[pP]([1-9]\d?)$")


def quantile_field(name: str) -> str | None:
    """Canonical name of a quantile or mean column (``P50`` gives ``p50``), else None."""
    if name == "mean":
        return name
    match = _QUANTILE.match(name)
    return f"p{match.group(1)}" if match else None


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that have no type because they hold nothing but nulls."""
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)])


def filter_timestamps(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Keep rows whose timestamp text has an accepted shape; datasets without one pass through."""
    if "timestamp" not in spec.fields:
        return df
    column = df.columns[spec.fields.index("timestamp")]
    return df.where(is_input_timestamp(F.col(column)))


def cast_to_spec(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Column *i* becomes attribute *i* with its type; unparseable values become null."""
    return df.select(
        *[
            F.col(df.columns[i]).try_cast(a.data_type).alias(a.name)
            for i, a in enumerate(spec.attributes)
        ]
    )


def require_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``fields``."""
    if not fields:
        return df
    return df.where(reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in fields]))


def normalize_names(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The domain's identifier and target become ``identifier`` and ``metric``."""
    return df.withColumnsRenamed({spec.identifier: "identifier", spec.target: "metric"})


def clean_input(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """All steps for an input dataset, as one projection and one filter over the scan.

    Only the target may be null: a missing observation is legitimate, a row without
    identifier, timestamp or attribute is not.
    """
    typed = cast_to_spec(filter_timestamps(drop_null_columns(raw), spec), spec)
    complete = require_fields(typed, [f for f in spec.fields if f != spec.target])
    return normalize_names(complete, spec)


def map_export(raw: DataFrame, spec: DatasetSpec, backtest: bool) -> DataFrame:
    """Type and rename an export's columns by name; what is not recognised stays text."""
    picked = {}
    for name in raw.columns:
        if name == spec.identifier:
            target, kind = "identifier", "string"
        elif name in ("timestamp", "date"):
            target, kind = "timestamp", "timestamp"
        elif backtest and name in (spec.target, "target_value"):
            target, kind = "metric", "double"
        elif quantile_field(name):
            target, kind = quantile_field(name), "double"
        elif backtest and name in BACKTEST_WINDOW_FIELDS:
            continue
        else:
            target, kind = name, "string"
        if target in picked:
            raise ValueError(f"two export columns map to {target!r}: {raw.columns}")
        picked[target] = F.col(f"`{name}`").try_cast(kind).alias(target)
    return raw.select(*picked.values())


def clean_export(raw: DataFrame, spec: DatasetSpec, backtest: bool) -> DataFrame:
    """Whole-row duplicates go, compared as text, before anything is typed."""
    return map_export(raw.distinct(), spec, backtest)
