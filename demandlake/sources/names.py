"""Names and locations derived from run records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = "yyyy_MM_dd_HH_mm_ss"


def stamp(moment: Column) -> Column:
    return F.date_format(moment, STAMP)


def import_name(dataset: Column, file_modified: Column) -> Column:
    return F.concat_ws("_", dataset, stamp(file_modified))


def predictor_name(group: Column, dataset_modified: Column, automatic: Column) -> Column:
    return F.concat_ws("_", group, F.when(automatic, "auto"), stamp(dataset_modified))


def backtest_export_name(group: Column, predictor_created: Column, automatic: Column) -> Column:
    return F.concat_ws("_", F.lit("export"), group, F.when(automatic, "auto"), stamp(predictor_created))


def forecast_name(group: Column, dataset_modified: Column, automatic: Column) -> Column:
    return F.concat_ws("_", F.lit("forecast"), F.when(automatic, "ap"), group, stamp(dataset_modified))


def forecast_export_name(group: Column, dataset_modified: Column, automatic: Column) -> Column:
    return F.concat_ws("_", F.lit("export"), F.when(automatic, "ap"), group, stamp(dataset_modified))


def table_name(group: str, now: datetime) -> str:
    """Name of the consolidated table written by a run started at ``now``."""
    return f"{group}_{now:%Y_%m_%d_%H_%M_%S}"


def data_path(kind: Column, destination: Column, source: Column) -> Column:
    """Where a run's data lies: an export's destination or an import's source.

    Backtest exports keep their rows in a folder of their own.
    """
    base = F.coalesce(destination, source)
    return F.when(kind == "backtest_export", F.concat(base, F.lit("/forecasted-values"))).otherwise(base)
