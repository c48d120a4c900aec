"""Demand-history and forecast data work on Spark: clean, bucket, consolidate, fill, track, generate."""

from demandlake.session import build_session, work_folder
from demandlake.spec import Attribute, DatasetSpec

__all__ = ["Attribute", "DatasetSpec", "build_session", "work_folder"]
