"""The consolidation job: from run records and files to the written table."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.operators.bucket import bucket
from demandlake.operators.clean import clean_export, clean_input, map_export
from demandlake.operators.consolidate import consolidate, to_wide
from demandlake.operators.manifest import newest
from demandlake.functions.text import is_active
from demandlake.sources.csv import first_existing, read_dataset, read_export
from demandlake.sources.names import data_path
from demandlake.sources.tables import publish_by_month, write_by_month
from demandlake.spec import DatasetSpec


@dataclass(frozen=True)
class GroupSources:
    """Where the data of one dataset group lies, and the settings of its predictor if they are recorded."""

    target: str
    backtest: str
    forecast: str
    metadata: str | None = None
    frequency: str | None = None
    dimensions: tuple[str, ...] = ()


def resolve_sources(
    runs: DataFrame,
    group: str,
    target_dataset: str,
    metadata_dataset: str | None = None,
    same_predictor: bool = False,
) -> GroupSources:
    """Locations of the newest active runs of a group, found in one job.

    ``runs`` has ``kind, run, parent, predictor, status, created, source_path,
    destination_path``; the parent of imports is their dataset, of predictors and
    forecasts the group, of exports the predictor or forecast. A column ``settings`` may hold what a
    predictor was told, as JSON. The newest forecast and the newest predictor are chosen
    independently unless ``same_predictor`` asks for a forecast of that predictor.
    """
    active = runs.where(is_active(F.col("status")))
    kind, parent = F.col("kind"), F.col("parent")
    datasets = [d for d in (target_dataset, metadata_dataset) if d]
    made = active.where(kind.isin("predictor", "forecast") & (parent == group))
    imported = active.where((kind == "import") & parent.isin(*datasets))
    exported = active.where(kind.isin("backtest_export", "forecast_export")).join(
        made.select(F.col("run").alias("parent")).distinct(), "parent", "left_semi"
    )
    own = made.unionByName(imported).unionByName(exported)
    # one row per dataset, per predictor with forecasts, and per export of these
    last = newest(own, ["kind", "parent", "predictor"], "created", "run").withColumn(
        "path", data_path(kind, F.col("destination_path"), F.col("source_path"))
    )
    found = last.collect()

    def latest(wanted: str, parent: str, predictor: str | None = None) -> dict:
        rows = [r for r in found if (r["kind"], r["parent"]) == (wanted, parent) and predictor in (None, r["predictor"])]
        if not rows:
            raise ValueError(f"no active {wanted.replace('_', ' ')} for {parent!r}")
        return max(rows, key=lambda r: (r["created"], r["run"])).asDict()

    predictor = latest("predictor", group)
    forecast = latest("forecast", group, predictor["run"] if same_predictor else None)
    frequency, dimensions = None, []
    if predictor.get("settings"):
        frequency, dimensions = forecast_settings(json.loads(predictor["settings"]))
    return GroupSources(
        target=latest("import", target_dataset)["path"],
        metadata=latest("import", metadata_dataset)["path"] if metadata_dataset else None,
        backtest=latest("backtest_export", predictor["run"])["path"],
        forecast=latest("forecast_export", forecast["run"])["path"],
        frequency=frequency,
        dimensions=tuple(dimensions),
    )


def forecast_settings(predictor: Mapping) -> tuple[str, list[str]]:
    """(frequency, dimensions) of a predictor, kept in a nested or in a flat form."""
    holder = predictor.get("FeaturizationConfig") or predictor
    return holder["ForecastFrequency"], list(holder.get("ForecastDimensions") or [])


def at_hand(spark: SparkSession, sources: GroupSources, cache: str) -> GroupSources:
    """``sources`` with those places replaced that have a copy under ``cache``, named by what they are."""
    held = {"target": sources.target, "backtest": sources.backtest, "forecast": sources.forecast}
    if sources.metadata:
        held["metadata"] = sources.metadata
    return replace(sources, **{name: first_existing(spark, f"{cache}/{name}", path) for name, path in held.items()})


def consolidated(
    spark: SparkSession,
    sources: GroupSources,
    target_spec: DatasetSpec,
    frequency: str | None = None,
    dimensions: Sequence[str] | None = None,
    metadata_spec: DatasetSpec | None = None,
    wide: bool = True,
) -> DataFrame:
    """The consolidated frame of one group; lazy, apart from looking at headers.

    Frequency and dimensions are those of the sources' predictor where they are not given. Without ``wide``
    there are only the columns that are there.
    """
    frequency, dimensions = _settings(sources, frequency, dimensions)
    history = bucket(
        clean_input(read_dataset(spark, sources.target, target_spec), target_spec), frequency, dimensions
    )
    raw_backtest = read_export(spark, sources.backtest)
    backtest = clean_export(raw_backtest, target_spec, backtest=True)
    forecast = clean_export(read_export(spark, sources.forecast), target_spec, backtest=False)
    metadata = None
    if sources.metadata and metadata_spec:
        metadata = clean_input(read_dataset(spark, sources.metadata, metadata_spec), metadata_spec)
    return consolidate(
        history,
        backtest,
        forecast,
        target_spec,
        metadata,
        metadata_spec,
        backtest_rows=map_export(raw_backtest, target_spec, backtest=True),
        wide=wide,
    )


def _settings(sources: GroupSources, frequency: str | None, dimensions: Sequence[str] | None) -> tuple[str, Sequence[str]]:
    frequency = frequency or sources.frequency
    if frequency is None:
        raise ValueError("no frequency given, and none recorded for the predictor")
    return frequency, sources.dimensions if dimensions is None else dimensions


def run_consolidation(
    spark: SparkSession,
    sources: GroupSources,
    target_spec: DatasetSpec,
    frequency: str | None = None,
    table: str = "consolidated",
    dimensions: Sequence[str] | None = None,
    metadata_spec: DatasetSpec | None = None,
    path: str | None = None,
    cache: str | None = None,
    publish: bool = False,
) -> str:
    """Consolidate one group and write it by month, as a catalog table.

    With ``publish``, a view over a folder of this run under ``path`` is switched to it at the end instead.
    Copies under ``cache`` are read in place of the originals.
    """
    sources = at_hand(spark, sources, cache) if cache else sources
    frequency, dimensions = _settings(sources, frequency, dimensions)
    rows = consolidated(spark, sources, target_spec, frequency, dimensions, metadata_spec, wide=False)
    order = ("identifier", *(f"dimension_{i}" for i in range(1, len(dimensions) + 1)), "timestamp")
    if publish:
        if not path:
            raise ValueError("a published table needs a path")
        return publish_by_month(rows, table, path, order, to_wide)
    return write_by_month(rows, table, path, order, to_wide)
