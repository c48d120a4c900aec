"""What is known of datasets and runs, kept up to date by each batch of arrivals, and the decisions read from it.

Rows are known by keys; a batch of changes puts the newest row of each key in place. A dataset that was
taken in is an import of that content; runs of predictors and forecasts are recorded
as they happen. Whether a group is ready, has to be trained again, or has a stale forecast is then a
question to these tables alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.functions.text import is_active
from demandlake.operators.manifest import (
    DEFAULT_MAX_AGE,
    forecast_stale,
    newest,
    readiness,
    retrain_needed,
    with_default_types,
)
from demandlake.sources.names import import_name
from demandlake.sources.versions import VersionedTables
from demandlake.spec import ITEM_METADATA, RELATED_TIME_SERIES
from demandlake.streaming.deliveries import Intake, current_datasets

DATASETS = "dataset string, group string, dataset_type string, status string, modified timestamp"
RUNS = (
    "kind string, run string, parent string, group string, predictor string, status string, "
    "created timestamp, modified timestamp, signature string"
)
_MISSING = "MISSING"


def upsert(stored: DataFrame, changes: DataFrame, keys: Sequence[str], moment: str = "modified") -> DataFrame:
    """``stored`` with the newest row of each key; of two from the same moment, the changed one stays.

    The newest is an aggregate that combines before the shuffle, so a key that changes very often
    sends one row per task.
    """
    both = stored.withColumn("_turn", F.lit(0)).unionByName(changes.select(*stored.columns).withColumn("_turn", F.lit(1)))
    return newest(both, keys, moment, "_turn").select(*stored.columns)


def dataset_of(group: Column, kind: Column) -> Column:
    """Name of a group's dataset of a type."""
    suffix = F.when(kind == RELATED_TIME_SERIES, "_related").when(kind == ITEM_METADATA, "_metadata").otherwise("")
    return F.concat(group, suffix)


@dataclass(frozen=True)
class RunState:
    """The two tables, under ``path``."""

    spark: SparkSession
    path: str

    @property
    def _tables(self) -> VersionedTables:
        return VersionedTables(self.spark, self.path)

    def datasets(self) -> DataFrame:
        return self._tables.read("datasets", self._tables.current(), DATASETS)

    def runs(self) -> DataFrame:
        return self._tables.read("runs", self._tables.current(), RUNS)

    def apply(self, datasets: DataFrame | None = None, runs: DataFrame | None = None) -> int:
        """Put changed rows in place, both tables at once; the version that is current then."""
        tables, version = self._tables, self._tables.current() + 1
        changed = self.datasets() if datasets is None else upsert(self.datasets(), datasets, ["dataset"])
        tables.write(changed, "datasets", version)
        changed = self.runs() if runs is None else upsert(self.runs(), runs, ["kind", "run"])
        tables.write(changed, "runs", version)
        tables.publish(version)
        tables.remove(*[tables.folder(table, version - 2) for table in ("datasets", "runs") if version > 2])
        return version

    def follow(self, intake: Intake) -> int:
        """Take over what an intake holds now: its datasets, and an import for each content they got.

        What was taken over before comes out as the same rows, so this may be done at any time.
        """
        held = current_datasets(self.spark, intake).withColumn("dataset", dataset_of(F.col("group"), F.col("dataset_type")))
        active = F.lit("ACTIVE").alias("status")
        when = F.col("changed").alias("modified")
        datasets = held.select("dataset", "group", "dataset_type", active, when)
        imports = held.select(
            F.lit("import").alias("kind"), import_name(F.col("dataset"), F.col("changed")).alias("run"),
            F.col("dataset").alias("parent"), "group", F.lit(None).cast("string").alias("predictor"),
            active, F.col("changed").alias("created"), when, "signature",
        )
        return self.apply(datasets, imports)

    def decisions(self, now: Column, max_age: int = DEFAULT_MAX_AGE, configured: DataFrame | None = None) -> DataFrame:
        """Per group: ``ready``, whether and why to train (``retrain``, ``train_reason``), and ``forecast`` state.

        Readiness asks for the configured dataset types of a group (``group, dataset_type``), a target series
        where nothing is configured; other datasets that are there have to be active as well. Training and
        forecasting are judged whether a group is ready or not.
        """
        datasets, runs = self.datasets(), self.runs()
        configured = self.spark.createDataFrame([], "group string, dataset_type string") if configured is None else configured
        groups = datasets.select("group").unionByName(configured.select("group")).distinct()
        needed = with_default_types(groups, configured).withColumn("dataset", dataset_of(F.col("group"), F.col("dataset_type")))
        absent = needed.join(datasets.select("dataset"), "dataset", "left_anti")
        every = datasets.select("dataset", "group", "status").unionByName(
            absent.select("dataset", "group", F.lit(_MISSING).alias("status"))
        )
        predictors, forecasts = runs.where(F.col("kind") == "predictor"), runs.where(F.col("kind") == "forecast")
        ready = readiness(every, runs.where(F.col("kind") == "import")).select("group", "ready")
        train = retrain_needed(groups, predictors, datasets, now, max_age)
        active = newest(predictors.where(is_active(F.col("status"))), ["group"], "created", "run")
        stale = forecast_stale(active.select("group", F.col("run").alias("predictor")), forecasts, datasets)
        return (
            ready.join(train.select("group", F.col("reason").alias("train_reason"), "retrain"), "group")
            .join(stale.select("group", F.col("reason").alias("forecast")), "group", "left")
            .withColumn("forecast", F.coalesce("forecast", F.lit("no predictor")))
        )
