"""Questions about runs, datasets and uploads, asked of manifest tables.

Columns used: runs have ``kind, run, parent, status, created, modified``; datasets have
``dataset, group, status, modified``. A parent or group may hold any share of the rows,
so answers are aggregates that combine on the map side, and lists of offenders are rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.functions.text import is_active, is_failed, is_updating
from demandlake.operators.running import rank_newest_first
from demandlake.sources.names import (
    backtest_export_name,
    forecast_export_name,
    forecast_name,
    predictor_name,
    stamp,
)
from demandlake.spec import TARGET_TIME_SERIES

# Fixed value: a predictor older than this many seconds is retrained when its data changed.
DEFAULT_MAX_AGE = 604_800


def newest(df: DataFrame, keys: Sequence[str], moment: str, tie: str) -> DataFrame:
    """The newest row of each key; ``tie`` decides between rows of the same moment."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.max(F.struct(moment, tie, *[c for c in rest if c not in (moment, tie)])).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def latest_active_run(runs: DataFrame, keys: Sequence[str] = ("kind", "parent")) -> DataFrame:
    return newest(runs.where(is_active(F.col("status"))), keys, "created", "run")


def run_history(
    runs: DataFrame, keys: Sequence[str] = ("parent",), by: str = "modified", status: str | None = None
) -> DataFrame:
    """Runs numbered newest first per parent, by ``modified`` or ``created``."""
    kept = runs if status is None else runs.where(F.col("status") == status)
    return rank_newest_first(kept, keys, by, "run")


def latest_change(datasets: DataFrame) -> DataFrame:
    """Per group, when any of its datasets last changed, also as used in names."""
    return (
        datasets.groupBy("group")
        .agg(F.max("modified").alias("latest_modified"))
        .withColumn("latest_stamp", stamp(F.col("latest_modified")))
    )


def latest_names(datasets: DataFrame, predictors: DataFrame) -> DataFrame:
    """Per group, what the next runs are called: after the newest change of its data, or its newest predictor.

    ``predictors`` has ``group, run, created`` and ``automatic``. A group without a predictor has no name for
    a backtest export, and is taken not to be automatic.
    """
    last = newest(predictors.select("group", "run", "created", "automatic"), ["group"], "created", "run")
    changed = datasets.groupBy("group").agg(F.max("modified").alias("modified"))
    group, data, made = F.col("group"), F.col("modified"), F.col("created")
    automatic = F.coalesce("automatic", F.lit(False))
    return changed.join(last, "group", "left").select(
        "group",
        predictor_name(group, data, automatic).alias("predictor_name"),
        F.when(made.isNotNull(), backtest_export_name(group, made, automatic)).alias("backtest_export_name"),
        forecast_name(group, data, automatic).alias("forecast_name"),
        forecast_export_name(group, data, automatic).alias("forecast_export_name"),
    )


def status_classes(status: Column) -> list[Column]:
    return [
        is_active(status).alias("finalized"),
        is_updating(status).alias("updating"),
        is_failed(status).alias("failed"),
    ]


def _with_import(datasets: DataFrame, imports: DataFrame) -> DataFrame:
    imported = (
        imports.where(is_active(F.col("status")))
        .select(F.col("parent").alias("dataset"))
        .distinct()
        .withColumn("has_import", F.lit(True))
    )
    return datasets.join(imported, "dataset", "left").withColumn(
        "has_import", F.coalesce("has_import", F.lit(False))
    )


def readiness(datasets: DataFrame, imports: DataFrame) -> DataFrame:
    """Per group: is every dataset active, and does each have an active import?"""
    active = is_active(F.col("status"))
    return (
        _with_import(datasets, imports)
        .groupBy("group")
        .agg(
            F.count(F.lit(1)).alias("datasets"),
            F.count_if(~active).alias("not_active"),
            F.count_if(~F.col("has_import")).alias("not_imported"),
        )
        .withColumn("ready", (F.col("not_active") == 0) & (F.col("not_imported") == 0))
    )


def readiness_offenders(datasets: DataFrame, imports: DataFrame) -> DataFrame:
    """The datasets that keep their group from being ready.

    As in a single check, a group's imports only matter once all its datasets are active.
    """
    active = is_active(F.col("status"))
    waiting = datasets.where(~active).select("group").distinct()
    inactive = datasets.where(~active).select("group", "dataset", F.concat(F.lit("status "), "status").alias("reason"))
    imported = imports.where(is_active(F.col("status"))).select(F.col("parent").alias("dataset"))
    unimported = (
        datasets.join(waiting, "group", "left_anti")
        .join(imported, "dataset", "left_anti")
        .select("group", "dataset", F.lit("no active import").alias("reason"))
    )
    return inactive.unionByName(unimported)


def retrain_needed(
    groups: DataFrame,
    predictors: DataFrame,
    datasets: DataFrame,
    now: Column,
    max_age: int = DEFAULT_MAX_AGE,
) -> DataFrame:
    """Per group: no predictor, or the last one failed, or it is too old for changed data."""
    last = newest(predictors.select("group", "run", "status", "created", "modified"), ["group"], "created", "run")
    changed = datasets.groupBy("group").agg(F.max("modified").alias("data_modified"))
    state = groups.select("group").join(last, "group", "left").join(changed, "group", "left")
    outdated = (F.col("data_modified") > F.col("modified")) & (
        F.col("modified") < now - F.make_dt_interval(secs=F.lit(max_age))
    )
    reason = (
        F.when(F.col("run").isNull(), "no predictor")
        .when(is_failed(F.col("status")), "last predictor failed")
        .when(outdated, "too old for changed data")
        .otherwise("up to date")
    )
    return state.select("group", "run", reason.alias("reason"), (reason != "up to date").alias("retrain"))


def forecast_stale(predictors: DataFrame, forecasts: DataFrame, datasets: DataFrame) -> DataFrame:
    """Per group and its current predictor: must the forecast be made again?

    ``predictors`` has one current ``predictor`` per ``group``; ``forecasts`` name the
    ``predictor`` they came from.
    """
    last = newest(
        forecasts.select("group", "predictor", "run", "created", "modified"),
        ["group", "predictor"],
        "modified",
        "run",
    )
    any_forecast = forecasts.select("group").distinct().withColumn("has_forecast", F.lit(True))
    changed = datasets.groupBy("group").agg(F.max("modified").alias("data_modified"))
    reason = (
        F.when(F.col("has_forecast").isNull(), "no forecast")
        .when(F.col("run").isNull(), "other predictor")
        .when(F.col("data_modified") > F.col("created"), "data changed")
        .otherwise("fresh")
    )
    return (
        predictors.select("group", "predictor")
        .join(last, ["group", "predictor"], "left")
        .join(any_forecast, "group", "left")
        .join(changed, "group", "left")
        .select("group", "predictor", reason.alias("reason"), (reason != "fresh").alias("stale"))
    )


SIGNATURE_SUMS = ("lines", "part0", "part1", "part2", "part3")


def content_sums(lines: DataFrame, keys: Sequence[str], columns: Sequence[str] = ("value",)) -> DataFrame:
    """The numbers a signature is made of, per key: they may be kept per file and added up.

    Each line is hashed where it lies and the hashes are added up, so a dataset of any
    size is signed by all tasks that read it, none of which sees it whole. The order of
    lines does not matter, as it does not to any later step. A hash is added in four
    parts of 16 bits, whose sums stay in range for 2^47 lines.
    """
    hashed = lines.select(*keys, F.xxhash64(*columns).alias("_hash"))
    parts = [F.sum(F.shiftrightunsigned("_hash", 16 * i).bitwiseAND(F.lit(0xFFFF))).alias(f"part{i}") for i in range(4)]
    return hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"), *parts)


def added_sums(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums of files as those of what they make up together, with its ``signature``."""
    total = sums.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in SIGNATURE_SUMS])
    return total.withColumn("signature", signature_of_sums())


def signature_of_sums() -> Column:
    return F.md5(F.concat_ws(":", *[F.col(n).cast("string") for n in SIGNATURE_SUMS]))


def content_signature(lines: DataFrame, keys: Sequence[str], line: str = "value") -> DataFrame:
    """A signature per key that changes when any of its lines does, whatever their order."""
    return content_sums(lines, keys, [line]).select(*keys, signature_of_sums().alias("signature"))


def content_changed(
    current: DataFrame, last_imports: DataFrame, keys: Sequence[str] = ("dataset",)
) -> DataFrame:
    """Which datasets to import again, judged on the last import of each.

    Never imported, imported without a signature, or different now means yes. A last
    import that is not active is left alone, whatever the content.
    """
    before = last_imports.select(
        *keys, F.col("status").alias("import_status"), F.col("signature").alias("imported_signature")
    )
    reason = (
        F.when(F.col("import_status").isNull(), "never imported")
        .when(~is_active(F.col("import_status")), "import not active")
        .when(F.col("imported_signature").isNull(), "no signature")
        .when(F.col("imported_signature") != F.col("signature"), "changed")
        .otherwise("same")
    )
    return current.join(before, list(keys), "left").select(
        *keys,
        reason.alias("reason"),
        reason.isin("never imported", "no signature", "changed").alias("reimport"),
    )


def latest_upload(uploads: DataFrame) -> DataFrame:
    """Per group, the only upload that may go on, and how many it supersedes."""
    return (
        uploads.groupBy("group")
        .agg(F.max(F.struct("updated", "file")).alias("_last"), F.count(F.lit(1)).alias("_n"))
        .select(
            "group",
            F.col("_last.file").alias("file"),
            F.col("_last.updated").alias("updated"),
            (F.col("_n") - 1).alias("superseded"),
        )
    )


def dependents(groups: DataFrame) -> DataFrame:
    """(group, dependent): each group itself, and every group that takes its datasets from it."""
    own = groups.select("group", F.col("group").alias("dependent"))
    users = groups.where(F.col("from_group").isNotNull()).select(
        F.col("from_group").alias("group"), F.col("group").alias("dependent")
    )
    return own.union(users).distinct()


DRIFT_FIELDS = ("dataset_type", "domain", "frequency", "schema")


def schema_drift(existing: DataFrame, requested: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Datasets whose existing definition differs from the requested one, with all differences.

    With ``groups`` (``group, group_domain``) a group's domain is compared too.
    """
    there = existing.select("dataset", *[F.col(f).alias(f"_{f}") for f in DRIFT_FIELDS])
    joined = requested.join(there, "dataset")
    labels = [
        F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in DRIFT_FIELDS
    ]
    if groups is not None:
        joined = joined.join(groups.select("group", "group_domain"), "group", "left")
        labels.append(F.when(F.col("group_domain") != F.col("domain"), F.lit("group_domain")))
    return joined.select("dataset", F.array_compact(F.array(*labels)).alias("differences")).where(
        F.size("differences") > 0
    )


def required_datasets(configured: DataFrame) -> DataFrame:
    """Per group, whether its configured dataset types are legal.

    ``configured`` has ``group, dataset_type``. A target series is mandatory and no type
    may come twice.
    """
    per_type = configured.groupBy("group", "dataset_type").agg(F.count(F.lit(1)).alias("copies"))
    return (
        per_type.groupBy("group")
        .agg(
            F.bool_or(F.col("dataset_type") == TARGET_TIME_SERIES).alias("has_target"),
            F.count_if(F.col("copies") > 1).alias("duplicate_types"),
        )
        .withColumn("valid", F.col("has_target") & (F.col("duplicate_types") == 0))
    )


def with_default_types(groups: DataFrame, configured: DataFrame) -> DataFrame:
    """(group, dataset_type): the configured types of each group, a target series where nothing is configured."""
    own = configured.select("group", "dataset_type")
    bare = groups.select("group").distinct().join(own, "group", "left_anti")
    return own.unionByName(bare.withColumn("dataset_type", F.lit(TARGET_TIME_SERIES)))
