"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Every timestamp in this library is UTC wall time.
TIME_ZONE = "UTC"


def build_session(app_name: str = "demandlake", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": TIME_ZONE,
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # the consolidated table has 124 columns; the default stops generating code at 100
        "spark.sql.codegen.maxFields": "200",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the one runtime setting results depend on, for sessions somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder for written intermediate tables.

    It lies under ``spark.checkpoint.dir``, which a cluster points at shared storage.
    Only a local session may go without that setting, since its executors share the
    driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir must name a shared folder: written intermediates "
                "have to outlive the executor that wrote them"
            )
        base = tempfile.mkdtemp(prefix="demandlake-")
    return f"{base.rstrip('/')}/demandlake/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored in the shared folder and read from there, so that what follows doesn't repeat its work."""
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
