"""Readiness, retraining, staleness, changed content, uploads, drift."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from demandlake.operators import manifest as m
from demandlake.functions import text
from demandlake.sources import names

from conftest import rows

DAY = [datetime(2000, 1, d) for d in range(1, 32)]
RUNS = "kind string, run string, parent string, status string, created timestamp, modified timestamp"
DATASETS = "dataset string, group string, status string, modified timestamp"


def test_latest_active_run_breaks_ties_by_run(spark):
    runs = spark.createDataFrame(
        [
            ("import", "a", "d", "ACTIVE", DAY[1], DAY[1]),
            ("import", "b", "d", "ACTIVE", DAY[1], DAY[2]),
            ("import", "c", "d", "CREATE_FAILED", DAY[5], DAY[5]),
            ("forecast", "d", "d", "ACTIVE", DAY[0], DAY[0]),
        ],
        RUNS,
    )
    found = m.latest_active_run(runs)
    assert found.columns == ["kind", "parent", "run", "status", "created", "modified"]
    assert sorted(r.run for r in found.collect()) == ["b", "d"]


def test_history_can_be_limited_to_a_status(spark):
    runs = spark.createDataFrame(
        [("import", "a", "d", "ACTIVE", DAY[1], DAY[3]), ("import", "b", "d", "ACTIVE", DAY[2], DAY[2]),
         ("import", "c", "d", "CREATE_FAILED", DAY[3], DAY[9])],
        RUNS,
    )
    assert {r.run: r.position for r in m.run_history(runs).collect()} == {"c": 1, "a": 2, "b": 3}
    by_created = m.run_history(runs, by="created", status="ACTIVE")
    assert {r.run: r.position for r in by_created.collect()} == {"b": 1, "a": 2}


@pytest.fixture
def datasets(spark):
    return spark.createDataFrame(
        [
            ("d1", "ready", "ACTIVE", DAY[1]),
            ("d2", "ready", "ACTIVE", DAY[2]),
            ("d3", "waiting", "UPDATE_PENDING", DAY[1]),
            ("d4", "waiting", "ACTIVE", DAY[1]),
            ("d5", "unimported", "ACTIVE", DAY[1]),
        ],
        DATASETS,
    )


@pytest.fixture
def imports(spark):
    return spark.createDataFrame(
        [
            ("import", "i1", "d1", "ACTIVE", DAY[1], DAY[1]),
            ("import", "i2", "d1", "ACTIVE", DAY[1], DAY[1]),
            ("import", "i3", "d2", "ACTIVE", DAY[1], DAY[1]),
            ("import", "i4", "d5", "CREATE_FAILED", DAY[1], DAY[1]),
        ],
        RUNS,
    )


def test_readiness(datasets, imports):
    assert rows(m.readiness(datasets, imports), "group") == [
        ("ready", 2, 0, 0, True),
        ("unimported", 1, 0, 1, False),
        ("waiting", 2, 1, 2, False),
    ]


def test_offenders_are_listed(datasets, imports):
    assert rows(m.readiness_offenders(datasets, imports)) == [
        ("unimported", "d5", "no active import"),
        ("waiting", "d3", "status UPDATE_PENDING"),
    ]


def test_latest_change(datasets):
    found = {r.group: r.latest_stamp for r in m.latest_change(datasets).collect()}
    assert found["ready"] == "2000_01_03_00_00_00"


PREDICTORS = "group string, run string, status string, created timestamp, modified timestamp"


@pytest.mark.parametrize(
    "runs,changed,now,reason",
    [
        ([], DAY[0], DAY[30], "no predictor"),
        ([("p1", "ACTIVE", DAY[0], DAY[0]), ("p2", "CREATE_FAILED", DAY[1], DAY[1])], DAY[5], DAY[30], "last predictor failed"),
        ([("p1", "CREATE_FAILED", DAY[0], DAY[0]), ("p2", "ACTIVE", DAY[1], DAY[1])], DAY[5], DAY[30], "too old for changed data"),
        ([("p2", "ACTIVE", DAY[1], DAY[1])], DAY[0], DAY[30], "up to date"),
        ([("p2", "ACTIVE", DAY[1], DAY[1])], DAY[5], DAY[8], "up to date"),
        ([("p2", "ACTIVE", DAY[1], DAY[1])], DAY[5], datetime(2000, 1, 9, 0, 0, 1), "too old for changed data"),
    ],
)
def test_retrain_needed(spark, runs, changed, now, reason):
    groups = spark.createDataFrame([("g",)], "group string")
    predictors = spark.createDataFrame([("g", *r) for r in runs], PREDICTORS)
    datasets = spark.createDataFrame([("d1", "g", "ACTIVE", DAY[0]), ("d2", "g", "ACTIVE", changed)], DATASETS)
    found = m.retrain_needed(groups, predictors, datasets, F.lit(now)).first()
    assert (found.reason, found.retrain) == (reason, reason != "up to date")


FORECASTS = "group string, predictor string, run string, created timestamp, modified timestamp"


@pytest.mark.parametrize(
    "runs,reason",
    [
        ([], "no forecast"),
        ([("old", "f1", DAY[9], DAY[9])], "other predictor"),
        ([("now", "f1", DAY[9], DAY[9])], "fresh"),
        ([("now", "f1", DAY[1], DAY[1])], "data changed"),
        ([("now", "f1", DAY[9], DAY[10]), ("now", "f2", DAY[1], DAY[9]), ("old", "f3", DAY[20], DAY[20])], "fresh"),
    ],
)
def test_forecast_stale(spark, runs, reason):
    predictors = spark.createDataFrame([("g", "now")], "group string, predictor string")
    forecasts = spark.createDataFrame([("g", *r) for r in runs], FORECASTS)
    datasets = spark.createDataFrame([("d1", "g", "ACTIVE", DAY[5])], DATASETS)
    found = m.forecast_stale(predictors, forecasts, datasets).first()
    assert (found.reason, found.stale) == (reason, reason != "fresh")


def signature(spark, lines, partitions=1):
    df = spark.createDataFrame([("d", line) for line in lines], "dataset string, value string")
    return m.content_signature(df.repartition(partitions), ["dataset"]).first().signature


def test_signature_sees_changes_and_not_layout(spark):
    lines = [f"item_{i},2000-01-01,{i}" for i in range(100)]
    assert signature(spark, lines) == signature(spark, lines[::-1], partitions=7)
    assert signature(spark, lines) != signature(spark, [*lines[:-1], "item_99,2000-01-01,98"])
    assert signature(spark, lines) != signature(spark, [*lines, lines[0]])


def test_content_changed(spark):
    current = spark.createDataFrame([(d, "new") for d in "abcde"], "dataset string, signature string")
    last = spark.createDataFrame(
        [("a", "ACTIVE", "new"), ("b", "ACTIVE", "old"), ("c", "ACTIVE", None), ("d", "CREATE_PENDING", "old")],
        "dataset string, status string, signature string",
    )
    assert rows(m.content_changed(current, last), "dataset") == [
        ("a", "same", False),
        ("b", "changed", True),
        ("c", "no signature", True),
        ("d", "import not active", False),
        ("e", "never imported", True),
    ]


def test_latest_upload(spark):
    uploads = spark.createDataFrame(
        [("g", "a.csv", DAY[0]), ("g", "b.csv", DAY[2]), ("g", "c.csv", DAY[1]), ("h", "d.csv", DAY[0])],
        "group string, file string, updated timestamp",
    )
    assert rows(m.latest_upload(uploads), "group") == [("g", "b.csv", DAY[2], 2), ("h", "d.csv", DAY[0], 0)]


def test_dependents(spark):
    groups = spark.createDataFrame([("a", None), ("b", "a"), ("c", "a"), ("d", "x")], "group string, from_group string")
    assert rows(m.dependents(groups)) == [
        ("a", "a"), ("a", "b"), ("a", "c"), ("b", "b"), ("c", "c"), ("d", "d"), ("x", "d"),
    ]


def test_drift_reports_all_differences(spark):
    schema = "dataset string, dataset_type string, domain string, frequency string, schema string"
    existing = spark.createDataFrame([("a", "TTS", "RETAIL", "D", "s"), ("b", "TTS", "RETAIL", None, "s")], schema)
    requested = spark.createDataFrame([("a", "RTS", "RETAIL", "W", "s"), ("b", "TTS", "RETAIL", None, "s"), ("c", "TTS", "RETAIL", "D", "s")], schema)
    assert rows(m.schema_drift(existing, requested)) == [("a", ["dataset_type", "frequency"])]


def test_required_datasets(spark):
    configured = spark.createDataFrame(
        [("ok", "TARGET_TIME_SERIES"), ("ok", "ITEM_METADATA"), ("none", "ITEM_METADATA"),
         ("twice", "TARGET_TIME_SERIES"), ("twice", "TARGET_TIME_SERIES")],
        "group string, dataset_type string",
    )
    assert {r.group: r.valid for r in m.required_datasets(configured).collect()} == {"ok": True, "none": False, "twice": False}


# All statuses and whether each is finalized, updating or failed.
STATUSES = {
    "ACTIVE": (True, False, False),
    "CREATE_PENDING": (False, True, False),
    "CREATE_IN_PROGRESS": (False, True, False),
    "CREATE_FAILED": (False, False, True),
    "DELETE_PENDING": (False, True, False),
    "DELETE_IN_PROGRESS": (False, True, False),
    "DELETE_FAILED": (False, False, True),
    "UPDATE_PENDING": (False, True, False),
    "UPDATE_IN_PROGRESS": (False, True, False),
    "UPDATE_FAILED": (False, False, True),
    "DOES_NOT_EXIST": (False, False, False),
    "NOT_READY": (False, False, False),
}


def test_status_classes(spark):
    df = spark.createDataFrame([(s,) for s in STATUSES], "status string")
    found = df.select("status", *m.status_classes(F.col("status"))).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == STATUSES


@pytest.mark.parametrize(
    "name,valid",
    [("a", True), ("A_1", True), ("a" * 63, True), ("a" * 64, False), ("1a", False), ("_a", False), ("a b", False),
     ("a-b", False), ("", False), ("aé中1", True), ("éa", False)],
)
def test_names(spark, name, valid):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(text.is_valid_name(F.col("n"))).first()[0] is valid


@pytest.mark.parametrize(
    "key,kind,name,prefix",
    [
        ("train/a.csv", "TARGET_TIME_SERIES", "a", "a"),
        ("train/a.related.csv", "RELATED_TIME_SERIES", "a_related", "a"),
        ("train/x/a.metadata.csv", "ITEM_METADATA", "a_metadata", "a"),
        ("a.v2.csv", "TARGET_TIME_SERIES", "a", "a"),
        ("train/a.related.csv.gz", "TARGET_TIME_SERIES", "a", "a"),
    ],
)
def test_file_keys(spark, key, kind, name, prefix):
    k = F.lit(key)
    found = spark.range(1).select(text.dataset_type(k), text.dataset_name(k), text.file_prefix(k)).first()
    assert tuple(found) == (kind, name, prefix)


@pytest.mark.parametrize(
    "path,delivered",
    [
        ("file:/in/a.csv", "file:/in/a.csv"),
        ("file:/in/a.csv/part-0.csv", "file:/in/a.csv"),
        ("file:/in/x.csv.d/a.related.csv/b.csv/part-0.csv", "file:/in/x.csv.d/a.related.csv"),
        ("file:/in/a.csv.gz", ""),
        ("file:/in/a.csv/.csv", "file:/in/a.csv"),
        ("/.csv", "/.csv"),
        ("", ""),
    ],
)
def test_delivered_files_are_found_without_a_pattern(spark, path, delivered):
    """It is asked for every line of a file."""
    found = spark.createDataFrame([(path,)], "path string").select(text.delivered_file(F.col("path")).alias("d"))
    by_pattern = F.regexp_extract(F.lit(path), r"^(.*?\.csv)(?:/.*)?$", 1)
    assert found.first()[0] == delivered == spark.range(1).select(by_pattern).first()[0]
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_urls(spark):
    url = F.lit("s3://bucket/train/sub/a.csv")
    found = spark.range(1).select(text.url_bucket(url), text.url_key(url), text.url_folder(url), text.file_name(url)).first()
    assert tuple(found) == ("bucket", "train/sub/a.csv", "s3://bucket/train/sub/", "a.csv")
    decoded = spark.range(1).select(text.decoded_key(F.lit("train/a+b%20c.csv")), text.decoded_key(F.lit("bad%zz"))).first()
    assert tuple(decoded) == ("train/a b c.csv", None)


def test_run_names(spark):
    moment, group = F.lit(datetime(2000, 1, 2, 3, 4, 5)), F.lit("g")
    yes, no = F.lit(True), F.lit(False)
    found = spark.range(1).select(
        names.import_name(F.lit("d"), moment),
        names.predictor_name(group, moment, yes),
        names.predictor_name(group, moment, no),
        names.forecast_name(group, moment, yes),
        names.forecast_export_name(group, moment, no),
        names.backtest_export_name(group, moment, yes),
    ).first()
    assert tuple(found) == (
        "d_2000_01_02_03_04_05",
        "g_auto_2000_01_02_03_04_05",
        "g_2000_01_02_03_04_05",
        "forecast_ap_g_2000_01_02_03_04_05",
        "export_g_2000_01_02_03_04_05",
        "export_g_auto_2000_01_02_03_04_05",
    )
    assert names.table_name("g", datetime(2000, 1, 2, 3, 4, 5)) == "g_2000_01_02_03_04_05"
