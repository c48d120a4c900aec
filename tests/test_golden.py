"""Dirty sample files through cleaning, bucketing and consolidation."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from demandlake.operators.bucket import bucket
from demandlake.operators.clean import clean_export, clean_input
from demandlake.plans.consolidation import (
    GroupSources,
    consolidated,
    forecast_settings,
    resolve_sources,
    run_consolidation,
)
from demandlake.sources.csv import has_header, read_dataset, read_export
from demandlake.spec import DatasetSpec

from conftest import rows

TARGET = DatasetSpec.of("CUSTOM", item_id="string", timestamp="timestamp", target_value="integer")
METADATA = DatasetSpec.of("CUSTOM", item_id="string", geo="string", store_id="string")

DEMAND = """item_id,timestamp,target_value
item_01,2000-01-01 01:01:01,1
item_01,2000-01-02 02:02:02,2
item_01,2000-01-03 03:03:03,3

item_01,2000-01-04 04:04:04,4
item_01,2000-01-05 05:05:05,5
item_01,01:01:01,5
item_01,2000-01-06 06:06:06,6
,,,,,,,,,,bad_data
,
,,
,2000-01-01 01:01:01,5
item_01,,5
item_01,2000-01-07 07:07:07,


"""
ITEMS = """item_id,geo,store_id
item_01,CA,store_01
item_02,CA,store_02


,CA,store_02
item_03,CA,
item_04,,store_03"""
FORECAST = """item_id,date,p10,p50,p90
item_01,2020-07-01T00:00:00Z,1.0,2.0,3.0"""
BACKTEST = """item_id,timestamp,target_value,backtestwindow_start_time,backtestwindow_end_time,p10,p50,p90
item_01,2019-07-14T12:38:26Z,0.0,2019-07-14T12:38:26,2020-06-14T12:38:26,1.0,2.0,3.0"""


@pytest.fixture
def sources(tmp_path):
    files = {
        "data.csv": DEMAND,
        "data.metadata.csv": ITEMS,
        "predictor/forecasted-values/sample.csv": BACKTEST,
        "predictor/forecasted-values/empty.csv": "",
        "forecast/sample.csv": FORECAST,
    }
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(content)
    return GroupSources(
        target=str(tmp_path / "data.csv"),
        metadata=str(tmp_path / "data.metadata.csv"),
        backtest=str(tmp_path / "predictor/forecasted-values"),
        forecast=str(tmp_path / "forecast"),
    )


@pytest.mark.parametrize("header", [None, True, False])
def test_target_series_weekly(spark, sources, header):
    raw = read_dataset(spark, sources.target, TARGET, header)
    weeks = bucket(clean_input(raw, TARGET), "W")
    assert weeks.columns == ["identifier", "timestamp", "metric"]
    assert rows(weeks) == [
        ("item_01", datetime(1999, 12, 27), 3),
        ("item_01", datetime(2000, 1, 3), 18),
    ]


def test_null_target_is_kept(spark, sources):
    cleaned = clean_input(read_dataset(spark, sources.target, TARGET), TARGET)
    assert cleaned.count() == 7
    assert cleaned.where("metric is null").count() == 1


def test_bucket_of_nulls_stays_null(spark, sources):
    cleaned = clean_input(read_dataset(spark, sources.target, TARGET), TARGET)
    days = bucket(cleaned, "D").where("timestamp = timestamp'2000-01-07'")
    assert [r.metric for r in days.collect()] == [None]


def test_item_metadata(spark, sources):
    cleaned = clean_input(read_dataset(spark, sources.metadata, METADATA), METADATA)
    assert cleaned.columns == ["identifier", "geo", "store_id"]
    assert rows(cleaned) == [("item_01", "CA", "store_01"), ("item_02", "CA", "store_02")]


def test_exports(spark, sources):
    forecast = clean_export(read_export(spark, sources.forecast), TARGET, backtest=False)
    assert forecast.columns == ["identifier", "timestamp", "p10", "p50", "p90"]
    assert rows(forecast) == [("item_01", datetime(2020, 7, 1), 1.0, 2.0, 3.0)]
    backtest = clean_export(read_export(spark, sources.backtest), TARGET, backtest=True)
    assert backtest.columns == ["identifier", "timestamp", "metric", "p10", "p50", "p90"]
    assert rows(backtest) == [("item_01", datetime(2019, 7, 14, 12, 38, 26), 0.0, 1.0, 2.0, 3.0)]


def test_consolidated(spark, sources):
    wide = consolidated(spark, sources, TARGET, "W", metadata_spec=METADATA)
    found = wide.orderBy("timestamp").collect()
    assert len(found) == 4
    assert {r.identifier for r in found} == {"item_01"}
    assert [r.metric for r in found] == [3, 18, 0, None]
    assert {r.metadata_1 for r in found} == {"CA"}
    assert {r.metadata_2 for r in found} == {"store_01"}
    assert [r.month_starting for r in found] == ["1999-12-01", "2000-01-01", "2019-07-01", "2020-07-01"]


def test_consolidated_without_metadata(spark, sources):
    bare = GroupSources(sources.target, sources.backtest, sources.forecast)
    wide = consolidated(spark, bare, TARGET, "W")
    assert wide.count() == 4
    assert wide.where("metadata_1 is not null").count() == 0


def test_written_table(spark, sources, tmp_path):
    name = run_consolidation(
        spark, sources, TARGET, "W", "golden_table", metadata_spec=METADATA, path=str(tmp_path / "out")
    )
    written = spark.sql(f"SELECT metric FROM {name} WHERE month_starting = '2000-01-01'")
    assert rows(written) == [(18.0,)]
    assert (tmp_path / "out" / "month_starting=1999-12-01").is_dir()


def test_published_table_and_copies_at_hand(spark, sources, tmp_path):
    cached = tmp_path / "cache"
    (cached / "target").mkdir(parents=True)
    (cached / "target" / "part.csv").write_text("item_01,2000-01-01 01:01:01,50\n")
    recorded = replace(sources, frequency="W")
    for cache, first in ((None, 3.0), (str(cached), 50.0)):
        run_consolidation(spark, recorded, TARGET, table="golden_view", path=str(tmp_path / "out"), cache=cache, publish=True)
        assert spark.table("golden_view").orderBy("timestamp").first()["metric"] == first
    with pytest.raises(ValueError, match="frequency"):
        run_consolidation(spark, sources, TARGET, table="golden_view", path=str(tmp_path / "out"))
    with pytest.raises(ValueError, match="path"):
        run_consolidation(spark, recorded, TARGET, table="golden_view", publish=True)
    spark.sql("DROP VIEW golden_view")


def test_header_is_found(spark, sources):
    assert has_header(spark, sources.target, TARGET.fields)
    assert has_header(spark, sources.metadata, METADATA.fields)


def manifest(spark, records):
    return spark.createDataFrame(
        records,
        "kind string, run string, parent string, predictor string, status string, created string, "
        "source_path string, destination_path string",
    )


RUNS = [
    ("import", "i1", "ds", None, "ACTIVE", "2001-01-01", "old", None),
    ("import", "i2", "ds", None, "ACTIVE", "2001-01-03", "new", None),
    ("import", "i3", "ds", None, "CREATE_FAILED", "2001-01-04", "failed", None),
    ("predictor", "p1", "g", "p1", "ACTIVE", "2001-01-01", None, None),
    ("predictor", "p2", "g", "p2", "ACTIVE", "2001-01-02", None, None),
    ("forecast", "f1", "g", "p2", "ACTIVE", "2001-01-03", None, None),
    ("forecast", "f2", "g", "p1", "ACTIVE", "2001-01-04", None, None),
    ("backtest_export", "b1", "p2", "p2", "ACTIVE", "2001-01-05", None, "back"),
    ("forecast_export", "e1", "f1", "p2", "ACTIVE", "2001-01-05", None, "one"),
    ("forecast_export", "e2", "f2", "p1", "ACTIVE", "2001-01-05", None, "two"),
]


def test_newest_active_runs_are_used(spark):
    found = resolve_sources(manifest(spark, RUNS), "g", "ds")
    assert found == GroupSources(target="new", backtest="back/forecasted-values", forecast="two")


def test_forecast_of_the_same_predictor(spark):
    found = resolve_sources(manifest(spark, RUNS), "g", "ds", same_predictor=True)
    assert found.forecast == "one"


@pytest.mark.parametrize("missing", ["import", "predictor", "forecast", "backtest_export", "forecast_export"])
def test_missing_run_is_named(spark, missing):
    kept = manifest(spark, [r for r in RUNS if r[0] != missing])
    with pytest.raises(ValueError, match=f"no active {missing.replace('_', ' ')}"):
        resolve_sources(kept, "g", "ds")


def test_settings_come_with_the_predictor(spark):
    told = F.when(F.col("run") == "p2", '{"ForecastFrequency": "D", "ForecastDimensions": ["x"]}').otherwise('{"ForecastFrequency": "H"}')
    found = resolve_sources(manifest(spark, RUNS).withColumn("settings", told), "g", "ds")
    assert (found.frequency, found.dimensions) == ("D", ("x",))


def test_forecast_settings_in_both_places():
    nested = {"FeaturizationConfig": {"ForecastFrequency": "W", "ForecastDimensions": ["location"]}}
    assert forecast_settings(nested) == ("W", ["location"])
    assert forecast_settings({"FeaturizationConfig": {"ForecastFrequency": "D"}}) == ("D", [])
    assert forecast_settings({"ForecastFrequency": "H"}) == ("H", [])
