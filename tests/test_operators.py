"""Cleaning, buckets, generic names, union, wide schema, views."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demandlake.functions.calendar import add_periods, bucket_start, month_starting, periods_between
from demandlake.operators import consolidate as c
from demandlake.operators.attributes import GenericNames, drop_metadata
from demandlake.operators.bucket import bucket
from demandlake.operators.clean import cast_to_spec, clean_input, filter_timestamps, map_export, quantile_field
from demandlake.operators.views import quantile_bands
from demandlake.spec import DOMAINS, FREQUENCIES, Attribute, DatasetSpec, domain_fields, frequency_step

from conftest import rows

MOMENTS = [
    datetime(1969, 12, 31, 23, 59, 59),
    datetime(1970, 1, 1),
    datetime(2000, 1, 1, 1, 1, 1),
    datetime(2000, 2, 29, 12, 34, 56, 789000),
    datetime(2000, 1, 3),
    datetime(2024, 12, 31, 23, 45),
    datetime(1899, 3, 5, 7, 8, 9),
]


def expected_start(moment, frequency):
    midnight = moment.replace(hour=0, minute=0, second=0, microsecond=0)
    if frequency == "Y":
        return midnight.replace(month=1, day=1)
    if frequency == "M":
        return midnight.replace(day=1)
    if frequency == "W":
        return midnight - timedelta(days=moment.weekday())
    if frequency == "D":
        return midnight
    minutes = 60 if frequency == "H" else int(frequency.removesuffix("min"))
    since = (moment - midnight) // timedelta(minutes=minutes)
    return midnight + since * timedelta(minutes=minutes)


@pytest.mark.parametrize("frequency", FREQUENCIES)
def test_bucket_start(spark, frequency):
    df = spark.createDataFrame([(m,) for m in MOMENTS], "timestamp timestamp")
    found = df.select("timestamp", bucket_start("timestamp", frequency).alias("start")).collect()
    assert len(found) == len(MOMENTS)
    for row in found:
        assert row.start == expected_start(row.timestamp, frequency)


@pytest.mark.parametrize("frequency", FREQUENCIES)
@pytest.mark.parametrize("count", [-3, 0, 1, 7, 500])
def test_moving_and_counting_periods_agree(spark, frequency, count):
    start = F.lit("2000-01-01").cast("timestamp")
    moved = add_periods(start, frequency, count)
    row = spark.range(1).select(moved.alias("m"), periods_between(start, moved, frequency).alias("n")).first()
    assert row.n == count
    if frequency == "M":
        years, months = divmod(count, 12)
        assert row.m == datetime(2000 + years, months + 1, 1)


def test_month_starting_is_text(spark):
    df = spark.createDataFrame([(datetime(2000, 2, 29, 1),)], "timestamp timestamp")
    assert df.select(month_starting("timestamp")).first()[0] == "2000-02-01"


def test_dimensions_not_listed_are_summed_out(spark):
    day = datetime(2000, 1, 1)
    df = spark.createDataFrame(
        [("a", day, "x", 1.0), ("a", day, "y", 2.0), ("a", day, "y", None)],
        "identifier string, timestamp timestamp, location string, metric double",
    )
    assert rows(bucket(df, "D")) == [("a", day, 3.0)]
    assert rows(bucket(df, "D", ["location"])) == [("a", "x", day, 1.0), ("a", "y", day, 2.0)]


def test_unknown_settings_are_refused():
    with pytest.raises(ValueError, match="30s"):
        frequency_step("30s")
    with pytest.raises(ValueError, match="SHOPS"):
        domain_fields("SHOPS")
    with pytest.raises(ValueError, match="blob"):
        Attribute("a", "blob").data_type


@pytest.mark.parametrize("domain", DOMAINS)
def test_schema_of_each_domain(spark, domain):
    identifier, target = DOMAINS[domain]
    kinds = {"timestamp": "timestamp", target: "float", identifier: "string", "geolocation": "geolocation"}
    spec = DatasetSpec.of(domain, **kinds)
    assert [(f.name, f.dataType.simpleString()) for f in spec.struct] == [
        ("timestamp", "timestamp"),
        (target, "double"),
        (identifier, "string"),
        ("geolocation", "string"),
    ]
    raw = spark.createDataFrame([("2000-01-01", "1.5", "i", "1_2")], "a string, b string, c string, d string")
    cleaned = clean_input(raw, spec)
    assert cleaned.columns == ["timestamp", "metric", "identifier", "geolocation"]
    assert rows(cleaned) == [(datetime(2000, 1, 1), 1.5, "i", "1_2")]


@pytest.mark.parametrize(
    "value,kept",
    [
        ("2000-01-01", True),
        ("2000-1-5", True),
        ("2000-1-5 1:2:3", True),
        ("2000-01-01 01:02:03", True),
        ("2000-01-01T01:02:03Z", False),
        ("01:01:01", False),
        ("2000/01/01", False),
        ("2000-01-01 01:02", False),
        (" 2000-01-01", False),
        ("", False),
        (None, False),
    ],
)
def test_timestamp_shapes(spark, value, kept):
    spec = DatasetSpec.of("CUSTOM", timestamp="timestamp")
    raw = spark.createDataFrame([(value,)], "c string")
    assert filter_timestamps(raw, spec).count() == int(kept)


def test_impossible_date_passes_the_shape_and_fails_the_cast(spark):
    spec = DatasetSpec.of("CUSTOM", item_id="string", timestamp="timestamp", target_value="integer")
    raw = spark.createDataFrame([("a", "2000-13-45", "1"), ("a", "2000-01-05", "x")], "a string, b string, c string")
    assert filter_timestamps(raw, spec).count() == 2
    assert rows(cast_to_spec(raw, spec)) == [("a", None, 1), ("a", datetime(2000, 1, 5), None)]
    assert rows(clean_input(raw, spec)) == [("a", datetime(2000, 1, 5), None)]


def test_extra_columns_are_dropped(spark):
    spec = DatasetSpec.of("CUSTOM", item_id="string")
    raw = spark.createDataFrame([("a", "b")], "x string, y string")
    assert cast_to_spec(raw, spec).columns == ["item_id"]


@pytest.mark.parametrize(
    "name,expected",
    [("p50", "p50"), ("P50", "p50"), ("p1", "p1"), ("p99", "p99"), ("mean", "mean")]
    + [(n, None) for n in ("p0", "p100", "|50", "p", "pp5", "p5x", "average", "p05")],
)
def test_quantile_names(name, expected):
    assert quantile_field(name) == expected


def test_colliding_export_columns_are_refused(spark):
    spec = DatasetSpec.of("CUSTOM", item_id="string", timestamp="timestamp", target_value="float")
    raw = spark.createDataFrame([("a", "2000-01-01", "2000-01-01")], "item_id string, date string, timestamp string")
    with pytest.raises(ValueError, match="timestamp"):
        map_export(raw, spec, backtest=False)


def test_target_is_only_known_in_backtests(spark):
    spec = DatasetSpec.of("RETAIL", item_id="string", timestamp="timestamp", demand="float")
    raw = spark.createDataFrame([("a", "1", "2")], "item_id string, target_value string, color string")
    assert map_export(raw, spec, backtest=True).columns == ["identifier", "metric", "color"]
    assert map_export(raw, spec, backtest=False).columns == ["identifier", "target_value", "color"]


# -- generic names ------------------------------------------------------------------------


def names(target=("item_id", "timestamp", "demand", "location"), metadata=("item_id", "brand", "color")):
    reserved = ("item_id", "demand", "identifier", "metric", "timestamp")
    return GenericNames(tuple(target), tuple(metadata), reserved)


def test_slots_follow_discovery_across_frames():
    found = (
        names(target=("item_id", "timestamp", "demand", "location", "channel"))
        .discover(["identifier", "location", "timestamp", "metric"])
        .discover(["identifier", "timestamp", "channel", "color", "location", "p50"])
        .discover(["identifier", "timestamp", "brand"])
    )
    assert found.dimensions == ("location", "channel")
    assert found.metadata == ("color", "brand")
    assert found.renames(["identifier", "channel", "brand", "p50"]) == {
        "channel": "dimension_2",
        "brand": "metadata_2",
    }


def test_metadata_frame_only_has_metadata():
    found = names(metadata=("item_id", "location", "brand")).discover(["location"])
    found = found.discover_metadata(["identifier", "location", "brand"])
    assert found.dimensions == ("location",)
    assert found.metadata_renames(["identifier", "location", "brand"]) == {
        "location": "metadata_1",
        "brand": "metadata_2",
    }


def test_drop_metadata(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, metadata_1 int, metadata_x int")
    assert drop_metadata(df).columns == ["a", "metadata_x"]


# -- union and wide schema ------------------------------------------------------------------


@pytest.mark.parametrize(
    "left,right,columns,expected",
    [
        (
            ("a int, b int, c int", [(1, 2, 3), (4, 5, 6)]),
            ("c int, d int, a int", [(7, 8, 9), (10, 11, 12)]),
            ["a", "b", "c", "d"],
            [(1, 2, 3, None), (4, 5, 6, None), (9, None, 7, 8), (12, None, 10, 11)],
        ),
        (
            ("c int, d int, a int", [(7, 8, 9), (10, 11, 12)]),
            ("a int, b int, c int", [(1, 2, 3), (4, 5, 6)]),
            ["c", "d", "a", "b"],
            [(7, 8, 9, None), (10, 11, 12, None), (3, None, 1, 2), (6, None, 4, 5)],
        ),
    ],
)
def test_union(spark, left, right, columns, expected):
    union = c.union_frames(spark.createDataFrame(left[1], left[0]), spark.createDataFrame(right[1], right[0]))
    assert union.columns == columns
    assert rows(union) == sorted(expected, key=str)


def test_union_needs_both_frames(spark):
    with pytest.raises(ValueError):
        c.union_frames(None, spark.range(1))
    with pytest.raises(ValueError):
        c.union_frames(spark.range(1), None)


def test_wide_schema():
    kinds = {f.name: f.dataType.simpleString() for f in c.wide_schema()}
    assert len(kinds) == 123
    assert kinds["timestamp"] == "timestamp" and kinds["identifier"] == "string"
    assert all(kinds[f"p{n}"] == "double" for n in range(1, 100))
    assert all(kinds[f"{k}_{n}"] == "string" for k in ("dimension", "metadata") for n in range(1, 11))


def test_unknown_columns_follow_in_order(spark):
    df = spark.createDataFrame([("i", 1, 2)], "identifier string, zebra int, dimension_11 int")
    assert c.to_wide(df).columns == [*c.wide_schema().fieldNames(), "zebra", "dimension_11"]


def history(spark):
    return spark.createDataFrame(
        [("a", datetime(2000, 1, 1), 1.0), ("a", datetime(2000, 1, 3), 2.0), ("a", datetime(2000, 1, 5), 3.0)],
        "identifier string, timestamp timestamp, metric double",
    )


def test_history_is_cut_strictly_before_the_earliest_backtest(spark):
    backtest = spark.createDataFrame(
        [(datetime(2000, 1, 5),), (datetime(2000, 1, 3),), (None,)], "timestamp timestamp"
    )
    assert [r.metric for r in c.cut_history(history(spark), backtest).collect()] == [1.0]


def test_no_backtest_keeps_all_history(spark):
    empty = spark.createDataFrame([], "timestamp timestamp")
    assert c.cut_history(history(spark), empty).count() == 3


def test_metadata_join_fans_out_and_reports_it(spark):
    metadata = spark.createDataFrame([("a", "x"), ("a", "y")], "identifier string, metadata_1 string")
    assert c.join_metadata(history(spark), metadata).count() == 6
    assert rows(c.duplicate_identifiers(metadata)) == [("a", 2)]


def test_quantile_bands(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 9.0)], "identifier string, p10 double, p50 double, p90 double, mean double")
    assert rows(quantile_bands(df, ["identifier"])) == [("a", 2.0, "p10", 1.0), ("a", 2.0, "p90", 3.0)]
