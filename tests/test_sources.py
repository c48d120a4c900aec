"""Header detection, listings, the month table, the stream, the shared folder."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from demandlake.plans import file_queries
from demandlake.plans.registry import QUERIES
from demandlake.session import work_folder
from demandlake.sources import csv, tables
from demandlake.sources.signatures import dataset_signatures, file_signatures
from demandlake.spec import ITEM_METADATA, RELATED_TIME_SERIES, DatasetSpec
from demandlake.streaming.arrivals import SideTable, rebuild_batch, start_ingest, without_header

from conftest import rows

SPEC = DatasetSpec.of("RETAIL", item_id="string", timestamp="timestamp", location="string", demand="float")
FIELDS = ["item_id", "timestamp", "demand"]


@pytest.mark.parametrize(
    "lines,expected",
    [
        (["item_id,timestamp,demand", "a,2000-01-01,1"], True),
        (["demand,item_id,timestamp", "1,a,2000-01-01"], True),
        (["a,2000-01-01,1", "b,2000-01-02,2"], False),
        ([], False),
        (["item_id,when,amount"] + [f"item_{i:03d},2000-01-01,{i}" for i in range(50)], True),
        (["item_id,2000-01-01,1"] + [f"item_id,2000-01-0{i},{i}" for i in range(1, 9)], False),
        (["item_id", "x"], False),
    ],
)
def test_header_rules(lines, expected):
    assert csv.looks_like_header(lines, FIELDS) is expected


def test_header_of_an_export_folder_comes_from_its_first_file_with_content(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("item_id,timestamp,demand\nx,2000-01-01,1\n")
    (tmp_path / "c.txt").write_text("no")
    assert csv.first_nonempty(spark, str(tmp_path)).endswith("b.csv")
    assert csv.has_header(spark, str(tmp_path), FIELDS)


def test_no_export_data_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError, match="no export data"):
        csv.first_nonempty(spark, str(tmp_path))


def test_first_existing_location(spark, tmp_path):
    (tmp_path / "there.csv").write_text("a")
    there = str(tmp_path / "there.csv")
    assert csv.first_existing(spark, str(tmp_path / "cached.csv"), there) == there
    with pytest.raises(ValueError, match="cached"):
        csv.first_existing(spark, str(tmp_path / "cached.csv"))


def test_file_signatures(spark, tmp_path):
    content = "".join(f"item_{i},2000-01-01,{i}\n" for i in range(200))
    (tmp_path / "a.csv").write_text(content)
    (tmp_path / "b.related.csv").write_text(content[:-3])

    def signed():
        return {r.dataset: r.signature for r in file_signatures(spark, str(tmp_path)).collect()}

    before = signed()
    assert set(before) == {"a", "b_related"} and len(set(before.values())) == 2
    (tmp_path / "a.csv").write_text("".join(reversed(content.splitlines(keepends=True))))
    assert signed() == before
    (tmp_path / "a.csv").write_text(content.replace("item_7,", "item_8,"))
    assert signed()["a"] != before["a"] and signed()["b_related"] == before["b_related"]
    (tmp_path / "b.related.csv").write_text("")
    assert set(signed()) == {"a"}


def test_datasets_that_share_files_are_signed_each(spark, tmp_path):
    content = [f"{'ab'[i % 2]},item_{i},{i}\n" for i in range(200)]

    def signed(*parts):
        for number, part in enumerate(parts):
            (tmp_path / f"part-{number}.csv").write_text("".join(part))
        found = dataset_signatures(spark, str(tmp_path), ["key", "item_id", "demand"], "key")
        return {r.key: r.signature for r in found.collect()}

    before = signed(content[:50], content[50:])
    assert set(before) == {"a", "b"} and before["a"] != before["b"]
    assert signed(content[:20:-1], content[20::-1]) == before
    after = signed(content[:50], [line.replace("item_60,", "item_x,") for line in content[50:]])
    assert after["a"] != before["a"] and after["b"] == before["b"]


def test_signed_files_do_not_grow_with_the_suppliers(spark, sf, monkeypatch):
    folders = []
    monkeypatch.setattr(file_queries, "work_folder", lambda s, label: folders.append(work_folder(s, label)) or folders[-1])
    found = QUERIES["file_signatures"](spark, sf).count()
    files = [f for folder in folders for f in Path(folder).rglob("*.csv")]
    assert found >= 10 and len(folders) == 2 and 0 < len(files) < found


def test_export_parts_with_another_column_order_fail(spark, tmp_path):
    (tmp_path / "part-1.csv").write_text("item_id,p10,p90\na,1,9\n")
    (tmp_path / "part-2.csv").write_text("item_id,p90,p10\na,9,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        csv.read_export(spark, str(tmp_path)).collect()


def wide(spark):
    return spark.createDataFrame(
        [
            ("a", datetime(2000, 1, 31), 1.0, "2000-01-01"),
            ("a", datetime(2000, 2, 1), 2.0, "2000-02-01"),
            ("b", datetime(2000, 2, 29), 3.0, "2000-02-01"),
            ("b", datetime(2000, 4, 1), 4.0, "2000-04-01"),
        ],
        "identifier string, timestamp timestamp, metric double, month_starting string",
    )


def test_month_table_round_trip_prunes_months(spark, tmp_path):
    name = tables.write_by_month(wide(spark), "by_month", str(tmp_path / "t"))
    assert rows(spark.table(name).select("identifier", "timestamp", "metric", "month_starting")) == rows(wide(spark))
    part = tables.read_range(spark.table(name), "2000-02-01", "2000-02-28")
    assert rows(part.select("metric")) == [(2.0,)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_starting" in plan
    assert len(part.inputFiles()) == 1
    assert rows(spark.sql(f"SELECT sum(metric) FROM {name} WHERE month_starting >= '2000-02-01'")) == [(9.0,)]


def test_a_table_is_published_at_once_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "published")
    first = wide(spark)
    broken = first.withColumn("metric", F.when(F.col("metric") == 2, F.raise_error(F.lit("half-way"))).otherwise(F.col("metric")))
    with pytest.raises(Exception, match="half-way"):
        tables.publish_by_month(broken, "whole", path)
    assert not spark.catalog.tableExists("whole")
    tables.publish_by_month(first, "whole", path)
    before = rows(spark.table("whole"))
    assert before == rows(first) and spark.table("whole").schema == first.schema
    with pytest.raises(Exception, match="half-way"):
        tables.publish_by_month(broken, "whole", path)
    assert rows(spark.table("whole")) == before
    reader = spark.table("whole")
    more = first.withColumn("metric", F.col("metric") + 1)
    tables.publish_by_month(more, "whole", path)
    assert rows(spark.table("whole")) == rows(more)
    assert rows(reader) == before  # a reader that has begun finds its files
    plan = spark.table("whole").where("month_starting = '2000-02-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_starting" in plan or "month_starting" in plan.split("PartitionFilters")[1][:80]
    for _ in range(2):
        tables.publish_by_month(first, "whole", path)
    assert sorted(p.name for p in (tmp_path / "published" / "months").iterdir()) == ["version=3", "version=4"]
    spark.sql("DROP VIEW whole")


def test_runs_with_other_columns_are_read_together(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    tables.write_by_month(wide(spark), "run_one", one)
    tables.write_by_month(wide(spark).withColumn("dimension_11", F.lit("x")), "run_two", two)
    both = tables.read_runs(spark, one, two)
    assert both.count() == 8
    assert both.where("month_starting = '2000-02-01'").count() == 4
    assert both.where("dimension_11 is null").count() == 4


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(base) and first != second


def ingest(spark, tmp_path, frequency="W"):
    start_ingest(
        spark, str(tmp_path / "train"), str(tmp_path / "raw"), str(tmp_path / "buckets"),
        str(tmp_path / "checkpoint"), SPEC, frequency, ["location"],
    ).awaitTermination()
    found = spark.read.schema(
        "identifier string, location string, timestamp timestamp, metric double, month_starting string"
    ).parquet(str(tmp_path / "buckets"))
    return rows(found.select("identifier", "location", "timestamp", "metric"))


def arrive(tmp_path, name, *lines):
    (tmp_path / "train").mkdir(exist_ok=True)
    (tmp_path / "train" / name).write_text("\n".join(lines) + "\n")


def test_fields_are_sorted_only_for_lines_that_may_be_a_header(spark):
    lines = [(*SPEC.fields,), (*reversed(SPEC.fields),), ("item_id", "item_id", "location", "demand"), ("item_id", None, "x", "1"), (None,) * 4]
    df = spark.createDataFrame([*lines, ("a", "2000-01-01", "x", "1")], SPEC.text_struct)
    left = without_header(df, SPEC)
    assert left.count() == 4 and left.where("_c0 = 'item_id'").count() == 2
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("_c0", plan.index("Filter")) < plan.index("sort_array") and " IN (item_id,timestamp,location,demand)" in plan


def test_late_files_change_the_buckets_they_touch(spark, tmp_path):
    arrive(tmp_path, "a.csv", "item_id,timestamp,location,demand", "i,2000-01-31,x,1", "i,2000-02-01,x,2", "i,2000-03-08,x,4", "i,bad,x,9")
    first = [
        ("i", "x", datetime(2000, 1, 31), 3.0),
        ("i", "x", datetime(2000, 3, 6), 4.0),
    ]
    assert ingest(spark, tmp_path) == first
    arrive(tmp_path, "late.csv", "i,2000-02-06,x,10", "j,2000-02-06,x,1")
    arrive(tmp_path, "late.metadata.csv", "i,2000-02-06,x,100")
    expected = [
        ("i", "x", datetime(2000, 1, 31), 13.0),
        ("i", "x", datetime(2000, 3, 6), 4.0),
        ("j", "x", datetime(2000, 1, 31), 1.0),
    ]
    assert ingest(spark, tmp_path) == expected
    assert ingest(spark, tmp_path) == expected


def test_related_series_and_metadata_arrive_too(spark, tmp_path):
    arrive(tmp_path, "a.csv", "i,2000-01-05,x,1")
    arrive(tmp_path, "a.related.csv", "i,2000-01-05,9.5", "i,bad,1", "i,2000-01-06,")
    arrive(tmp_path, "a.metadata.csv", "i,red,small,round,heavy", ",red,small,round,heavy")
    related = DatasetSpec.of("RETAIL", item_id="string", timestamp="timestamp", price="float")
    metadata = DatasetSpec.of("RETAIL", **dict.fromkeys(("item_id", "color", "size", "shape", "weight"), "string"))
    sides = {
        RELATED_TIME_SERIES: SideTable(related, str(tmp_path / "related")),
        ITEM_METADATA: SideTable(metadata, str(tmp_path / "metadata")),
    }
    start_ingest(
        spark, str(tmp_path / "train"), str(tmp_path / "raw"), str(tmp_path / "buckets"),
        str(tmp_path / "checkpoint"), SPEC, "D", ["location"], sides,
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "buckets")).count() == 1
    assert rows(spark.read.parquet(str(tmp_path / "related")).drop("batch")) == [("i", datetime(2000, 1, 5), 9.5)]
    assert rows(spark.read.parquet(str(tmp_path / "metadata")).drop("batch")) == [("i", "red", "small", "round", "heavy")]


def test_groups_are_kept_apart_and_metadata_is_replaced(spark, tmp_path):
    metadata = DatasetSpec.of("RETAIL", item_id="string", color="string")
    sides = {ITEM_METADATA: SideTable(metadata, str(tmp_path / "metadata"))}

    def run():
        start_ingest(
            spark, str(tmp_path / "train"), str(tmp_path / "raw"), str(tmp_path / "buckets"),
            str(tmp_path / "checkpoint"), SPEC, "D", ["location"], sides, group="demand",
        ).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "metadata")).drop("batch"))

    arrive(tmp_path, "demand.csv", "i,2000-01-05,x,1")
    arrive(tmp_path, "othergroup.csv", "i,2000-01-05,x,100")
    arrive(tmp_path, "othergroup.metadata.csv", "i,green")
    arrive(tmp_path, "demand.metadata.csv", "color,item_id", "item_id,color", "i,red", "j,blue")
    assert run() == [("i", "red"), ("j", "blue")]
    arrive(tmp_path, "demand.2.metadata.csv", "item_id,color", "i,yellow")
    assert run() == [("i", "yellow")]
    arrive(tmp_path, "demand.2.csv", "item_id,timestamp,location,demand", "i,2000-01-06,x,2")
    assert run() == [("i", "yellow")]
    found = spark.read.parquet(str(tmp_path / "buckets"))
    assert rows(found.select("identifier", "timestamp", "metric")) == [
        ("i", datetime(2000, 1, 5), 1.0),
        ("i", datetime(2000, 1, 6), 2.0),
    ]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    raw, buckets = str(tmp_path / "raw"), str(tmp_path / "buckets")
    process = rebuild_batch(raw, buckets, SPEC, "M", ["location"])
    text = "_c0 string, _c1 string, _c2 string, _c3 string, _type string"
    kind = "TARGET_TIME_SERIES"
    batches = [
        spark.createDataFrame([("i", "2000-01-05", "x", "1", kind), ("i", "2000-02-05", "x", "2", kind)], text),
        spark.createDataFrame([("i", "2000-01-06", "x", "3", kind)], text),
        spark.createDataFrame([], text),
    ]
    for number in (0, 1, 1, 0, 1, 2):
        process(batches[number], number)
    found = spark.read.schema("identifier string, timestamp timestamp, metric double").parquet(buckets)
    assert rows(found.select("identifier", "timestamp", "metric")) == [
        ("i", datetime(2000, 1, 1), 4.0),
        ("i", datetime(2000, 2, 1), 2.0),
    ]
