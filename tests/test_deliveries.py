"""Deliveries: what differs is read, the newest replaces, repeats change nothing."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from demandlake.spec import ITEM_METADATA, RELATED_TIME_SERIES, TARGET_TIME_SERIES, DatasetSpec
from demandlake.streaming import deliveries
from demandlake.streaming.deliveries import Intake, current_buckets, current_datasets, current_rows, take_in

from conftest import rows

SPECS = {
    TARGET_TIME_SERIES: DatasetSpec.of("RETAIL", item_id="string", timestamp="timestamp", location="string", demand="float"),
    RELATED_TIME_SERIES: DatasetSpec.of("RETAIL", item_id="string", timestamp="timestamp", price="float"),
    ITEM_METADATA: DatasetSpec.of("RETAIL", **dict.fromkeys(("item_id", "color", "size", "shape", "weight"), "string")),
}


class Place:
    """A folder that files arrive in; each file is given a later time than those before."""

    def __init__(self, spark, path, monkeypatch, **more):
        self.spark, self.folder, self.clock, self.read = spark, path / "train", 1_000_000_000, []
        self.folder.mkdir()
        self.intake = Intake(str(self.folder), str(path / "store"), SPECS, "D", ["location"], **more)
        self.store = path / "store"
        plain = deliveries.stage

        def counted(spark, intake, paths):
            self.read.append(sorted(p.split("/train/")[1] for p in paths))
            return plain(spark, intake, paths)

        monkeypatch.setattr(deliveries, "stage", counted)

    def put(self, name, *lines):
        path = self.folder / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
        self.clock += 100
        os.utime(path, (self.clock, self.clock))

    def run(self):
        """Paths read by a run, one list per staging, and the version after it."""
        self.read.clear()
        version = take_in(self.spark, self.intake)
        return list(self.read), version

    def buckets(self):
        return rows(current_buckets(self.spark, self.intake).select("group", "identifier", "timestamp", "metric"))

    def rows(self, kind):
        return rows(current_rows(self.spark, self.intake, kind))


@pytest.fixture
def place(spark, tmp_path, monkeypatch):
    return Place(spark, tmp_path, monkeypatch)


def test_overwritten_files_replace_and_untouched_ones_are_not_read(place):
    place.put("demand.csv", "item_id,timestamp,location,demand", "i,2000-01-05,x,1", "i,2000-02-05,x,2", "i,bad,x,9")
    place.put("other.csv", "i,2000-01-05,x,100")
    assert place.run() == ([["demand.csv", "other.csv"]], 1)
    other = ("other", "i", datetime(2000, 1, 5), 100.0)
    assert place.buckets() == [("demand", "i", datetime(2000, 1, 5), 1.0), ("demand", "i", datetime(2000, 2, 5), 2.0), other]
    assert place.run() == ([], 1)
    place.put("demand.csv", "timestamp,item_id,location,demand", "i,2000-01-05,x,7")
    assert place.run() == ([["demand.csv"]], 2)
    assert place.buckets() == [("demand", "i", datetime(2000, 1, 5), 7.0), other]
    assert place.run() == ([], 2)


def test_the_same_content_again_changes_nothing(place):
    place.put("demand.csv", "i,2000-01-05,x,1", "j,2000-01-05,x,2")
    place.run()
    before = current_datasets(place.spark, place.intake).first()
    place.put("demand.csv", "j,2000-01-05,x,2", "i,2000-01-05,x,1")
    assert place.run() == ([["demand.csv"]], 2)
    after = current_datasets(place.spark, place.intake).first()
    assert (after["stored"], after["changed"], after["signature"]) == (before["stored"], before["changed"], before["signature"])
    assert after["modified"] > before["modified"]
    assert len(place.buckets()) == 2


def test_the_newest_delivery_is_the_dataset(place):
    place.put("demand.1.csv", "i,2000-01-05,x,1")
    place.put("demand.2.csv", "i,2000-01-06,x,2")
    # the older one is not needed
    assert place.run() == ([["demand.2.csv"]], 1)
    assert place.buckets() == [("demand", "i", datetime(2000, 1, 6), 2.0)]
    place.put("demand.1.csv", "i,2000-01-07,x,3")
    assert place.run() == ([["demand.1.csv"]], 2)
    assert place.buckets() == [("demand", "i", datetime(2000, 1, 7), 3.0)]
    (place.folder / "demand.1.csv").unlink()
    # what is left is older than what was there
    assert place.run() == ([], 2)
    assert place.buckets() == [("demand", "i", datetime(2000, 1, 7), 3.0)]


def test_parts_of_a_delivery_are_read_by_themselves(place):
    for i in range(3):
        place.put(f"demand.csv/part-{i}.csv", "item_id,timestamp,location,demand", f"i{i},2000-01-05,x,{i}")
    assert place.run()[0] == [[f"demand.csv/part-{i}.csv" for i in range(3)]]
    place.put("demand.csv/part-1.csv", "i1,2000-01-05,x,10")
    assert place.run() == ([["demand.csv/part-1.csv"]], 2)
    assert [r[3] for r in place.buckets()] == [0.0, 10.0, 2.0]
    # parts that change places have the same lines together, and are still told apart afterwards
    place.put("demand.csv/part-0.csv", "i2,2000-01-05,x,2")
    place.put("demand.csv/part-2.csv", "i0,2000-01-05,x,0")
    place.run()
    assert [r[3] for r in place.buckets()] == [0.0, 10.0, 2.0]
    place.put("demand.csv/part-0.csv", "i2,2000-01-05,x,20")
    assert place.run()[0] == [["demand.csv/part-0.csv"]]
    assert [r[1:4:2] for r in place.buckets()] == [("i0", 0.0), ("i1", 10.0), ("i2", 20.0)]
    (place.folder / "demand.csv" / "part-1.csv").unlink()
    assert place.run()[0] == []
    assert [r[1:4:2] for r in place.buckets()] == [("i0", 0.0), ("i2", 20.0)]
    place.put("demand.csv/part-7.csv", "i7,2000-01-05,x,7")
    assert place.run()[0] == [["demand.csv/part-7.csv"]]
    assert len(place.buckets()) == 3


def test_two_groups_and_three_types_are_parsed_once(place):
    for group in ("a", "b"):
        place.put(f"{group}.csv", "item_id,timestamp,location,demand", f"{group},2000-01-05,x,1", f"{group},2000-01-05,y,2")
        place.put(f"{group}.related.csv", f"{group},2000-01-05,9.5", f"{group},bad,1", f"{group},2000-01-06,")
        place.put(f"{group}.metadata.csv", "color,item_id,size,shape,weight", f"{group},red,small,round,heavy", ",red,small,round,heavy")
    read, version = place.run()
    assert [len(paths) for paths in read] == [6] and version == 1
    assert place.rows(TARGET_TIME_SERIES)[0] == ("a", "a", datetime(2000, 1, 5), "x", 1.0)
    assert place.rows(RELATED_TIME_SERIES) == [(g, g, datetime(2000, 1, 5), 9.5) for g in "ab"]
    assert place.rows(ITEM_METADATA) == [(g, g, "red", "small", "round", "heavy") for g in "ab"]
    staged = place.spark.createDataFrame([], "_c0 string, _c1 string, _c2 string, _c3 string, _c4 string, file string, line long, dataset_type string, group string")
    plan = deliveries.cleaned_rows(staged, [], place.intake)._jdf.queryExecution().optimizedPlan().toString()
    assert "csv" not in plan.lower()


def test_each_file_has_its_own_header(place):
    # only one of two has a header; a third names some fields, and the lines below it tell
    place.put("demand.csv/a.csv", "item_id,timestamp,location,demand", "i,2000-01-05,x,1")
    place.put("demand.csv/b.csv", "j,2000-01-05,x,2", "item_id,2000-01-05,x,4")
    place.put("stuff.metadata.csv/a.csv", "item_id,color,size,shape,weight", "i,red,1,2,3")
    place.put("stuff.metadata.csv/b.csv", "j,blue,4,5,6", "item_id,color,size,shape,weight")
    place.put("part.metadata.csv", "item_id,colour,size,shape,mass", *[f"i{n},red,{n},22,333" for n in range(20)])
    place.run()
    assert [r[1] for r in place.buckets()] == ["i", "item_id", "j"]
    found = place.rows(ITEM_METADATA)
    assert [r[1] for r in found if r[0] == "stuff"] == ["i", "item_id", "j"]  # a line below the first is data
    assert [r[1] for r in found if r[0] == "part"] == sorted(f"i{n}" for n in range(20))


def test_first_lines_are_found_without_a_shuffle_of_lines(place, tmp_path, monkeypatch):
    """Lines are joined with a table of known size, which holds a row per file."""
    for name in ("demand.csv", "other.csv"):
        place.put(name, *[f"item {i},2020-01-01 00:00:00,A,{i}" for i in range(1000)])
    staged = deliveries.stage(place.spark, place.intake, [str(place.folder / name) for name in ("demand.csv", "other.csv")])
    plans, join = [], DataFrame.join

    def watched(self, *more, **named):
        joined = join(self, *more, **named)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(type(staged), "join", watched)
    assert deliveries.header_lines(staged, place.intake) == []
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0] and "hashpartitioning" not in plans[0]


def test_a_failed_run_is_not_seen_and_repeated(place, monkeypatch):
    place.put("demand.csv", "i,2000-01-05,x,1")
    place.run()
    place.put("demand.csv", "i,2000-01-05,x,2", "i,2000-01-06,x,3")
    for step in ("_store", "_bucket", "_pointers"):
        with monkeypatch.context() as broken:
            broken.setattr(deliveries, step, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                place.run()
        assert place.buckets() == [("demand", "i", datetime(2000, 1, 5), 1.0)]
    assert place.run()[1] == 2
    assert [r[3] for r in place.buckets()] == [2.0, 3.0]


def test_stored_files_do_not_grow_with_runs(place):
    def files():
        return sum(1 for p in place.store.rglob("*.parquet") if "/published/" not in str(p))

    place.put("still.csv", "i,2000-01-05,x,1")
    sizes = []
    for i in range(6):
        place.put("demand.csv", f"i,2000-01-05,x,{i}")
        place.put("demand.related.csv", f"i,2000-01-05,{i}")
        place.run()
        sizes.append(files())
        assert [r[3] for r in place.buckets()] == [float(i), 1.0]
    assert sizes[3] == sizes[4] == sizes[5]


def test_groups_settings_and_empty_datasets(spark, tmp_path, monkeypatch):
    place = Place(spark, tmp_path, monkeypatch, settings={"wide": ("M", [])}, groups=["wide", "plain", "none"])
    place.put("wide.csv", "i,2000-01-05,x,1", "i,2000-01-09,y,2")
    place.put("plain.csv", "i,2000-01-05,x,1", "i,2000-01-09,y,2")
    place.put("none.csv", "item_id,timestamp,location,demand")
    place.put("passed.csv", "i,2000-01-05,x,1")
    place.run()
    found = rows(current_buckets(spark, place.intake).select("group", "location", "timestamp", "metric"))
    assert found == [
        ("plain", "x", datetime(2000, 1, 5), 1.0),
        ("plain", "y", datetime(2000, 1, 9), 2.0),
        ("wide", None, datetime(2000, 1, 1), 3.0),
    ]
    assert current_datasets(spark, place.intake).count() == 3
    place.put("none.csv", "i,2000-01-05,x,5")
    place.run()
    assert current_buckets(spark, place.intake).where(F.col("group") == "none").count() == 1
    clash = Intake("", "", SPECS | {RELATED_TIME_SERIES: DatasetSpec.of("RETAIL", item_id="string", color="float")}, "D")
    with pytest.raises(ValueError, match="color"):
        clash.row_schema
