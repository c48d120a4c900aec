"""Run state: keyed upserts and the decisions read from them."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from demandlake.operators.manifest import added_sums, content_signature, content_sums, with_default_types
from demandlake.spec import ITEM_METADATA, TARGET_TIME_SERIES
from demandlake.streaming import run_state
from demandlake.streaming.run_state import RunState, upsert

from conftest import rows

START = datetime(2000, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


def test_upserts_keep_the_newest_row_of_a_key(spark):
    schema = "key string, modified timestamp, value int"
    stored = spark.createDataFrame([("a", at(1), 1), ("b", at(5), 2), ("c", None, 3)], schema)
    changes = spark.createDataFrame([("a", at(1), 10), ("b", at(4), 20), ("c", at(0), 30), ("d", at(0), 40), ("d", at(1), 41)], schema)
    want = [("a", at(1), 10), ("b", at(5), 2), ("c", at(0), 30), ("d", at(1), 41)]
    assert rows(upsert(stored, changes, ["key"])) == want
    assert rows(upsert(upsert(stored, changes, ["key"]), changes, ["key"])) == want


def test_decisions_follow_what_is_recorded(spark, tmp_path):
    state = RunState(spark, str(tmp_path / "state"))
    assert state.decisions(F.lit(at(0))).count() == 0

    def datasets(*names, hours, status="ACTIVE"):
        return spark.createDataFrame([(n, n.split("_")[0], None, status, at(hours)) for n in names], run_state.DATASETS)

    def run(kind, name, parent, group, hours, predictor=None, status="ACTIVE"):
        return spark.createDataFrame([(kind, name, parent, group, predictor, status, at(hours), at(hours), None)], run_state.RUNS)

    def decided(now, configured=None, max_age=3600):
        found = state.decisions(F.lit(at(now)), max_age, configured)
        return {r["group"]: (r["ready"], r["train_reason"], r["forecast"]) for r in found.collect()}

    state.apply(datasets("a", "b", hours=0), run("import", "i1", "a", "a", 0))
    assert decided(1) == {"a": (True, "no predictor", "no predictor"), "b": (False, "no predictor", "no predictor")}
    needs = spark.createDataFrame([("a", TARGET_TIME_SERIES), ("a", ITEM_METADATA), ("c", TARGET_TIME_SERIES)], "group string, dataset_type string")
    assert {g: d[0] for g, d in decided(1, needs).items()} == {"a": False, "b": False, "c": False}
    state.apply(runs=run("import", "i2", "b", "b", 1).unionByName(run("predictor", "p1", "a", "a", 1)))
    assert decided(2) == {"a": (True, "up to date", "no forecast"), "b": (True, "no predictor", "no predictor")}
    state.apply(runs=run("forecast", "f1", "a", "a", 2, "p1").unionByName(run("predictor", "p2", "b", "b", 2, status="CREATE_FAILED")))
    assert decided(3) == {"a": (True, "up to date", "fresh"), "b": (True, "last predictor failed", "no predictor")}
    state.apply(datasets("a", hours=4))
    assert decided(4)["a"] == (True, "too old for changed data", "data changed")
    assert decided(4, max_age=4 * 3600)["a"][1] == "up to date"
    state.apply(runs=run("predictor", "p3", "a", "a", 5))
    assert decided(6)["a"] == (True, "up to date", "other predictor")
    # an update of a run that is older than what is known changes nothing
    state.apply(runs=run("predictor", "p3", "a", "a", 4, status="CREATE_FAILED"))
    assert decided(6)["a"][1] == "up to date"
    assert state.runs().count() == 6 and state.datasets().count() == 2


def test_signatures_of_files_add_up(spark):
    lines = [("one", f"x{i}", f"line {i % 7}") for i in range(50)] + [("two", "y", "line")]
    df = spark.createDataFrame(lines, "dataset string, file string, value string")
    whole = content_signature(df, ["dataset"])
    kept = content_sums(df, ["dataset", "file"])
    assert rows(added_sums(kept, ["dataset"]).select("dataset", "signature")) == rows(whole)


def test_groups_without_configuration_need_a_target_series(spark):
    groups = spark.createDataFrame([("a",), ("b",), ("b",)], "group string")
    configured = spark.createDataFrame([("a", ITEM_METADATA)], "group string, dataset_type string")
    assert rows(with_default_types(groups, configured)) == [("a", ITEM_METADATA), ("b", TARGET_TIME_SERIES)]
