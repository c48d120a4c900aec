"""Plans have the shape that holds at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

from demandlake.operators.bucket import bucket
from demandlake.operators.clean import clean_input
from demandlake.operators.consolidate import to_wide
from demandlake.operators.running import positions, slices
from demandlake.plans import history_queries as h
from demandlake.plans import tables as t
from demandlake.sources import tables
from demandlake.spec import DOMAINS


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(plan, operator):
    return len(re.findall(rf"\b{operator}\b", plan))


SAMPLING = {"poisson_counts", "poisson_calibration", "synthetic_series", "dependency_effect"}


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_products_of_rows_and_no_python_but_for_sampling(spark, sf, name):
    plan = plan_of(entry.queries()[name](spark, sf))
    assert count(plan, "CartesianProduct") == 0
    assert count(plan, "BroadcastNestedLoopJoin") == 0
    assert ("EvalPython" in plan or "InPandas" in plan) == (name in SAMPLING)


def test_bucketing_shuffles_once_and_combines_first(spark, sf):
    plan = plan_of(bucket(t.demand(spark, sf), "W", ["location"]))
    assert count(plan, "Exchange") == 1
    assert "partial_sum" in plan
    assert "WindowGroupLimit" not in plan and count(plan, "Sort") == 0
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan


def test_bucketing_without_dimensions_reads_fewer_columns(spark, sf):
    assert "l_returnflag" not in plan_of(bucket(t.demand(spark, sf), "D"))


def test_cleaning_needs_no_shuffle(spark, sf):
    plan = plan_of(clean_input(t.dirty_demand(spark, sf), t.TARGET_SPEC))
    assert count(plan, "Exchange") == 0


def test_filters_reach_the_scan_through_the_bucketing(spark, sf):
    df = bucket(t.demand(spark, sf), "D", ["location"]).where(F.col("location") == "A")
    assert "EqualTo(l_returnflag,A)" in plan_of(df)


def test_cutoff_is_computed_inside_the_job(spark, sf):
    plan = plan_of(entry.queries()["history_cutoff"](spark, sf))
    assert "subquery" in plan.lower()
    assert count(plan, "SortMergeJoin") + count(plan, "BroadcastHashJoin") == 0


def test_gap_filling_reads_the_history_once(spark, sf):
    from demandlake.operators.history import fill_gaps

    plan = plan_of(fill_gaps(bucket(t.demand(spark, sf), "M"), ["identifier"], "M", middle="median"))
    assert count(plan, "FileScan") == 1
    assert "Join" not in plan


@pytest.mark.parametrize("name", ["gapfill_zero", "gapfill_median", "gapfill_future", "backtest_split"])
def test_first_and_last_period_need_no_second_grouping(spark, sf, name):
    plan = plan_of(entry.queries()[name](spark, sf))
    # one to bucket the history, one to bring a series together where the buckets had its location too
    assert plan.count("hashpartitioning") <= (1 if name == "backtest_split" else 2)


def test_cutoff_looks_at_rows_with_their_duplicates(spark, sf):
    from demandlake.operators.consolidate import cut_history

    history = bucket(t.demand(spark, sf), "W", ["location"])
    backtest = t.demand(spark, sf).select("timestamp", "metric")
    plan = plan_of(cut_history(history, backtest))
    assert plan.count("hashpartitioning") == 1  # the bucketing itself


def shares(df):
    """Rows of each slice of a frame sorted into slices."""
    return [r["count"] for r in df.groupBy("_part.slice").count().collect()]


@pytest.mark.parametrize("moments", [40_000, 1])
def test_one_key_spreads_over_slices(spark, moments):
    """One key for all rows, and even one moment: no task gets more than twice the median."""
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    df = spark.range(40_000).select(F.lit("all").alias("key"), (F.col("id") % moments).alias("moment"), "id")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        held = shares(slices(df, ["key"], [F.col("moment").desc()]))
        ranked = positions(df, ["key"], [F.col("moment").desc()])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(held) == 8 and sum(held) == 40_000
    assert max(held) <= 2 * sorted(held)[4]
    numbers = ranked.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()
    assert tuple(numbers) == (1, 40_000, 40_000)
    assert ranked.where(F.col("position") == 1).first()["moment"] == moments - 1


@pytest.mark.parametrize("name", ["run_history", "cumulative"])
def test_sliced_rows_move_once_more_at_most(spark, sf, name):
    """With a sort-merge join, as for counts too large to broadcast: one partitioning of the slices' rows."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(entry.queries()[name](spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    above_the_join = plan[: plan.index("SortMergeJoin")]
    assert count(above_the_join, "Exchange") == 0
    # the rows, their counts per slice and key, and those counts by key
    assert plan.count("hashpartitioning") <= 4 and count(plan, "rangepartitioning") == 0


def test_baseline_reads_the_history_once(spark, sf):
    plan = plan_of(entry.queries()["baseline_forecast"](spark, sf))
    assert count(plan, "FileScan") == 1
    assert "Join" not in plan


def test_totals_of_all_domains_are_computed_once(spark, sf):
    df = entry.queries()["domain_normalize"](spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert count(final, "ReusedExchange") == 6


def test_domains_are_not_read_by_one_task_together(spark, sf):
    """Each domain has tasks of its own, which read the totals once."""
    assert entry.queries()["domain_normalize"](spark, sf).rdd.getNumPartitions() >= len(DOMAINS)


def test_a_large_part_is_not_written_by_one_task(spark, sf, monkeypatch):
    """Lines of a delivery are never gathered in one task."""
    gathered, frame = [], type(spark.range(1))
    coalesce = frame.coalesce
    monkeypatch.setattr(frame, "coalesce", lambda self, n: gathered.append(self.columns) or coalesce(self, n))
    assert entry.queries()["signatures_kept"](spark, sf).count() == 2
    assert not [columns for columns in gathered if "demand" in columns]


def test_series_and_factors_meet_by_two_numbers(spark, sf):
    """With a sort-merge join: its keys are the number of a seasonality and the piece of the calendar."""
    from demandlake.plans.generation import expected_series
    from demandlake.plans.generator_queries import LENGTH, START, models

    big = F.col("rate") > 25
    plain = models(spark, sf)
    two = plain.withColumn("hourly", F.when(big, F.reverse("hourly")).otherwise(F.col("hourly")))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(expected_series(two, START, LENGTH, "H"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joins = re.findall(r"SortMergeJoin \[(.*?)\], \[(.*?)\]", plan)
    assert [re.sub(r"#\d+L?", "", left) for left, _ in joins] == ["_profile, _from"]
    assert not re.search(r"hashpartitioning\([^)]*hourly", plan)

    def rates(df):
        return expected_series(df, START, 30, "H").agg(F.sum("rate_at"), F.sum(F.col("rate_at") * F.col("period"))).first()

    turned = plain.withColumn("hourly", F.reverse("hourly"))
    apart = [rates(plain.where(~big)), rates(turned.where(big))]
    assert [round(x, 3) for x in rates(two)] == [round(a + b, 3) for a, b in zip(*apart, strict=True)]


def test_columns_without_values_are_neither_shuffled_nor_sorted(spark, sf):
    """A sorter that holds rows of 125 columns takes a kilobyte a row, nearly all of it nulls."""
    laid_out = tables._laid_out(h.consolidated(spark, sf, wide=False), ("identifier", "dimension_2", "timestamp"), to_wide)
    assert laid_out.columns == h.consolidated(spark, sf).columns and len(laid_out.columns) == 124

    def nodes(plan):
        below = plan.children()
        return [plan, *(n for i in range(below.size()) for n in nodes(below.apply(i)))]

    found = nodes(laid_out._jdf.queryExecution().optimizedPlan())
    widths = [n.output().size() for n in found if n.nodeName() in ("Sort", "RebalancePartitions")]
    assert len(widths) == 2 and max(widths) < 20


def test_lines_of_orders_are_shuffled_once(spark, sf):
    """Not once as lines and once as the lines after them, and neither side is broadcast."""
    for name in ("dependency_effect", "synthetic_series", "unmatched_dependencies"):
        plan = plan_of(entry.queries()[name](spark, sf))
        assert len(re.findall(r"hashpartitioning\(l_orderkey", plan)) == 1
        assert not re.search(r"Join \[l_orderkey", plan)


def test_effects_are_shuffled_by_span(spark, sf):
    """A row per link and span, not one per link and period."""
    for name in ("dependency_effect", "synthetic_series"):
        found = re.findall(r"hashpartitioning\((name#\w+, dimensions#\w+.*?), \d+\)", plan_of(entry.queries()[name](spark, sf)))
        assert len(found) == 3 and all("_span" in keys and "period" not in keys for keys in found)


def test_next_lines_are_those_of_the_number_after(spark):
    from demandlake.plans.generator_queries import _next_lines

    numbers = [1, 2, 3, 5, 6, 6, 7, 62, 63, 64, 65, 127, 128, 130, 192, None]
    lines = [(order, n, 100 * order + i, "A", 0.5, i % 2) for order in (1, 2) for i, n in enumerate(numbers)] + [(None, 1, 7, "A", 0.5, 0), (None, 2, 8, "A", 0.5, 0)]
    line = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_discount double, kind int")
    pairs = [(a, b) for a in lines for b in lines if a[0] == b[0] is not None and None not in (a[1], b[1]) and a[1] + 1 == b[1]]
    for alike in ([], ["kind"]):
        expected = sorted((a[2], b[2]) for a, b in pairs if not alike or a[5] == b[5])
        found = _next_lines(line, len(lines), *alike).select("l_partkey", "dependency").collect()
        assert sorted(map(tuple, found)) == expected and expected
