"""Rates, seasonality, sampling, dependencies and output of the generator."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandlake.functions.sampling import (
    _log_factorial,
    binomial,
    binomial_quantiles,
    binomials,
    normal,
    poisson,
    poisson_quantiles,
    uniform,
)
from demandlake.operators import generator as g
from demandlake.plans.generation import check_models, expected_series, generate, write_generated

from conftest import rows

START = "2000-01-01"
NIGHT = [0.0] * 6 + [0.5] * 3 + [1.0] * 12 + [0.25] * 3
WEEKEND = [1.0, 1.0, 0.75, 1.0, 1.25, 2.0, 0.5]
HOLIDAY = [0.75, 1.0, 1.0, 1.0, 1.25, 1.5, 1.5, 1.0, 1.0, 1.0, 1.5, 3.0]


def model(name="m", rate=1440.0, per="D", dimensions=None, metadata=None, hourly=None, daily=None, monthly=None):
    return (name, rate, per, dimensions or {}, metadata or [], hourly, daily, monthly)


def models(spark, *specs):
    return spark.createDataFrame(list(specs), g.MODEL_SCHEMA)


def complete(spark, *specs):
    return g.fill_dimensions(models(spark, *specs), [])


def dependencies(spark, *links):
    return spark.createDataFrame(list(links), g.DEPENDENCY_SCHEMA)


def plain_dependencies(spark, *links):
    return g.fill_dimensions(dependencies(spark, *links), [])


# -- sampling -------------------------------------------------------------------------------


def test_draws_do_not_depend_on_the_layout(spark):
    def total(partitions):
        df = spark.range(5000).repartition(partitions)
        return rows(df.select("id", poisson(F.lit(7.5), 42, "id").alias("n"), uniform(42, "id")))

    assert total(1) == total(7)


def test_normal_moments(spark):
    row = spark.range(50_000).select(normal(F.lit(5.0), F.lit(2.0), 1, "id").alias("x")).agg(F.avg("x"), F.stddev("x")).first()
    assert math.isclose(row[0], 5.0, abs_tol=0.05)
    assert math.isclose(row[1], 2.0, rel_tol=0.02)


def probabilities(draw, size=200_000):
    """Share of evenly spread uniforms that give each count, which is its probability."""
    u = (np.arange(size) + 0.5) / size
    values, counts = np.unique(draw(u), return_counts=True)
    return dict(zip(values.tolist(), (counts / size).tolist()))


@pytest.mark.parametrize("rate", [0.01, 0.7, 1.0, 4.2, 33.0])
def test_poisson_probabilities(rate):
    found = probabilities(lambda u: poisson_quantiles(u, np.full(u.size, rate)))
    for k in range(int(rate + 6 * math.sqrt(rate)) + 2):
        exact = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        assert abs(found.get(k, 0.0) - exact) < 2e-5


@pytest.mark.parametrize("trials,chance", [(1, 0.5), (10, 0.3), (10, 0.99), (40, 0.01)])
def test_binomial_probabilities(trials, chance):
    found = probabilities(lambda u: binomial_quantiles(u, np.full(u.size, trials), np.full(u.size, chance)))
    for k in range(trials + 1):
        exact = math.comb(trials, k) * chance**k * (1 - chance) ** (trials - k)
        assert abs(found.get(k, 0.0) - exact) < 2e-5
    assert max(found) <= trials and min(found) >= 0


def test_edges_of_the_distributions():
    u = np.array([1e-17, 0.3, 1 - 1e-16])
    assert poisson_quantiles(u, np.zeros(3)).tolist() == [0, 0, 0]
    assert poisson_quantiles(u, np.full(3, -1.0)).tolist() == [0, 0, 0]
    assert (poisson_quantiles(u, np.full(3, 1e6)) > 9e5).all()
    assert binomial_quantiles(u, np.full(3, 5), np.array([0.0, 1.0, 2.0])).tolist() == [0, 5, 5]
    assert binomial_quantiles(u, np.zeros(3), np.full(3, 0.5)).tolist() == [0, 0, 0]


# -- rates ----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "rate,per,output,expected",
    [
        (1440.0, "D", "D", 1440.0),
        (1440.0, "D", "W", 10080.0),
        (60.0, "H", "5min", 5.0),
        (31.0, "M", "D", 1.0),
        (366.0, "Y", "M", 31.0),
    ],
)
def test_base_rate(spark, rate, per, output, expected):
    assert math.isclose(g.base_rate(models(spark, model(rate=rate, per=per)), START, output).first().base_rate, expected)


def test_unknown_frequency_fails(spark):
    with pytest.raises(Exception, match="30s"):
        g.base_rate(models(spark, model(per="30s")), START, "D").collect()


def factor_by_hand(start, minutes):
    """Mean over the single minutes of the span."""
    total = 0.0
    for i in range(minutes):
        moment = start + timedelta(minutes=i)
        total += NIGHT[moment.hour] * WEEKEND[moment.weekday()] * HOLIDAY[moment.month - 1]
    return total / minutes


@pytest.mark.parametrize(
    "start,output,length",
    [
        ("2000-11-28", "D", 8),
        ("2000-11-28 07:30:00", "H", 20),
        ("2000-11-28 07:20:00", "D", 5),
        ("2000-01-03", "5min", 300),
        ("2000-11-15", "M", 3),
        ("2000-02-27", "W", 3),
    ],
)
def test_seasonal_rate(spark, start, output, length):
    spec = models(spark, model(hourly=NIGHT, daily=WEEKEND, monthly=HOLIDAY))
    origin = datetime.fromisoformat(start)
    found = expected_series(spec, start, length, output).orderBy("period").collect()
    assert [r.period for r in found] == list(range(length))
    for row in found:
        minutes = round(row.bucket_minutes)
        expected = factor_by_hand(origin + timedelta(minutes=minutes * row.period), minutes)
        assert math.isclose(row.rate_at, row.base_rate * expected, rel_tol=1e-9, abs_tol=1e-9)


def test_calendar_dates(spark):
    dated = g.series_calendar(models(spark, model("a"), model("b")), "2000-01-31", 3, "M")
    assert rows(dated.select("name", "period", "timestamp"), "name", "period")[:3] == [
        ("a", 0, datetime(2000, 1, 31)),
        ("a", 1, datetime(2000, 2, 29)),
        ("a", 2, datetime(2000, 3, 31)),
    ]
    assert dated.count() == 6


def test_weekly_counts_are_near_their_rate(spark):
    row = generate(models(spark, model()), None, [], START, 1, "W").first()
    assert math.isclose(row["count"], 10080, rel_tol=0.05)


def test_metadata_changes_the_rate_within_its_bounds(spark):
    spec = complete(spark, model(metadata=[("a", "b", 5.0, 10.0)]))
    dated = g.series_calendar(spec, START, 2000, "D")
    draws = [r[0] for r in dated.select(g.metadata_multiplier(1)).collect()]
    inside = sum(5.0 < d < 10.0 for d in draws)
    assert inside >= 0.99 * len(draws)
    assert math.isclose(sum(draws) / len(draws), 7.5, rel_tol=0.02)
    assert len(set(draws)) == len(draws)


def test_equal_or_missing_bounds_are_exact(spark):
    spec = complete(spark, model(metadata=[("a", "x", 2.0, 2.0), ("b", "y", 3.0, 3.0), ("c", "z", None, None)]))
    assert g.series_calendar(spec, START, 1, "D").select(g.metadata_multiplier(1)).first()[0] == 6.0


@pytest.mark.parametrize("low,high", [(10.0, 1.0), (10.0, 9.0), (0.0, 1.0), (1.0, 0.0)])
def test_bad_bounds_fail(spark, low, high):
    spec = complete(spark, model(metadata=[("a", "b", low, high)]))
    with pytest.raises(Exception, match="bounds"):
        g.series_calendar(spec, START, 1, "D").select(g.metadata_multiplier(1)).collect()
    with pytest.raises(ValueError, match="bounds"):
        check_models(spec)


# -- dependencies ---------------------------------------------------------------------------


STORES = "struct<city:string,store:string>"


def counted(spark, *series):
    return spark.createDataFrame(
        [(name, dims, p, c) for name, dims, counts in series for p, c in enumerate(counts)],
        f"name string, dimensions {STORES}, period int, count bigint",
    )


def settled(spark, counts, *links, length=600):
    known = counts.select("name", "dimensions").distinct()
    linked = spark.createDataFrame(
        list(links), f"name string, dimensions {STORES}, dependency string, chance double"
    )
    result = {}
    for r in g.apply_dependencies(counts, known, linked, length, 42).orderBy("period").collect():
        result.setdefault((r.name, tuple(r.dimensions)), []).append(r["count"])
    return result


HERE, THERE = ("y", "x"), ("z", "x")


def test_certain_dependencies(spark):
    counts = counted(spark, ("a", HERE, [1, 2, 3]), ("b", HERE, [10, 0, 2]), ("c", HERE, [5, 5, 5]))
    found = settled(spark, counts, ("a", HERE, "b", 1.0), ("c", HERE, "b", -0.25))
    assert found == {("a", HERE): [11, 2, 5], ("b", HERE): [10, 0, 2], ("c", HERE): [0, 5, 3]}


def test_effects_use_counts_from_before(spark):
    counts = counted(spark, ("a", HERE, [1]), ("b", HERE, [2]), ("c", HERE, [4]))
    found = settled(spark, counts, ("a", HERE, "b", 1.0), ("b", HERE, "c", 1.0), ("c", HERE, "a", 1.0))
    assert found == {("a", HERE): [3], ("b", HERE): [6], ("c", HERE): [5]}


def test_only_equal_dimensions_influence(spark):
    counts = counted(spark, ("a", HERE, [1]), ("b", HERE, [2]), ("b", THERE, [100]))
    assert settled(spark, counts, ("a", HERE, "b", 1.0))["a", HERE] == [3]


def test_chance_changes_only_the_dependent_series(spark):
    counts = counted(spark, ("a", HERE, [15] * 500), ("b", HERE, [10] * 500))
    found = settled(spark, counts, ("a", HERE, "b", 0.5))
    assert found["b", HERE] == [10] * 500
    gained = sum(found["a", HERE]) - 15 * 500
    assert math.isclose(gained, 2500, rel_tol=0.05)
    assert all(15 <= c <= 25 for c in found["a", HERE])


def test_many_dependents_on_one_series(spark):
    """A hot dependency: every series depends on the same one."""
    counts = counted(spark, *[(f"s{i}", HERE, [1, 1]) for i in range(300)])
    found = settled(spark, counts, *[(f"s{i}", HERE, "s0", 1.0) for i in range(1, 300)])
    assert found["s0", HERE] == [1, 1]
    assert all(found[f"s{i}", HERE] == [2, 2] for i in range(1, 300))


@pytest.mark.parametrize("length", [1, 63, 64, 65, 130])
def test_every_period_meets_its_own(spark, length):
    counts = counted(spark, ("a", HERE, [1] * length), ("b", HERE, list(range(length))))
    found = settled(spark, counts, ("a", HERE, "b", 1.0), length=length)
    assert found["a", HERE] == [1 + p for p in range(length)]
    assert found["b", HERE] == list(range(length))


def test_missing_periods_of_the_other_series_have_no_effect(spark):
    counts = counted(spark, ("a", HERE, [1, 1, 1]), ("b", HERE, [1]))
    assert settled(spark, counts, ("a", HERE, "b", 1.0))["a", HERE] == [2, 1, 1]


def test_draws_of_a_span_are_those_of_its_rows(spark):
    df = spark.range(300).select(
        "id", F.when(F.col("id") % 3 > 0, F.sequence(F.lit(1), (F.col("id") % 7).cast("int") + 1)).otherwise(F.array().cast("array<int>")).alias("at")
    )
    u = F.transform("at", lambda at: uniform(42, "id", at))
    trials = F.transform("at", lambda at: F.when((F.col("id") != 1) | (at != 2), at.cast("bigint") * 10))
    spans = df.select("id", F.posexplode_outer(binomials(u, trials, F.lit(0.3))).alias("at", "n"))
    single = df.select("id", F.posexplode_outer("at").alias("at", "p")).select(
        "id", "at", binomial(F.when((F.col("id") != 1) | (F.col("p") != 2), F.col("p") * 10), F.lit(0.3), 42, "id", "p").alias("n")
    )
    assert rows(spans, "id", "at") == rows(single, "id", "at")


def test_more_counts_are_dealt_to_more_tasks(spark, monkeypatch):
    """A task has the same number of rows whatever the input has."""
    monkeypatch.setattr(g, "_TASK_ROWS", 100, raising=False)
    spec = models(spark, *[model(f"s{i}", 20.0) for i in range(40)])
    links = dependencies(spark, *[(f"s{i}", {}, f"s{i + 1}", 0.5) for i in range(39)])
    few, many = (generate(spec, links, ["store"], START, length, "D") for length in (20, 100))
    assert few.count() == 800 and many.count() == 4000
    assert (few.rdd.getNumPartitions(), many.rdd.getNumPartitions()) == (8, 40)


# -- checks and output ------------------------------------------------------------------------


def test_contradictions_are_named(spark):
    with pytest.raises(ValueError, match="seasonality"):
        check_models(complete(spark, model(hourly=[1.0])))
    with pytest.raises(ValueError, match="conflicting"):
        check_models(complete(spark, model(metadata=[("a", "x", 1.0, 1.0)]), model(metadata=[("a", "y", 1.0, 1.0)])))
    with pytest.raises(ValueError, match="match"):
        check_models(complete(spark, model("a")), plain_dependencies(spark, ("a", {}, "b", 0.5)))
    with pytest.raises(ValueError, match="match"):
        check_models(complete(spark, model("a"), model("b"), model("b")), plain_dependencies(spark, ("a", {}, "b", 0.5)))
    for rate in (None, float("nan"), -1.0):
        with pytest.raises(ValueError, match="rate"):
            check_models(complete(spark, model(rate=rate)))
    for factor in (None, float("nan"), -1.0):
        with pytest.raises(ValueError, match="factor"):
            check_models(complete(spark, model(daily=[1.0] * 6 + [factor])))
    with pytest.raises(ValueError, match="twice"):
        check_models(complete(spark, model("a"), model("a")))
    for chance in (None, float("nan")):
        with pytest.raises(ValueError, match="chance"):
            check_models(complete(spark, model("a"), model("b")), plain_dependencies(spark, ("a", {}, "b", chance)))
    check_models(complete(spark, model("a"), model("b")), plain_dependencies(spark, ("a", {}, "b", 0.5)))


def test_unknown_parameters_have_no_count(spark):
    df = spark.createDataFrame([(1, 5.0, 10, 0.5), (2, None, None, 0.5), (3, float("nan"), 4, None)], "id long, rate double, n int, p double")
    drawn = rows(df.select("id", poisson(F.col("rate"), 1, "id").alias("a"), binomial(F.col("n"), F.col("p"), 1, "id").alias("b")), "id")
    assert drawn[1:] == [(2, None, None), (3, None, None)]
    assert all(v >= 0 for v in drawn[0][1:])


def test_log_factorials():
    k = np.array([0.0, 1, 2, 10, 255, 256, 1e4, 1e9])
    assert _log_factorial(k) == pytest.approx([math.lgamma(x + 1) for x in k], rel=1e-12)


def test_metadata_problems(spark):
    entries = spark.createDataFrame(
        [("i1", "a", "x"), ("i1", "a", "x"), ("i1", "b", "y"), ("i2", "a", "z"), ("i3", "a", "1"), ("i3", "a", "2"), ("i3", "b", "1")],
        "item string, attribute string, value string",
    )
    assert rows(g.metadata_conflicts(entries)) == [
        ("i2", None, "missing attribute"),
        ("i3", "a", "conflicting value"),
    ]


def test_metadata_rows_are_sorted_by_attribute(spark):
    entries = spark.createDataFrame(
        [("soap", "town", "lyon"), ("soap", "color", "green"), ("soap", "scent", "pine"),
         ("oil", "scent", "olive"), ("oil", "town", "bari"), ("oil", "color", "green")],
        "item string, attribute string, value string",
    )
    assert rows(g.metadata_rows(entries, ["town", "scent", "color"])) == [
        ("oil", "green", "olive", "bari"),
        ("soap", "green", "pine", "lyon"),
    ]


def test_series_mean_leaves_out_the_last(spark):
    counts = counted(spark, ("a", {}, [1, 2, 100]), ("b", {}, [5]))
    assert {r.name: r.mean for r in g.series_mean(counts, ["name"]).collect()} == {"a": 1.5, "b": None}


def test_duplicate_dimensions(spark):
    entries = spark.createDataFrame([("a", "store"), ("a", "store"), ("a", "city")], "name string, dimension string")
    assert rows(g.duplicate_dimensions(entries)) == [("a", "store", 2)]


def test_written_output(spark, tmp_path):
    spec = models(
        spark,
        model("soap", 60.0, dimensions={"store": "east"}, metadata=[("brand", "x", None, None)]),
        model("oil", 40.0, dimensions={"city": "lyon", "store": "east"}, metadata=[("brand", "y", None, None)]),
    )
    write_generated(
        spec, None, ["store", "city"], ["brand"], START, 10, "D", str(tmp_path / "ts"), str(tmp_path / "md")
    )
    series = spark.read.csv(str(tmp_path / "ts"))
    assert series.count() == 20
    first = series.where("_c0 = 'soap'").orderBy("_c1").first()
    assert first["_c1"] == "2000-01-01 00:00:00" and first["_c3"] == "unknown" and first["_c4"] == "east"
    assert rows(spark.read.csv(str(tmp_path / "md"))) == [("oil", "y"), ("soap", "x")]


def test_same_seed_same_series(spark):
    spec = models(spark, model("a", 20.0, hourly=NIGHT, metadata=[("k", "v", 0.5, 1.5)]), model("b", 30.0))
    links = dependencies(spark, ("a", {}, "b", 0.4))

    def run(seed, partitions):
        return rows(generate(spec.repartition(partitions), links, [], START, 50, "H", seed))

    assert run(1, 1) == run(1, 5)
    assert run(1, 1) != run(2, 1)
