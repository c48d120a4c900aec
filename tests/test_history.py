"""Gap filling, horizon, backtest windows, quantiles, running totals and ranks against brute force."""

import random
import re
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from demandlake.operators.history import backtest_split, fill_gaps, horizon, split_geolocation, to_utc
from demandlake.operators.quantiles import baseline_forecast, exact_quantiles, quantile_aggregates, quantile_name
from demandlake.operators.running import rank_newest_first, running_total

from conftest import rows

SCHEMA = "identifier string, timestamp timestamp, metric double"
START = datetime(2000, 1, 1)


def sparse_series(seed, series=4, span=60):
    """Random daily points per series, some of them null."""
    rng = random.Random(seed)
    points = []
    for s in range(series):
        days = rng.sample(range(span), rng.randint(1, span // 3))
        points += [
            (f"s{s}", START + timedelta(days=d), None if rng.random() < 0.2 else float(rng.randint(0, 20)))
            for d in days
        ]
    return points


def fill_by_hand(points, middle, front, back, future, ahead):
    series = {}
    for key, moment, value in points:
        series.setdefault(key, {})[moment] = value
    earliest = min(m for _, m, _ in points)
    latest = max(m for _, m, _ in points)
    found = []
    for key, own in series.items():
        first, last = min(own), max(own)
        known = [v for v in own.values() if v is not None]
        value = {
            "zero": 0.0,
            "none": None,
            "median": float(median(known)) if known else None,
            "max": max(known) if known else None,
        }
        day = earliest
        while day <= latest + timedelta(days=ahead):
            if day < first:
                fill, name = front, "front"
            elif day <= last:
                fill, name = middle, "history" if day in own else "middle"
            elif day <= latest:
                fill, name = back, "back"
            else:
                fill, name = future, "future"
            if fill is not None:
                seen = own.get(day)
                found.append((key, day, value[fill] if seen is None else seen, name))
            day += timedelta(days=1)
    return sorted(found, key=str)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "fills",
    [
        dict(middle="zero"),
        dict(middle="none", front="zero", back="max"),
        dict(middle="median", front="none", back="zero", future="max"),
        dict(middle="max", future="median"),
    ],
)
def test_fill_gaps(spark, seed, fills):
    points = sparse_series(seed)
    ahead = 5 if "future" in fills else 0
    found = rows(fill_gaps(spark.createDataFrame(points, SCHEMA), ["identifier"], "D", horizon=ahead, **fills))
    every = dict(dict.fromkeys(("front", "back", "future")), **fills)
    assert found == fill_by_hand(points, ahead=ahead, **every)


def test_long_gap_is_filled_in_pieces(spark):
    points = [("a", START, 1.0), ("a", START + timedelta(minutes=20_000), 2.0)]
    filled = fill_gaps(spark.createDataFrame(points, SCHEMA), ["identifier"], "1min", middle="zero")
    assert filled.count() == 20_001
    assert filled.select("timestamp").distinct().count() == 20_001
    assert filled.agg(F.sum("metric")).first()[0] == 3.0


def test_calendar_steps_fill_by_calendar(spark):
    points = [("a", datetime(2000, 1, 1), 1.0), ("a", datetime(2000, 4, 1), 2.0)]
    filled = fill_gaps(spark.createDataFrame(points, SCHEMA), ["identifier"], "M", middle="zero")
    assert [r.timestamp.month for r in filled.orderBy("timestamp").collect()] == [1, 2, 3, 4]


def test_unknown_fill_is_refused(spark):
    with pytest.raises(ValueError, match="mean"):
        fill_gaps(spark.createDataFrame([], SCHEMA), ["identifier"], "D", middle="mean")


def test_horizon(spark):
    df = spark.createDataFrame([("a", datetime(2000, 1, 1), 1.0), ("a", datetime(2000, 11, 1), 1.0)], SCHEMA)
    assert rows(horizon(df, ["identifier"], "M", 3).select("identifier", "step", "timestamp"), "step") == [
        ("a", 1, datetime(2000, 12, 1)),
        ("a", 2, datetime(2001, 1, 1)),
        ("a", 3, datetime(2001, 2, 1)),
    ]


def test_backtest_windows(spark):
    points = [("a", START + timedelta(days=d), float(d)) for d in range(10)]
    tagged = backtest_split(spark.createDataFrame(points, SCHEMA), "D", 2, windows=2, offset=3)
    parts = {(w, p): sorted(r.metric for r in tagged.collect() if (r.window, r.part) == (w, p)) for w in (1, 2) for p in ("train", "test")}
    assert parts[1, "test"] == [7, 8]
    assert parts[1, "train"] == [0, 1, 2, 3, 4, 5, 6]
    assert parts[2, "test"] == [5, 6]
    assert parts[2, "train"] == [0, 1, 2, 3, 4]


def test_offset_below_horizon_is_refused(spark):
    with pytest.raises(ValueError, match="offset"):
        backtest_split(spark.createDataFrame([], SCHEMA), "D", 5, offset=4)


def test_quantile_column_names():
    assert [quantile_name(q) for q in ("0.01", "0.10", "0.5", "0.99", "mean")] == ["p1", "p10", "p50", "p99", "mean"]
    for level in ("0", "1", "0.001"):
        with pytest.raises(ValueError):
            quantile_name(level)


def test_quantiles_interpolate_and_skip_nulls(spark):
    points = [("a", START + timedelta(days=i), v) for i, v in enumerate([1.0, 2.0, None, 4.0])]
    df = spark.createDataFrame(points, SCHEMA)
    found = quantile_aggregates(df, ["identifier"], ["0.50", "mean", "0.25"])
    assert found.columns == ["identifier", "p50", "p25", "mean"]
    assert rows(found) == [("a", 2.0, 1.5, 7 / 3)]
    assert quantile_aggregates(df, ["identifier"], ["mean"]).columns == ["identifier", "mean"]
    assert baseline_forecast(df, ["identifier"], "D", 4, ["0.50"]).count() == 4


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_like_the_aggregate(spark, seed):
    rng = random.Random(seed)
    points = [
        (rng.choice(["hot", "hot", "hot", "b", None]), START, rng.choice([None, float(rng.randint(0, 9)), rng.random(), -0.5]))
        for _ in range(500)
    ]
    points += [("one", START, 2.0), ("nulls", START, None)]
    df = spark.createDataFrame(points, SCHEMA)
    levels = ["0.01", "0.25", "0.50", "0.90", "0.99", "mean"]
    found, want = (
        {r["identifier"]: [None if v is None else round(v, 9) for v in r[1:]] for r in made(df, ["identifier"], levels).collect()}
        for made in (exact_quantiles, quantile_aggregates)
    )
    assert found == want and len(found) == 5
    assert exact_quantiles(df.limit(0), ["identifier"], levels).count() == 0


def test_exact_quantiles_of_one_group_spread(spark):
    """All rows in one group: no stage above the counts brings it together."""
    df = spark.range(20_000).select(F.lit("all").alias("identifier"), (F.col("id") * 7919 % 20_011).cast("double").alias("metric"))
    found = exact_quantiles(df, ["identifier"], ["0.50"])
    assert found.first()["p50"] == df.agg(F.percentile("metric", F.lit(0.5))).first()[0]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan
    assert not re.search(r"Window \[[^]]*\], \[identifier", plan)


def test_running_total(spark):
    points = [("a", START + timedelta(days=i), float(i)) for i in range(5)]
    totals = running_total(spark.createDataFrame(points, SCHEMA), ["identifier"])
    assert [r.cumulative for r in totals.orderBy("timestamp").collect()] == [0, 1, 3, 6, 10]


def test_running_total_over_many_slices_and_nulls(spark):
    rng = random.Random(5)
    points = [
        (rng.choice(["hot", "hot", "hot", "b", None]), START + timedelta(days=i), rng.choice([None, float(rng.randint(0, 9))]))
        for i in range(600)
    ]
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    held = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        totals = running_total(spark.createDataFrame(points, SCHEMA), ["identifier"])
        found = {(r.identifier, r.timestamp): r.cumulative for r in totals.collect()}
    finally:
        spark.conf.set(conf, held)
    expected, sums = {}, {}
    for key, moment, value in points:
        if value is not None:
            sums[key] = sums.get(key, 0.0) + value
        expected[key, moment] = sums.get(key)
    assert found == expected
    assert running_total(spark.createDataFrame([], SCHEMA), ["identifier"]).count() == 0


def test_slices_are_bounded_however_few_tasks_there_are(spark, monkeypatch):
    """Slices of 64 rows at most: more of them than tasks, which are then raised in number; totals and ranks stay."""
    from demandlake.operators import running

    monkeypatch.setattr(running, "_ROW_BITS", 6)
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("k"), F.col("id").alias("timestamp"), F.lit(1).alias("metric"))
    sliced = running.slices(df, ["k"], [F.col("timestamp").asc()])
    assert sliced.groupBy("_part.slice").count().agg(F.max("count")).first()[0] == 64
    assert running._dealt(sliced).rdd.getNumPartitions() == 79
    totals = running.running_total(df, ["k"]).join(running.positions(df, ["k"], [F.col("timestamp").asc()]), ["k", "timestamp"])
    assert totals.where("cumulative = position").count() == 5000
    assert totals.select("k", "position").distinct().count() == 5000


@pytest.mark.parametrize("seed", [3, 4])
def test_rank_with_a_hot_key_ties_and_nulls(spark, seed):
    rng = random.Random(seed)
    runs = [
        (
            rng.choice(["hot", "hot", "b", None]),
            None if rng.random() < 0.05 else START + timedelta(seconds=rng.randint(0, 10) * rng.choice([5, 400, 30_000])),
            i,
        )
        for i in range(400)
    ]
    df = spark.createDataFrame(runs, "parent string, modified timestamp, run int")
    ranked = {r.run: r.position for r in rank_newest_first(df, ["parent"], "modified", "run").collect()}
    expected = {}
    for parent in {r[0] for r in runs}:
        own = sorted(
            (r for r in runs if r[0] == parent), key=lambda r: (r[1] is not None, r[1] or START, r[2]), reverse=True
        )
        expected |= {r[2]: i for i, r in enumerate(own, start=1)}
    assert ranked == expected


def test_local_time_to_utc(spark):
    df = spark.createDataFrame([(datetime(2000, 7, 1, 12),), (datetime(2000, 1, 1, 12),)], "t timestamp")
    assert [r.t for r in to_utc(df, "t", "America/New_York").orderBy("t").collect()] == [
        datetime(2000, 1, 1, 17),
        datetime(2000, 7, 1, 16),
    ]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("47.61_-122.33", (47.61, -122.33)),
        ("-90_180", (-90.0, 180.0)),
        ("91_0", (None, 0.0)),
        ("0_181", (0.0, None)),
        ("47.61", (None, None)),
        ("1_2_3", (None, None)),
        ("a_b", (None, None)),
        (None, (None, None)),
    ],
)
def test_geolocation(spark, text, expected):
    df = spark.createDataFrame([(text,)], "g string")
    assert tuple(split_geolocation(df, "g").select("latitude", "longitude").first()) == expected
