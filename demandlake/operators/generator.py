"""Seeded synthetic demand.

A model frame has one row per series::

    name string, rate double, per string, dimensions map<string,string>,
    metadata array<struct<name:string, value:string, min:double, max:double>>,
    hourly array<double>, daily array<double>, monthly array<double>

``rate`` occurrences are expected every ``per`` (a frequency). The seasonality arrays have
24, 7 (Monday first) and 12 factors, or are null for none. A dependency frame has
``name, dimensions, dependency, chance``: the series that is influenced, the name of the one
that influences it, and how likely one occurrence there changes the count here. Where series
are compared, ``dimensions`` is what ``fill_dimensions`` makes of the map.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.functions.calendar import add_periods
from demandlake.functions.sampling import binomials, normal, poisson, uniform
from demandlake.spec import FREQUENCIES

UNKNOWN = "unknown"
SEASONALITY_LENGTHS = {"hourly": 24, "daily": 7, "monthly": 12}

MODEL_SCHEMA = (
    "name string, rate double, per string, dimensions map<string,string>, "
    "metadata array<struct<name:string,value:string,min:double,max:double>>, "
    "hourly array<double>, daily array<double>, monthly array<double>"
)
DEPENDENCY_SCHEMA = "name string, dimensions map<string,string>, dependency string, chance double"


def step_minutes(frequency: str, start: Column) -> Column:
    """Minutes of one step from ``start``; calendar steps depend on where they start."""
    return (F.unix_micros(add_periods(start, frequency, 1)) - F.unix_micros(start)) / F.lit(60e6)


def per_minutes(per: Column, start: Column) -> Column:
    choice = None
    for name in FREQUENCIES:
        minutes = step_minutes(name, start)
        choice = F.when(per == name, minutes) if choice is None else choice.when(per == name, minutes)
    return choice.otherwise(F.raise_error(F.concat(F.lit("unknown frequency "), per)))


def base_rate(models: DataFrame, start: datetime | str, output: str) -> DataFrame:
    """Adds ``bucket_minutes`` and ``base_rate``, the expected count per output period."""
    origin = F.lit(start).cast("timestamp")
    minutes = step_minutes(output, origin)
    return models.withColumn("bucket_minutes", minutes).withColumn(
        "base_rate", F.col("rate") / per_minutes(F.col("per"), origin) * F.col("bucket_minutes")
    )


# -- specification checks ----------------------------------------------------------------


def wrong_seasonalities(models: DataFrame) -> DataFrame:
    """(name, seasonality, length) of arrays that do not have the length they need."""
    sizes = [
        F.struct(F.lit(kind).alias("seasonality"), F.size(kind).alias("length"), F.lit(n).alias("needed"))
        for kind, n in SEASONALITY_LENGTHS.items()
    ]
    return (
        models.select("name", F.explode(F.array(*sizes)).alias("_s"))
        .select("name", "_s.*")
        .where((F.col("length") >= 0) & (F.col("length") != F.col("needed")))
        .drop("needed")
    )


def invalid_rates(models: DataFrame) -> DataFrame:
    """(name, rate) of series whose rate is null, NaN or negative."""
    rate = F.col("rate").cast("double")
    return models.select("name", "rate").where(rate.isNull() | F.isnan(rate) | (rate < 0))


def invalid_factors(models: DataFrame) -> DataFrame:
    """(name, seasonality) with a factor that is null, NaN or negative."""
    kinds = [F.struct(F.lit(kind).alias("seasonality"), F.col(kind).alias("factors")) for kind in SEASONALITY_LENGTHS]
    return (
        models.select("name", F.explode(F.array(*kinds)).alias("_s"))
        .where(F.exists("_s.factors", lambda x: x.isNull() | F.isnan(x.cast("double")) | (x < 0)))
        .select("name", "_s.seasonality")
    )


def duplicate_series(models: DataFrame) -> DataFrame:
    """Series given more than once, by name and filled dimensions."""
    return models.groupBy("name", "dimensions").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def invalid_chances(dependencies: DataFrame) -> DataFrame:
    """(name, dependency) whose chance is null or NaN."""
    chance = F.col("chance").cast("double")
    return dependencies.select("name", "dependency", "chance").where(chance.isNull() | F.isnan(chance))


def duplicate_dimensions(entries: DataFrame) -> DataFrame:
    """Dimensions given more than once for a series; ``entries`` has ``name, dimension``."""
    return (
        entries.groupBy("name", "dimension")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def unmatched_dependencies(models: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Dependencies that do not name exactly one series with the same dimensions."""
    present = models.groupBy(F.col("name").alias("dependency"), "dimensions").agg(
        F.count(F.lit(1)).alias("matches")
    )
    return (
        dependencies.select("name", "dependency", "dimensions")
        .join(present, ["dependency", "dimensions"], "left")
        .withColumn("matches", F.coalesce("matches", F.lit(0)))
        .where(F.col("matches") != 1)
    )


def metadata_conflicts(entries: DataFrame) -> DataFrame:
    """Attributes with two values on one item, and items whose attribute set is unlike the others'.

    ``entries`` has ``item, attribute, value``. Two values differ when the smallest and the
    largest do, so no set of values is built.
    """
    per_attribute = entries.groupBy("item", "attribute").agg(
        F.min("value").alias("_low"), F.max("value").alias("_high")
    )
    conflicting = per_attribute.where(F.col("_low") != F.col("_high")).select(
        "item", "attribute", F.lit("conflicting value").alias("problem")
    )
    all_attributes = per_attribute.select("attribute").distinct().agg(F.count(F.lit(1))).scalar()
    incomplete = (
        per_attribute.groupBy("item")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") != all_attributes)
        .select("item", F.lit(None).cast("string").alias("attribute"), F.lit("missing attribute").alias("problem"))
    )
    return conflicting.unionByName(incomplete)


# -- series ------------------------------------------------------------------------------


def fill_dimensions(models: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give every series every dimension, ``unknown`` where it has none.

    The map becomes a struct with the names in order: unlike maps, structs can be compared,
    joined and grouped. Without any names all series have the same constant.
    """
    values = [F.coalesce(F.col("dimensions")[n], F.lit(UNKNOWN)).alias(n) for n in sorted(names)]
    return models.withColumn("dimensions", F.struct(*values) if values else F.lit(""))


def series_calendar(models: DataFrame, start: datetime | str, length: int, output: str) -> DataFrame:
    """Every series in every period: adds ``period`` from 0 and its ``timestamp``."""
    return (
        spread(_pieces(models, length), models.count() * length, "name", "_from")
        .select("*", F.explode_outer(F.sequence("_from", _last(length))).alias("period"))
        .drop("_from")
        .withColumn("timestamp", add_periods(F.lit(start).cast("timestamp"), output, F.col("period")))
    )


# Periods are exploded from pieces of this many, which are what is spread over the cluster.
_PIECE = 4096


def _pieces(models: DataFrame, length: int) -> DataFrame:
    return models.withColumn("_from", F.explode_outer(F.sequence(F.lit(0), F.lit(length - 1), F.lit(_PIECE))))


def _last(length: int) -> Column:
    return F.least(F.col("_from") + _PIECE, F.lit(length)) - 1


# Tasks have as many rows on average, so that the memory of one doesn't grow with the input.
_TASK_ROWS = 1 << 19


def spread(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """Rows that are few now and ``rows`` later need more tasks than their size suggests.

    Giving the number keeps adaptive execution from merging the partitions again.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // _TASK_ROWS)), *columns)


def seasonal_factor(start: Column, minutes: Column) -> Column:
    """Mean of hourly x daily x monthly factors over ``minutes`` from ``start``.

    Factors are constant within a clock hour, so the mean is taken over the clock hours the
    span touches, each weighted by the part of it inside the span.
    """
    begin = F.unix_micros(start)
    end = begin + (minutes * F.lit(60_000_000)).cast("bigint")
    hour = 3_600_000_000
    hours = F.sequence(F.floor(begin / hour), F.floor((end - 1) / hour))

    def weighted(total: Column, h: Column) -> Column:
        moment = F.timestamp_micros((h * F.lit(hour)).cast("bigint"))
        factor = (
            F.get("hourly", F.hour(moment))
            * F.get("daily", F.weekday(moment))
            * F.get("monthly", F.month(moment) - 1)
        )
        inside = F.least((h + 1) * F.lit(hour), end) - F.greatest(h * F.lit(hour), begin)
        return total + factor * inside.cast("double")

    return F.aggregate(hours, F.lit(0.0), weighted) / (end - begin).cast("double")


def seasonal_series(models: DataFrame, start: datetime | str, length: int, output: str) -> DataFrame:
    """Every series and period with ``rate_at``, its expected count after seasonality.

    Takes models with ``base_rate``. Seasonality follows periods of the length the first
    one has, as the base rate does, so for months and years it drifts from the calendar
    dates by a day or so per period.

    Factors are worked out once per distinct seasonality and piece of the calendar, not
    once per series: series often share them. A seasonality is known by a number, the same in
    every run; series and factors meet by that number and the piece.
    """
    origin = F.lit(start).cast("timestamp")
    minutes = F.col("bucket_minutes")
    shaped = models.withColumns(
        {k: F.coalesce(k, F.array_repeat(F.lit(1.0), n)) for k, n in SEASONALITY_LENGTHS.items()}
    )
    shape = [*SEASONALITY_LENGTHS, "bucket_minutes"]
    shaped = shaped.withColumn("_profile", F.xxhash64(*shape))

    def factor(period: Column) -> Column:
        moved = F.unix_micros(origin) + (period * minutes * F.lit(60e6)).cast("bigint")
        return seasonal_factor(F.timestamp_micros(moved), minutes)

    pieces = spread(_pieces(_profiles(shaped, shape), length), 0, "_profile", "_from")
    factors = pieces.select("_profile", "_from", F.transform(F.sequence("_from", _last(length)), factor).alias("_factors"))
    kept = [c for c in models.columns if c not in SEASONALITY_LENGTHS]
    series = _pieces(shaped.select(*kept, "_profile"), length)
    return (
        spread(series.join(factors, ["_profile", "_from"]), models.count() * length, "name", "_from")
        # never empty; plain explode would have Spark test the factors before they are shared
        .select(*kept, "_from", F.posexplode_outer("_factors").alias("_position", "_factor"))
        .withColumn("period", F.col("_from") + F.col("_position"))
        .withColumn("timestamp", add_periods(origin, output, F.col("period")))
        .withColumn("rate_at", F.col("base_rate") * F.col("_factor"))
        .drop("_from", "_position", "_factor")
    )


def _profiles(shaped: DataFrame, shape: Sequence[str]) -> DataFrame:
    """Each distinct seasonality once, by its number; two that share a number fail the job."""
    own = F.struct(*shape)
    found = shaped.groupBy("_profile").agg(F.min(own).alias("_low"), F.max(own).alias("_high"))
    clash = F.raise_error(F.lit("two seasonalities have the same number"))
    one = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(clash)
    return found.select("_profile", one.alias("_shape")).select("_profile", *[F.col(f"_shape.{c}").alias(c) for c in shape])


def metadata_multiplier(seed: int) -> Column:
    """Product over a row's metadata of one normal draw each, centred between ``min`` and ``max``.

    The bounds lie three deviations from the centre; equal bounds give exactly that number. Needs the
    columns ``name, dimensions, period, metadata``; bad bounds fail the job.
    """

    def draw(product: Column, entry: Column) -> Column:
        low, high = F.coalesce(entry["min"], F.lit(1.0)), F.coalesce(entry["max"], F.lit(1.0))
        middle = (low + high) / 2.0
        sample = normal(middle, (high - middle) / 3.0, seed, "name", "dimensions", "period", entry["name"])
        broken = F.raise_error(F.lit("metadata bounds must be positive and ordered"))
        return product * F.when((low > high) | (low <= 0), broken).otherwise(sample)

    return F.when(F.coalesce(F.size("metadata"), F.lit(0)) > 0, F.aggregate("metadata", F.lit(1.0), draw)).otherwise(
        F.lit(1.0)
    )


def wrong_metadata_bounds(models: DataFrame) -> DataFrame:
    """(name, attribute) whose bounds are not positive or not in order."""
    return (
        models.select("name", F.explode("metadata").alias("_m"))
        .select("name", F.col("_m.name").alias("attribute"), F.col("_m.min").alias("min"), F.col("_m.max").alias("max"))
        .where((F.col("min") > F.col("max")) | (F.col("min") <= 0) | (F.col("max") <= 0))
    )


def draw_counts(series: DataFrame, seed: int) -> DataFrame:
    """Adds ``count``, a Poisson draw at ``rate_at`` times the metadata multiplier."""
    return series.withColumn("_lambda", F.col("rate_at") * metadata_multiplier(seed)).withColumn(
        "count", poisson(F.col("_lambda"), seed, "name", "dimensions", "period")
    ).drop("_lambda")


# Links are joined with counts per span of this many periods, whose number in the span fits a byte.
_SPAN = 128


def apply_dependencies(
    counts: DataFrame, models: DataFrame, dependencies: DataFrame, length: Column | int, seed: int, rows: int = 0
) -> DataFrame:
    """Add the effect of other series' counts in the same period.

    ``counts`` has ``name, dimensions, period, count`` with periods from 0 to below
    ``length``, about ``rows`` of them: more are dealt to more tasks. A positive chance adds a
    binomial share of the other series' count, a negative one takes off all of it; the result is
    never below zero. Effects use counts from before any effect.

    Every series is also linked to itself, so the counts pass through one join and one
    aggregation and are drawn once. A link takes the counts of a span as one row with two arrays,
    and they become rows where the influenced series is summed up: a series that a large
    part of the others depend on meets all its links of a span in one task, in a row each.
    """
    own = models.select(
        "name", "dimensions", F.col("name").alias("_parent"), F.lit(None).cast("double").alias("_chance")
    )
    others = dependencies.select(
        F.col("dependency").alias("name"), "dimensions", F.col("name").alias("_parent"), F.col("chance").alias("_chance")
    )
    periods = F.lit(length) if isinstance(length, int) else length
    last_span = F.floor((periods - 1) / _SPAN).cast("int")
    links = own.unionByName(others).withColumn("_last_span", last_span)
    links = links.select(
        "name", "dimensions", "_parent", "_chance", F.explode_outer(F.sequence(F.lit(0), F.col("_last_span"))).alias("_span")
    )
    key = ["name", "dimensions", "_span"]
    spans = (
        spread(counts.withColumn("_span", F.floor(F.col("period") / _SPAN).cast("int")), rows, *key)
        .groupBy(*key)
        .agg(F.collect_list(F.struct((F.col("period") - F.col("_span") * _SPAN).cast("byte").alias("at"), "count")).alias("_c"))
        .select(*key, F.col("_c.at").alias("_at"), F.col("_c.count").alias("_count"))
    )
    chance, count, period = F.col("_chance"), F.col("_count"), counts.schema["period"].dataType

    def draws(at: Column) -> Column:
        return uniform(seed, "_parent", "dimensions", "name", (F.col("_span") * _SPAN + at).cast(period))

    # drawn span by span, so that what is summed up is already where it belongs
    uncertain = (chance > 0) & (chance < 1)
    share = binomials(
        F.when(uncertain, F.transform("_at", draws)).otherwise(F.array().cast("array<double>")),
        F.when(uncertain, count).otherwise(F.array().cast("array<bigint>")),
        chance,
    )
    delta = (
        F.when(chance.isNull() | (chance >= 1), count)
        .when(chance < 0, F.transform(count, lambda c: -c))
        .when(uncertain, F.col("_share"))
        .otherwise(F.transform(count, lambda c: F.lit(0).cast("bigint")))
    )
    linked = (
        spans.join(spread(links, rows, *key), key)
        .withColumn("_share", share)
        .select(F.col("_parent").alias("name"), "dimensions", "_span", chance.isNull().alias("_own"), "_at", delta.alias("_delta"))
    )
    return (
        spread(linked, rows, "name", "dimensions", "_span")
        .select("name", "dimensions", "_span", "_own", F.explode(F.arrays_zip("_at", "_delta")).alias("_d"))
        .groupBy("name", "dimensions", "_span", "_d._at")
        .agg(F.greatest(F.sum("_d._delta"), F.lit(0)).alias("count"), F.bool_or("_own").alias("_own"))
        .where("_own")
        .select("name", "dimensions", (F.col("_span") * _SPAN + F.col("_at")).cast(period).alias("period"), "count")
    )


def series_mean(df: DataFrame, keys: Sequence[str], order: str = "period", value: str = "count") -> DataFrame:
    """Mean of all but the last value of each series, null for a series of one."""
    return df.groupBy(*keys).agg(
        (
            (F.sum(value) - F.max_by(value, order)).cast("double")
            / F.nullif(F.count(F.lit(1)) - 1, F.lit(0))
        ).alias("mean")
    )


# -- output ------------------------------------------------------------------------------


def series_rows(series: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Rows as written: name, date, count, then dimension values by dimension name."""
    return series.select(
        "name", "timestamp", "count", *[F.col("dimensions")[d].alias(d) for d in sorted(dimensions)]
    )


def metadata_rows(entries: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """One row per item with its attribute values in the order of attribute names."""
    return (
        entries.groupBy("item")
        .pivot("attribute", sorted(attributes))
        .agg(F.min("value"))
    )


def metadata_entries(models: DataFrame) -> DataFrame:
    """(item, attribute, value) of all models."""
    return models.select(F.col("name").alias("item"), F.explode("metadata").alias("_m")).select(
        "item", F.col("_m.name").alias("attribute"), F.col("_m.value").alias("value")
    )
