"""Registered queries: the synthetic generator, with parts as series and orders linking them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlake.functions.calendar import bucket_start, periods_between
from demandlake.operators import generator as g
from demandlake.plans import tables as t
from demandlake.plans.generation import expected_series, generate
from demandlake.plans.registry import query

START = "2000-02-15"
LENGTH = 28
SEED = 42

# a shop that is closed at night, with a noon and an evening peak, busy on Saturdays and in December
HOURLY = [0] * 7 + [0.5, 1, 1, 1.5, 2, 2, 1.5, 1, 1, 1, 1.5, 2, 1.5, 1, 0.5] + [0] * 2
DAILY = [1, 1, 1, 1.25, 1.5, 2, 0.75]
MONTHLY = [0.75, 0.75, 1, 1, 1, 1.25, 1.25, 1, 1, 1, 1.5, 2.5]

_PER = {"ECONOMY": "D", "SMALL": "W", "STANDARD": "M", "LARGE": "Y", "PROMO": "H"}
_MINUTES_FROM_START = {"D": 1440, "W": 10080, "M": 29 * 1440, "Y": 366 * 1440, "H": 60}


def _factors(values: list[float]):
    return F.array(*[F.lit(float(v)) for v in values])


def models(spark, sf, *more: str) -> DataFrame:
    """A series per part; small parts have a store, cheap ones a segment, most neither or both."""
    entries = F.array_compact(
        F.array(
            F.when(F.col("p_size") <= 25, F.struct(F.lit("store").alias("key"), F.col("p_brand").alias("value"))),
            F.when(F.col("p_retailprice") < 1000, F.struct(F.lit("segment").alias("key"), F.col("p_type").alias("value"))),
        )
    )
    multiplier = 1 + F.col("p_size") / 100

    def attribute(name, value, bound):
        return F.struct(
            F.lit(name).alias("name"), value.alias("value"), bound.alias("min"), bound.alias("max")
        )

    return t.table(spark, sf, "part").select(
        F.concat(F.lit("part "), F.col("p_partkey").cast("string")).alias("name"),
        F.col("p_size").cast("double").alias("rate"),
        F.coalesce(t._choose("p_type", _PER), F.lit("D")).alias("per"),
        F.map_from_entries(entries).alias("dimensions"),
        F.array(
            attribute("brand", F.col("p_brand"), F.lit(None).cast("double")),
            attribute("category", F.col("p_type"), multiplier),
        ).alias("metadata"),
        _factors(HOURLY).alias("hourly"),
        _factors(DAILY).alias("daily"),
        _factors(MONTHLY).alias("monthly"),
        *more,
    )


_PER_SQL = f"coalesce({t._choose_sql('p_type', _PER)}, 'D')"
_PER_MINUTES_SQL = (
    f"CASE {_PER_SQL} " + " ".join(f"WHEN '{f}' THEN {m}" for f, m in _MINUTES_FROM_START.items()) + " END"
)
_RATE_SQL = f"p_size / ({_PER_MINUTES_SQL}) * 1440.0"


@query(
    "base_rate",
    f"SELECT 'part ' || p_partkey AS name, {_PER_SQL} AS per, round({_RATE_SQL}, 9) AS base_rate FROM part",
)
def base_rate(spark, sf):
    return g.base_rate(models(spark, sf), START, "D").select(
        "name", "per", F.round("base_rate", 9).alias("base_rate")
    )


_SERIES_SQL = f"""
    SELECT 'part ' || p_partkey AS name, p_brand, CAST(k AS INTEGER) AS period,
           TIMESTAMP '{START}' + k * INTERVAL 1 DAY AS "timestamp",
           {_RATE_SQL} * {sum(HOURLY) / 24!r} * ({DAILY!r})[isodow(TIMESTAMP '{START}' + k * INTERVAL 1 DAY)]
                       * ({MONTHLY!r})[month(TIMESTAMP '{START}' + k * INTERVAL 1 DAY)] AS rate_at,
           1 + p_size / 100 AS multiplier
    FROM part, (SELECT unnest(generate_series(0, {LENGTH - 1})) AS k)"""


@query("series_calendar", f'SELECT name, period, "timestamp" FROM ({_SERIES_SQL})')
def series_calendar(spark, sf):
    return g.series_calendar(models(spark, sf).select("name"), START, LENGTH, "D")


@query("seasonal_rate", f'SELECT name, period, "timestamp", round(rate_at, 9) AS rate_at FROM ({_SERIES_SQL})')
def seasonal_rate(spark, sf):
    return expected_series(models(spark, sf), START, LENGTH, "D").select(
        "name", "period", "timestamp", F.round("rate_at", 9).alias("rate_at")
    )


@query("metadata_rate", f"SELECT name, period, round(multiplier, 9) AS multiplier FROM ({_SERIES_SQL})")
def metadata_rate(spark, sf):
    series = g.fill_dimensions(models(spark, sf), ["store", "segment"])
    return g.series_calendar(series, START, LENGTH, "D").select(
        "name", "period", F.round(g.metadata_multiplier(SEED), 9).alias("multiplier")
    )


@query("poisson_counts")
def poisson_counts(spark, sf):
    return generate(models(spark, sf), None, [], START, LENGTH, "D", SEED)


@query(
    "poisson_calibration",
    f"""SELECT p_brand AS brand, round(sum(rate_at * multiplier), 4) AS expected, true AS within_six_deviations
        FROM ({_SERIES_SQL}) GROUP BY 1""",
)
def poisson_calibration(spark, sf):
    """Drawn totals per brand against their expectation, which bounds them by chance."""
    series = g.fill_dimensions(models(spark, sf), ["store", "segment"])
    drawn = g.draw_counts(expected_series(series, START, LENGTH, "D"), SEED)
    expected = F.sum(F.col("rate_at") * g.metadata_multiplier(SEED))
    return (
        drawn.groupBy(F.col("metadata")[0]["value"].alias("brand"))
        .agg(expected.alias("expected"), F.sum("count").alias("drawn"))
        .select(
            "brand",
            F.round("expected", 4).alias("expected"),
            (F.abs(F.col("drawn") - F.col("expected")) <= 6 * F.sqrt("expected") + 1).alias("within_six_deviations"),
        )
    )


_STORE_SQL = "CASE WHEN p_size <= 25 THEN p_brand ELSE 'unknown' END"
_SEGMENT_SQL = "CASE WHEN p_retailprice < 1000 THEN p_type ELSE 'unknown' END"


@query(
    "fill_dimensions",
    f"SELECT 'part ' || p_partkey AS name, {_SEGMENT_SQL} AS segment, {_STORE_SQL} AS store FROM part",
)
def fill_dimensions(spark, sf):
    complete = g.fill_dimensions(models(spark, sf), ["store", "segment"])
    return complete.select("name", *[F.col("dimensions")[d].alias(d) for d in ("segment", "store")])


# -- dependencies ---------------------------------------------------------------------------


# Lines of an order meet in blocks of 2 to the power of this many line numbers.
_BLOCK_BITS = 6


def _next_lines(line: DataFrame, rows: int, *alike: str) -> DataFrame:
    """Parts on one order line and the next of the same order; the first is influenced by the second.

    Takes about ``rows`` lines, and pairs only those with the same values in the columns ``alike``. They are shuffled
    once: a line is in its own block and, if it is the first of that, in the one before.
    """
    own, before = (F.shiftright(F.col("l_linenumber") - back, _BLOCK_BITS) for back in (0, 1))
    blocks = F.when(own == before, F.array(own)).otherwise(F.array(own, before))
    placed = line.where(F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull()).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_discount", *alike, F.explode(blocks).alias("_block")
    )
    after = F.struct(F.col("l_partkey").alias("dependency"), *alike)
    follow = Window.partitionBy("l_orderkey", "_block").orderBy("l_linenumber").rangeBetween(1, 1)
    pairs = (
        g.spread(placed, rows, "l_orderkey", "_block")
        .withColumn("_next", F.collect_list(after).over(follow))
        .where(own == F.col("_block"))
        .select("l_partkey", "l_returnflag", "l_discount", *alike, F.explode("_next").alias("_next"))
    )
    for column in alike:
        pairs = pairs.where(F.col(column) == F.col(f"_next.{column}"))
    return pairs.select("l_partkey", "l_returnflag", "l_discount", *alike, "_next.dependency")


@query(
    "dependency_effect",
    """WITH counts AS (
         SELECT l_partkey AS part, l_returnflag AS location, datediff('month', DATE '1995-01-01', l_shipdate) AS period,
                CAST(sum(l_quantity) AS BIGINT) AS "count" FROM lineitem GROUP BY 1, 2, 3),
       links AS (
         SELECT a.l_partkey AS part, a.l_returnflag AS location, b.l_partkey AS dependency,
                min(CASE WHEN a.l_discount >= 0.05 THEN 1 ELSE -1 END) AS chance
         FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber - 1
         GROUP BY 1, 2, 3),
       effects AS (
         SELECT l.part, l.location, period, sum(chance * "count") AS effect
         FROM links l JOIN counts c ON c.part = l.dependency AND c.location = l.location GROUP BY 1, 2, 3)
       SELECT CAST(part AS VARCHAR) AS name, location, CAST(period AS INTEGER) AS period,
              CAST(greatest("count" + coalesce(effect, 0), 0) AS BIGINT) AS "count"
       FROM counts LEFT JOIN effects USING (part, location, period)""",
)
def dependency_effect(spark, sf):
    """Monthly quantities per part and location, changed by those of the parts on the next order lines."""

    def dims(flag):
        return F.struct(flag.alias("location"))

    line = t.table(spark, sf, "lineitem")
    rows = line.count()

    def month_number(day):
        month = bucket_start(day.cast("timestamp"), "M")
        return periods_between(F.lit("1995-01-01").cast("timestamp"), month, "M").cast("int")

    counts = (
        line.groupBy(
            F.col("l_partkey").cast("string").alias("name"),
            F.col("l_returnflag").alias("location"),
            month_number(F.col("l_shipdate")).alias("period"),
        )
        .agg(F.sum("l_quantity").cast("bigint").alias("count"))
        .withColumn("dimensions", dims(F.col("location")))
    )
    series = line.select(
        F.col("l_partkey").cast("string").alias("name"), "l_returnflag"
    ).distinct().select("name", dims(F.col("l_returnflag")).alias("dimensions"))
    links = (
        _next_lines(line, rows)
        .groupBy("l_partkey", "l_returnflag", "dependency")
        .agg(F.min(F.when(F.col("l_discount") >= 0.05, 1.0).otherwise(-1.0)).alias("chance"))
        .select(
            F.col("l_partkey").cast("string").alias("name"),
            dims(F.col("l_returnflag")).alias("dimensions"),
            F.col("dependency").cast("string").alias("dependency"),
            "chance",
        )
    )
    last = line.select(F.max("l_shipdate").alias("last")).select(
        F.months_between(F.date_trunc("month", "last"), F.lit("1995-01-01").cast("timestamp")).cast("int") + 1
    )
    # a pair of lines links a part to all counts of another, which are several
    return g.apply_dependencies(counts, series, links, last.scalar(), SEED, rows * 4).select(
        "name", F.col("dimensions")["location"].alias("location"), "period", "count"
    )


def _part_links(spark, sf) -> DataFrame:
    """Dependencies between parts of equal dimensions that follow each other on orders."""
    complete = g.fill_dimensions(models(spark, sf, "p_partkey"), ["store", "segment"]).select("p_partkey", "dimensions")
    line = t.table(spark, sf, "lineitem")
    own = line.join(complete, line["l_partkey"] == complete["p_partkey"])

    def part(column):
        return F.concat(F.lit("part "), F.col(column).cast("string"))

    return (
        _next_lines(own, line.count(), "dimensions")
        .groupBy("l_partkey", "dimensions", "dependency")
        .agg((F.max("l_discount") * 5).alias("chance"))
        .select(part("l_partkey").alias("name"), "dimensions", part("dependency").alias("dependency"), "chance")
    )


@query("synthetic_series")
def synthetic_series(spark, sf):
    """The whole generator: seasonal Poisson counts per part and day, then dependencies."""
    series = g.fill_dimensions(models(spark, sf), ["store", "segment"])
    return generate(series, _part_links(spark, sf), ["store", "segment"], START, LENGTH, "D", SEED)


@query(
    "unmatched_dependencies",
    """WITH d AS (SELECT DISTINCT a.l_partkey AS parent, b.l_partkey AS dependency FROM lineitem a
                  JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber - 1)
       SELECT CAST(parent AS VARCHAR) AS name, CAST(dependency AS VARCHAR) AS dependency, CAST(0 AS BIGINT) AS matches
       FROM d JOIN part p ON p.p_partkey = parent JOIN part q ON q.p_partkey = dependency
       WHERE p.p_type <> q.p_type""",
)
def unmatched_dependencies(spark, sf):
    """Parts by category: a dependency on a part of another category finds no series."""
    series = t.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("name"),
        F.struct(F.col("p_type").alias("category")).alias("dimensions"),
    )
    line = t.table(spark, sf, "lineitem")
    pairs = _next_lines(line, line.count()).select(
        F.col("l_partkey").cast("string").alias("name"), F.col("dependency").cast("string").alias("dependency")
    ).distinct()
    return g.unmatched_dependencies(series, pairs.join(series, "name")).select("name", "dependency", "matches")


# -- checks and output ------------------------------------------------------------------------


@query(
    "series_mean",
    f"""WITH m AS (SELECT identifier, CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS "month", sum(metric) AS metric
                   FROM ({t.DEMAND_SQL}) GROUP BY 1, 2)
        SELECT identifier, round(avg(metric), 6) AS mean
        FROM m JOIN (SELECT identifier, max("month") AS last FROM m GROUP BY 1) USING (identifier)
        WHERE "month" < last GROUP BY 1""",
)
def series_mean(spark, sf):
    from demandlake.plans.history_queries import monthly

    means = g.series_mean(monthly(spark, sf), ["identifier"], order="timestamp", value="metric")
    return means.where(F.col("mean").isNotNull()).select("identifier", F.round("mean", 6).alias("mean"))


@query(
    "synthetic_metadata",
    "SELECT 'part ' || p_partkey AS item, p_brand AS brand, p_type AS category FROM part",
)
def synthetic_metadata(spark, sf):
    return g.metadata_rows(g.metadata_entries(models(spark, sf)), ["category", "brand"])


@query(
    "metadata_conflicts",
    """WITH e AS (SELECT l_partkey AS item, 'status' AS attribute, l_linestatus AS value FROM lineitem
                  UNION ALL SELECT p_partkey, 'brand', p_brand FROM part
                  UNION ALL SELECT p_partkey, 'category', p_type FROM part),
            a AS (SELECT item, attribute, count(DISTINCT value) AS n FROM e GROUP BY 1, 2)
       SELECT item, attribute, 'conflicting value' AS problem FROM a WHERE n > 1
       UNION ALL SELECT item, NULL, 'missing attribute' FROM a GROUP BY item
       HAVING count(*) <> (SELECT count(DISTINCT attribute) FROM e)""",
)
def metadata_conflicts(spark, sf):
    """Items with the line status of all their order lines, next to the part's own attributes."""
    part = t.table(spark, sf, "part")
    status = t.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("item"), F.lit("status").alias("attribute"), F.col("l_linestatus").alias("value")
    )
    own = part.select(
        F.col("p_partkey").alias("item"), F.col("p_brand").alias("brand"), F.col("p_type").alias("category")
    ).unpivot("item", ["brand", "category"], "attribute", "value")
    return g.metadata_conflicts(status.unionByName(own))


@query(
    "duplicate_dimensions",
    """SELECT l_partkey AS name, l_returnflag || l_linestatus AS dimension, count(*) AS copies
       FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_dimensions(spark, sf):
    return g.duplicate_dimensions(
        t.table(spark, sf, "lineitem").select(
            F.col("l_partkey").alias("name"), F.concat("l_returnflag", "l_linestatus").alias("dimension")
        )
    )
