"""Registered queries: buckets, consolidation, views, declared history treatments."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandlake.functions.calendar import bucket_start, month_starting
from demandlake.operators import consolidate as c
from demandlake.operators import views
from demandlake.operators.bucket import bucket
from demandlake.operators.history import backtest_split, fill_gaps, horizon
from demandlake.operators.quantiles import baseline_forecast, exact_quantiles, quantile_aggregates
from demandlake.operators.running import running_total
from demandlake.plans import tables as t
from demandlake.plans.registry import query

# -- buckets --------------------------------------------------------------------------------

_DATE_PARTS = {"Y": "year", "M": "month", "W": "week", "D": "day"}
_MINUTES = {"H": 60, "30min": 30, "15min": 15, "10min": 10, "5min": 5, "1min": 1}


def _register_buckets() -> None:
    for frequency, part in _DATE_PARTS.items():
        query(
            f"bucket_{frequency.lower()}",
            f"""SELECT identifier, location, CAST(date_trunc('{part}', "timestamp") AS TIMESTAMP) AS "timestamp",
                       sum(metric) AS metric
                FROM ({t.DEMAND_SQL}) GROUP BY 1, 2, 3""",
        )(lambda spark, sf, f=frequency: bucket(t.demand(spark, sf), f, ["location"]))
    for frequency, minutes in _MINUTES.items():
        query(
            f"bucket_{frequency.lower()}",
            f"""SELECT event_type AS identifier, CAST(user_id AS VARCHAR) AS "user",
                       time_bucket(INTERVAL {minutes} MINUTE, ts) AS "timestamp",
                       sum(round(value * 100)) AS metric
                FROM events GROUP BY 1, 2, 3""",
        )(lambda spark, sf, f=frequency: bucket(t.activity(spark, sf), f, ["user"]))


_register_buckets()

_MONTHLY_SQL = f"""
    SELECT identifier, CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS "timestamp", sum(metric) AS metric
    FROM ({t.DEMAND_SQL}) GROUP BY 1, 2"""


@query("bucket_no_dims", _MONTHLY_SQL)
def monthly(spark, sf):
    return bucket(t.demand(spark, sf), "M")


def weekly(spark, sf):
    return bucket(t.demand(spark, sf), "W", ["location"])


def _starts(spark, sf, frequency):
    """The bucket of each row, not grouped: the same first and last period as the history has."""
    return t.demand(spark, sf).select(bucket_start("timestamp", frequency).alias("timestamp"))


# -- consolidation --------------------------------------------------------------------------

_CUT_SQL = f"""
    SELECT * FROM ({t.WEEKLY_SQL})
    WHERE "timestamp" < (SELECT min("timestamp") FROM ({t.BACKTEST_SQL}))"""


@query("history_cutoff", _CUT_SQL)
def history_cutoff(spark, sf):
    return c.cut_history(weekly(spark, sf), t.backtest_rows(spark, sf))


@query("history_cutoff_no_backtest", t.WEEKLY_SQL)
def history_cutoff_no_backtest(spark, sf):
    """A backtest export without rows leaves the history whole."""
    later = F.lit("2100-01-01").cast("timestamp")
    return c.cut_history(weekly(spark, sf), t.backtest(spark, sf).where(F.col("timestamp") >= later))


@query(
    "month_starting",
    f"""SELECT strftime(date_trunc('month', "timestamp"), '%Y-%m-%d') AS month_starting,
               count(*) AS points, sum(metric) AS metric
        FROM ({t.WEEKLY_SQL}) GROUP BY 1""",
)
def months(spark, sf):
    return (
        weekly(spark, sf)
        .groupBy(month_starting("timestamp").alias("month_starting"))
        .agg(F.count(F.lit(1)).alias("points"), F.sum("metric").alias("metric"))
    )


@query(
    "union_missing",
    f"""SELECT identifier, location, "timestamp", metric, p10, p50, p90 FROM ({t.BACKTEST_SQL})
        UNION ALL BY NAME SELECT identifier, location, "timestamp", p10, p50, p90 FROM ({t.FORECAST_SQL})
        UNION ALL BY NAME SELECT * FROM ({t.WEEKLY_SQL})""",
)
def union_missing(spark, sf):
    exports = c.union_frames(t.backtest(spark, sf), t.forecast(spark, sf))
    return c.union_frames(exports, weekly(spark, sf))


def _wide_sql(present: dict[str, str], extra: str = "") -> str:
    columns = []
    for field in c.wide_schema().fields:
        if field.name in present:
            columns.append(f'{present[field.name]} AS "{field.name}"')
        else:
            kind = {"timestamp": "TIMESTAMP", "double": "DOUBLE", "string": "VARCHAR"}[field.dataType.typeName()]
            columns.append(f'CAST(NULL AS {kind}) AS "{field.name}"')
    return ", ".join(columns) + extra


@query(
    "wide_schema",
    f"""SELECT {_wide_sql({"identifier": "identifier", "timestamp": '"timestamp"', "metric": "metric"})}
        FROM (SELECT identifier, CAST(date_trunc('year', "timestamp") AS TIMESTAMP) AS "timestamp",
                     sum(metric) AS metric FROM ({t.DEMAND_SQL}) GROUP BY 1, 2)""",
)
def wide(spark, sf):
    return c.to_wide(bucket(t.demand(spark, sf), "Y"))


def _repeated_metadata(spark, sf, smaller_than=None):
    """Two rows for the parts of one brand; metadata of all parts, or of those below a size."""
    parts = t.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("identifier"),
        F.col("p_brand").alias("metadata_1"),
        F.col("p_type").alias("metadata_2"),
        "p_size",
    )
    known = parts if smaller_than is None else parts.where(F.col("p_size") < smaller_than)
    again = known.where(F.col("metadata_1") == "Brand#2").withColumn("metadata_2", F.lit("second row"))
    return known.unionByName(again).drop("p_size")


_PARTIAL_SQL = """
    SELECT CAST(p_partkey AS VARCHAR) AS identifier, p_brand AS metadata_1, p_type AS metadata_2
    FROM part WHERE p_size < 45
    UNION ALL
    SELECT CAST(p_partkey AS VARCHAR), p_brand, 'second row' FROM part WHERE p_size < 45 AND p_brand = 'Brand#2'"""


@query(
    "join_metadata",
    f"""SELECT identifier, location, "timestamp", metric, metadata_1, metadata_2
        FROM ({t.WEEKLY_SQL}) LEFT JOIN ({_PARTIAL_SQL}) USING (identifier)""",
)
def join_metadata(spark, sf):
    return c.join_metadata(weekly(spark, sf), _repeated_metadata(spark, sf, smaller_than=45))


@query(
    "metadata_fanout",
    """SELECT CAST(p_partkey AS VARCHAR) AS identifier, count(*) * 2 AS copies FROM part
       WHERE p_brand = 'Brand#2' GROUP BY 1""",
)
def metadata_fanout(spark, sf):
    return c.duplicate_identifiers(_repeated_metadata(spark, sf))


_PRESENT = {
    "timestamp": '"timestamp"',
    "identifier": "identifier",
    "metric": "metric",
    "p10": "p10",
    "p50": "p50",
    "p90": "p90",
    "dimension_1": "location",
    "metadata_1": "brand",
    "metadata_2": "category",
}
_MONTH = """strftime(date_trunc('month', "timestamp"), '%Y-%m-%d')"""

CONSOLIDATED_SQL = f"""
    SELECT {_wide_sql(_PRESENT, f", {_MONTH} AS month_starting")}
    FROM (SELECT * FROM ({_CUT_SQL}) UNION ALL BY NAME SELECT * FROM ({t.BACKTEST_SQL})
          UNION ALL BY NAME SELECT * FROM ({t.FORECAST_SQL}))
    LEFT JOIN ({t.METADATA_SQL}) USING (identifier)"""


@query("consolidate", CONSOLIDATED_SQL)
def consolidated(spark, sf, wide=True):
    """History up to the backtest, backtest, forecast and metadata in the wide schema."""
    return c.consolidate(
        weekly(spark, sf),
        t.backtest(spark, sf),
        t.forecast(spark, sf),
        t.TARGET_SPEC,
        t.metadata(spark, sf),
        t.METADATA_SPEC,
        backtest_rows=t.backtest_rows(spark, sf),
        wide=wide,
    )


# -- views ----------------------------------------------------------------------------------


@query(
    "date_range",
    f"""SELECT * FROM ({t.WEEKLY_SQL})
        WHERE "timestamp" BETWEEN TIMESTAMP '1998-09-07' AND TIMESTAMP '1999-02-01'""",
)
def date_range(spark, sf):
    return views.date_range(weekly(spark, sf), "timestamp", "1998-09-07", "1999-02-01")


@query(
    "quantile_band",
    f"""SELECT identifier, location, "timestamp", p50, q.quantile,
               CASE q.quantile WHEN 'p10' THEN p10 ELSE p90 END AS "value"
        FROM ({t.FORECAST_SQL}), (VALUES ('p10'), ('p90')) AS q(quantile)""",
)
def quantile_band(spark, sf):
    return views.quantile_bands(t.forecast(spark, sf), ["identifier", "location", "timestamp"])


@query(
    "forecast_bridge",
    f"""SELECT identifier, location, last_timestamp, last_metric, first_timestamp, first_value
        FROM (SELECT identifier, location, max("timestamp") AS last_timestamp,
                     max_by(metric, "timestamp") AS last_metric FROM ({_CUT_SQL}) GROUP BY 1, 2)
        JOIN (SELECT identifier, location, min("timestamp") AS first_timestamp,
                     min_by(p50, "timestamp") AS first_value FROM ({t.FORECAST_SQL}) GROUP BY 1, 2)
        USING (identifier, location)""",
)
def forecast_bridge(spark, sf):
    return views.forecast_bridge(
        history_cutoff(spark, sf), t.forecast(spark, sf), ["identifier", "location"]
    )


@query(
    "cumulative",
    f"""SELECT *, sum(metric) OVER (PARTITION BY identifier ORDER BY "timestamp"
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative
        FROM ({_MONTHLY_SQL})""",
)
def cumulative(spark, sf):
    return running_total(monthly(spark, sf), ["identifier"])


# -- declared treatments --------------------------------------------------------------------

_SPAN_SQL = f"""
    monthly AS ({_MONTHLY_SQL}),
    spans AS (SELECT identifier, min("timestamp") AS first, max("timestamp") AS last,
                     quantile_cont(metric, 0.5) AS median, max(metric) AS highest
              FROM monthly GROUP BY 1),
    ends AS (SELECT min("timestamp") AS earliest, max("timestamp") AS latest FROM monthly)"""


def _gap_sql(start: str, end: str, segment: str, metric: str) -> str:
    return f"""
        WITH {_SPAN_SQL},
        spine AS (SELECT spans.*, earliest, latest, unnest(generate_series({start}, {end}, INTERVAL 1 MONTH)) AS "timestamp"
                  FROM spans, ends)
        SELECT identifier, "timestamp", {metric} AS metric, {segment} AS segment
        FROM spine LEFT JOIN monthly USING (identifier, "timestamp")"""


@query(
    "gapfill_zero",
    _gap_sql(
        "first",
        "latest",
        """CASE WHEN metric IS NOT NULL THEN 'history' WHEN "timestamp" < last THEN 'middle' ELSE 'back' END""",
        "coalesce(metric, 0)",
    ),
)
def gapfill_zero(spark, sf):
    return fill_gaps(monthly(spark, sf), ["identifier"], "M", middle="zero", back="zero", extent=_starts(spark, sf, "M"))


@query(
    "gapfill_median",
    _gap_sql(
        "earliest",
        "last",
        """CASE WHEN metric IS NOT NULL THEN 'history' WHEN "timestamp" < first THEN 'front' ELSE 'middle' END""",
        """CASE WHEN "timestamp" < first THEN metric ELSE coalesce(metric, median) END""",
    ),
)
def gapfill_median(spark, sf):
    return fill_gaps(monthly(spark, sf), ["identifier"], "M", middle="median", front="none", extent=_starts(spark, sf, "M"))


@query(
    "gapfill_future",
    _gap_sql(
        "first",
        "latest + INTERVAL 6 MONTH",
        """CASE WHEN metric IS NOT NULL THEN 'history' WHEN "timestamp" < last THEN 'middle'
                WHEN "timestamp" <= latest THEN 'back' ELSE 'future' END""",
        """CASE WHEN "timestamp" > latest THEN highest ELSE coalesce(metric, median) END""",
    ),
)
def gapfill_future(spark, sf):
    return fill_gaps(
        monthly(spark, sf),
        ["identifier"],
        "M",
        middle="median",
        back="median",
        future="max",
        horizon=6,
        extent=_starts(spark, sf, "M"),
    )


@query(
    "horizon",
    f"""SELECT identifier, location, CAST(step AS INTEGER) AS step, last + step * INTERVAL 1 WEEK AS "timestamp"
        FROM (SELECT identifier, location, max("timestamp") AS last FROM ({t.WEEKLY_SQL}) GROUP BY 1, 2),
             (SELECT unnest(generate_series(1, 12)) AS step)""",
)
def horizon_rows(spark, sf):
    return horizon(weekly(spark, sf), ["identifier", "location"], "W", 12)


@query(
    "backtest_split",
    f"""WITH weekly AS ({t.WEEKLY_SQL}),
             w AS (SELECT CAST(n AS INTEGER) AS "window", max("timestamp") - (n * 8 - 1) * INTERVAL 1 WEEK AS split
                   FROM weekly, (SELECT unnest(generate_series(1, 3)) AS n) GROUP BY n)
        SELECT identifier, location, "timestamp", metric, "window",
               CASE WHEN "timestamp" < split THEN 'train' ELSE 'test' END AS part
        FROM weekly, w WHERE "timestamp" < split + INTERVAL 8 WEEK""",
)
def split(spark, sf):
    return backtest_split(weekly(spark, sf), "W", 8, windows=3, extent=_starts(spark, sf, "W"))


def _rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


_QUANTILE_SQL = f"""
    SELECT identifier, round(quantile_cont(metric, 0.1), 6) AS p10, round(quantile_cont(metric, 0.5), 6) AS p50,
           round(quantile_cont(metric, 0.9), 6) AS p90, round(avg(metric), 6) AS mean
    FROM ({_MONTHLY_SQL}) GROUP BY 1"""
_LEVELS = ["0.10", "0.50", "0.90", "mean"]


@query("quantile_columns", _QUANTILE_SQL)
def quantile_columns(spark, sf):
    return _rounded(
        quantile_aggregates(monthly(spark, sf), ["identifier"], _LEVELS), "p10", "p50", "p90", "mean"
    )


@query(
    "exact_quantiles",
    """SELECT l_returnflag AS location, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
              round(quantile_cont(l_extendedprice, 0.9), 6) AS p90
       FROM lineitem GROUP BY 1""",
)
def exact_price_quantiles(spark, sf):
    """Quantiles of all line prices per return flag: three groups that hold all rows, none of which is bucketed."""
    lines = t.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("location"), F.col("l_extendedprice").alias("metric"))
    return _rounded(exact_quantiles(lines, ["location"], ["0.10", "0.50", "0.90"]), "p10", "p50", "p90")


@query(
    "baseline_forecast",
    f"""SELECT identifier, CAST(step AS INTEGER) AS step, last + step * INTERVAL 1 MONTH AS "timestamp",
               p10, p50, p90, mean
        FROM ({_QUANTILE_SQL})
        JOIN (SELECT identifier, max("timestamp") AS last FROM ({_MONTHLY_SQL}) GROUP BY 1) USING (identifier),
             (SELECT unnest(generate_series(1, 12)) AS step)""",
)
def baseline(spark, sf):
    return _rounded(
        baseline_forecast(monthly(spark, sf), ["identifier"], "M", 12, _LEVELS), "p10", "p50", "p90", "mean"
    )
