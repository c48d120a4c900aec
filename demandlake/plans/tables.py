"""The given tables in the roles the operators expect, and the same as SQL fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.operators.bucket import bucket
from demandlake.operators.clean import clean_export, clean_input, map_export
from demandlake.spec import DatasetSpec

TARGET_SPEC = DatasetSpec.of(
    "RETAIL", item_id="string", timestamp="timestamp", location="string", demand="float"
)
RELATED_SPEC = DatasetSpec.of("RETAIL", item_id="string", timestamp="timestamp", price="float")
METADATA_SPEC = DatasetSpec.of("RETAIL", item_id="string", brand="string", category="string")

# The backtest covers the weeks from the first date, the forecast those from the second.
BACKTEST_FROM = "2001-01-01"
FORECAST_FROM = "2001-07-02"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned daily demand per part, with the return flag as its location."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("identifier"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.col("l_returnflag").alias("location"),
        F.col("l_quantity").alias("metric"),
    )


DEMAND_SQL = """
    SELECT CAST(l_partkey AS VARCHAR) AS identifier, l_shipdate AS "timestamp",
           l_returnflag AS location, l_quantity AS metric
    FROM lineitem"""


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned activity per event type, at second precision and finer."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("identifier"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").cast("string").alias("user"),
        F.round(F.col("value") * 100).alias("metric"),
    )


# -- dirty text ---------------------------------------------------------------------------


def dirty_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand as text by position, with blanks, bad numbers and bad timestamps by discount and tax."""
    line = table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("timestamp")
    discount, tax = F.col("l_discount"), F.col("l_tax")
    return line.select(
        F.when(tax == 0.08, F.lit(None)).otherwise(F.col("l_partkey").cast("string")).alias("_c0"),
        F.when(discount == 0.0, "01:01:01")
        .when(discount == 0.01, "2000-13-45")
        .when(discount == 0.02, F.lit(None))
        .when(discount == 0.03, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(discount == 0.04, F.date_format(day, "yyyy-M-d"))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .alias("_c1"),
        F.col("l_returnflag").alias("_c2"),
        F.when(tax == 0.0, F.lit(None))
        .when(tax == 0.01, "n/a")
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("_c3"),
    )


DIRTY_SQL = """
    SELECT CASE WHEN l_tax = 0.08 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS _c0,
           CASE WHEN l_discount = 0.0 THEN '01:01:01'
                WHEN l_discount = 0.01 THEN '2000-13-45'
                WHEN l_discount = 0.02 THEN NULL
                WHEN l_discount = 0.03 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')
                WHEN l_discount = 0.04 THEN strftime(l_shipdate, '%Y-%-m-%-d')
                ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS _c1,
           l_returnflag AS _c2,
           CASE WHEN l_tax = 0.0 THEN NULL WHEN l_tax = 0.01 THEN 'n/a'
                ELSE CAST(l_quantity AS VARCHAR) END AS _c3
    FROM lineitem"""

SHAPED_SQL = rf"""
    SELECT * FROM ({DIRTY_SQL})
    WHERE regexp_matches(_c1,
        '^\d{{4}}-\d{{1,2}}-\d{{1,2}}$|^\d{{4}}-\d{{1,2}}-\d{{1,2}} \d{{1,2}}:\d{{1,2}}:\d{{1,2}}$')"""

TYPED_SQL = f"""
    SELECT _c0 AS item_id, TRY_CAST(_c1 AS TIMESTAMP) AS "timestamp", _c2 AS location,
           TRY_CAST(_c3 AS DOUBLE) AS demand
    FROM ({SHAPED_SQL})"""

CLEAN_SQL = f"""
    SELECT item_id AS identifier, "timestamp", location, demand AS metric
    FROM ({TYPED_SQL}) WHERE item_id IS NOT NULL AND "timestamp" IS NOT NULL AND location IS NOT NULL"""


# -- exports ------------------------------------------------------------------------------


def _weekly(spark: SparkSession, sf_dir: str, start: str, end: str | None) -> DataFrame:
    weeks = bucket(demand(spark, sf_dir), "W", ["location"])
    ts = F.col("timestamp")
    weeks = weeks.where(ts >= F.lit(start).cast("timestamp"))
    return weeks if end is None else weeks.where(ts < F.lit(end).cast("timestamp"))


def _quantile_text() -> list[Column]:
    return [
        (F.col("metric") * share).cast("string").alias(name)
        for name, share in (("p10", 0.5), ("p50", 1.0), ("p90", 1.5))
    ]


def _with_copies(df: DataFrame) -> DataFrame:
    """Rows of location A come twice, as exports written in parts may repeat them."""
    return df.unionByName(df.where(F.col("location") == "A"))


def raw_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backtest export: all text, one repeated location, window columns, ISO timestamps."""
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _with_copies(
        _weekly(spark, sf_dir, BACKTEST_FROM, FORECAST_FROM).select(
            F.col("identifier").alias("item_id"),
            iso.alias("timestamp"),
            F.col("metric").cast("string").alias("target_value"),
            F.lit("2001-01-01T00:00:00").alias("backtestwindow_start_time"),
            F.lit("2001-07-02T00:00:00").alias("backtestwindow_end_time"),
            "location",
            *_quantile_text(),
        )
    )


def raw_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast export: as the backtest without target and window."""
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _with_copies(
        _weekly(spark, sf_dir, FORECAST_FROM, None).select(
            F.col("identifier").alias("item_id"), iso.alias("date"), "location", *_quantile_text()
        )
    )


def backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_export(raw_backtest(spark, sf_dir), TARGET_SPEC, backtest=True)


def backtest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backtest with its duplicates: the same timestamps, and no shuffle to find them."""
    return map_export(raw_backtest(spark, sf_dir), TARGET_SPEC, backtest=True)


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_export(raw_forecast(spark, sf_dir), TARGET_SPEC, backtest=False)


WEEKLY_SQL = f"""
    SELECT identifier, location, CAST(date_trunc('week', "timestamp") AS TIMESTAMP) AS "timestamp",
           sum(metric) AS metric
    FROM ({DEMAND_SQL}) GROUP BY 1, 2, 3"""

BACKTEST_SQL = f"""
    SELECT identifier, "timestamp", metric, location,
           metric * 0.5 AS p10, metric * 1.0 AS p50, metric * 1.5 AS p90
    FROM ({WEEKLY_SQL})
    WHERE "timestamp" >= TIMESTAMP '{BACKTEST_FROM}' AND "timestamp" < TIMESTAMP '{FORECAST_FROM}'"""

FORECAST_SQL = f"""
    SELECT identifier, "timestamp", location,
           metric * 0.5 AS p10, metric * 1.0 AS p50, metric * 1.5 AS p90
    FROM ({WEEKLY_SQL}) WHERE "timestamp" >= TIMESTAMP '{FORECAST_FROM}'"""


# -- metadata -----------------------------------------------------------------------------


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned item metadata: brand and category per part."""
    raw = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("_c0"), F.col("p_brand").alias("_c1"), F.col("p_type").alias("_c2")
    )
    return clean_input(raw, METADATA_SPEC)


METADATA_SQL = """
    SELECT CAST(p_partkey AS VARCHAR) AS identifier, p_brand AS brand, p_type AS category
    FROM part WHERE p_brand IS NOT NULL AND p_type IS NOT NULL"""


# -- run records --------------------------------------------------------------------------

# What an order's priority and status stand for when orders play run records.
KINDS = {
    "1-URGENT": "import",
    "2-HIGH": "predictor",
    "3-MEDIUM": "forecast",
    "4-NOT SPECIFIED": "backtest_export",
    "5-LOW": "forecast_export",
}
STATUSES = {"F": "ACTIVE", "O": "CREATE_IN_PROGRESS", "P": "CREATE_FAILED"}


def _choose(column: str, choices: dict[str, str]) -> Column:
    chosen = None
    for value, label in choices.items():
        chosen = F.when(F.col(column) == value, label) if chosen is None else chosen.when(F.col(column) == value, label)
    return chosen


def _choose_sql(column: str, choices: dict[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{v}' THEN '{label}'" for v, label in choices.items()) + " END"


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as run records: the customer is the parent, modified some hours after creation."""
    created = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        _choose("o_orderpriority", KINDS).alias("kind"),
        F.col("o_orderkey").alias("run"),
        F.col("o_custkey").alias("parent"),
        _choose("o_orderstatus", STATUSES).alias("status"),
        created.alias("created"),
        (created + F.make_dt_interval(secs=F.floor("o_totalprice"))).alias("modified"),
        F.col("o_orderpriority").alias("predictor"),
    )


RUNS_SQL = f"""
    SELECT {_choose_sql("o_orderpriority", KINDS)} AS kind, o_orderkey AS run, o_custkey AS parent,
           {_choose_sql("o_orderstatus", STATUSES)} AS status, o_orderdate AS created,
           o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) AS modified,
           o_orderpriority AS predictor
    FROM orders"""


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as datasets, in groups of a nation and a balance band."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("dataset"),
        F.concat_ws("_", F.col("c_nationkey").cast("string"), F.floor(F.col("c_acctbal") / 1000).cast("string")).alias("group"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "CREATE_PENDING").otherwise("ACTIVE").alias("status"),
        (F.lit("2001-01-01").cast("timestamp") + F.make_dt_interval(hours=F.floor("c_acctbal").cast("int"))).alias("modified"),
        F.col("c_mktsegment").alias("segment"),
    )


DATASETS_SQL = """
    SELECT c_custkey AS dataset,
           CAST(c_nationkey AS VARCHAR) || '_' || CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR) AS "group",
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'CREATE_PENDING' ELSE 'ACTIVE' END AS status,
           TIMESTAMP '2001-01-01' + to_hours(CAST(floor(c_acctbal) AS INTEGER)) AS modified,
           c_mktsegment AS segment
    FROM customer"""


def group_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records with the group of the dataset they belong to."""
    owner = datasets(spark, sf_dir).select(F.col("dataset").alias("parent"), "group")
    return runs(spark, sf_dir).join(owner, "parent")


GROUP_RUNS_SQL = f"""
    SELECT r.*, d."group" FROM ({RUNS_SQL}) r JOIN ({DATASETS_SQL}) d ON r.parent = d.dataset"""
