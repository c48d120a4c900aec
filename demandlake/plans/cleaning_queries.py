"""Registered queries: cleaning, mapping, naming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from demandlake.functions import text
from demandlake.functions.calendar import frequency_rank
from demandlake.operators.attributes import GenericNames, drop_metadata
from demandlake.operators.clean import (
    cast_to_spec,
    clean_input,
    drop_null_columns,
    filter_timestamps,
    normalize_names,
    require_fields,
)
from demandlake.operators.history import split_geolocation, to_utc
from demandlake.operators.manifest import status_classes
from demandlake.plans import tables as t
from demandlake.plans.registry import query
from demandlake.spec import DOMAINS, FREQUENCIES, DatasetSpec


@query("drop_null_fields", "SELECT p_partkey, p_name FROM part")
def drop_null_fields(spark, sf):
    parts = t.table(spark, sf, "part").select("p_partkey", "p_name", F.lit(None).alias("nothing"))
    return drop_null_columns(parts)


@query("filter_timestamps", t.SHAPED_SQL)
def shaped(spark, sf):
    return filter_timestamps(t.dirty_demand(spark, sf), t.TARGET_SPEC)


@query("cast_input", t.TYPED_SQL)
def typed(spark, sf):
    return cast_to_spec(filter_timestamps(t.dirty_demand(spark, sf), t.TARGET_SPEC), t.TARGET_SPEC)


@query(
    "required_fields",
    f"""SELECT * FROM ({t.TYPED_SQL})
        WHERE item_id IS NOT NULL AND "timestamp" IS NOT NULL AND location IS NOT NULL""",
)
def required(spark, sf):
    return require_fields(typed(spark, sf), ["item_id", "timestamp", "location"])


@query("clean_input", t.CLEAN_SQL)
def cleaned(spark, sf):
    return clean_input(t.dirty_demand(spark, sf), t.TARGET_SPEC)


@query(
    "related_series",
    """SELECT CAST(l_partkey AS VARCHAR) AS identifier, l_shipdate AS "timestamp",
              l_extendedprice AS price
       FROM lineitem WHERE l_discount <> 0.02""",
)
def related(spark, sf):
    line = t.table(spark, sf, "lineitem")
    day = F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd")
    raw = line.select(
        F.col("l_partkey").cast("string").alias("_c0"),
        F.when(F.col("l_discount") != 0.02, day).alias("_c1"),
        F.col("l_extendedprice").cast("string").alias("_c2"),
    )
    return clean_input(raw, t.RELATED_SPEC)


@query(
    "domain_normalize",
    f"""SELECT d.domain, identifier, sum(metric) AS metric
        FROM ({t.DEMAND_SQL}), (VALUES {", ".join(f"('{d}')" for d in DOMAINS)}) AS d(domain)
        GROUP BY ALL""",
)
def domains(spark, sf):
    """Total demand per part, once in the field names of each domain; the totals are computed once.

    Parts become text after the totals only: frames that are still dealt by their identifier would be united
    partition by partition, and one task would read the totals of all domains.
    """
    totals = t.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("total"))
    frames = []
    for domain, (identifier, target) in DOMAINS.items():
        spec = DatasetSpec.of(domain, **{identifier: "string", target: "float"})
        named = totals.select(F.col("l_partkey").cast("string").alias(identifier), F.col("total").alias(target))
        frames.append(normalize_names(named, spec).withColumn("domain", F.lit(domain)))
    return reduce(lambda a, b: a.unionByName(b), frames)


_TEXT_QUANTILES = "CAST(p10 AS VARCHAR) AS p10, CAST(p50 AS VARCHAR) AS p50, CAST(p90 AS VARCHAR) AS p90"


@query(
    "dedup_exports",
    f"""SELECT identifier AS item_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%SZ') AS date, location,
               {_TEXT_QUANTILES}
        FROM ({t.FORECAST_SQL})""",
)
def dedup_exports(spark, sf):
    return t.raw_forecast(spark, sf).distinct()


@query("map_backtest", t.BACKTEST_SQL)
def map_backtest(spark, sf):
    return t.backtest(spark, sf)


@query("map_forecast", t.FORECAST_SQL)
def map_forecast(spark, sf):
    return t.forecast(spark, sf)


def _named_export(spark, sf):
    """A forecast that also returns the brand, as exports without dimensions may."""
    brand = t.metadata(spark, sf).select("identifier", "brand")
    frame = t.forecast(spark, sf).join(brand, "identifier")
    names = GenericNames.for_spec(t.TARGET_SPEC, t.METADATA_SPEC)
    names = names.discover(["identifier", "timestamp", "location", "metric"]).discover(frame.columns)
    return frame.withColumnsRenamed(names.renames(frame.columns))


_NAMED_SQL = f"""
    SELECT f.identifier, "timestamp", location AS dimension_1, brand AS metadata_1, p10, p50, p90
    FROM ({t.FORECAST_SQL}) f JOIN ({t.METADATA_SQL}) m ON f.identifier = m.identifier"""


@query("generic_attrs", _NAMED_SQL)
def generic_attrs(spark, sf):
    return _named_export(spark, sf)


@query("drop_metadata", f"SELECT * EXCLUDE (metadata_1) FROM ({_NAMED_SQL})")
def metadata_dropped(spark, sf):
    return drop_metadata(_named_export(spark, sf))


# -- text ---------------------------------------------------------------------------------


@query(
    "validate_dates",
    r"""WITH given AS (
          SELECT o_orderkey, CASE o_orderpriority
              WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
              WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
              WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y/%m/%d')
              WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%SZ')
              ELSE strftime(o_orderdate, '%Y-%m-32') END AS given FROM orders)
       SELECT o_orderkey, given, CASE WHEN regexp_matches(given,
              '^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$|^\d{4}-\d{2}-\d{2}$')
              THEN TRY_CAST(given AS TIMESTAMP) END AS start_date FROM given""",
)
def validate_dates(spark, sf):
    day = F.col("o_orderdate").cast("timestamp")
    priority = F.col("o_orderpriority")
    given = (
        F.when(priority == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
        .when(priority == "2-HIGH", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(priority == "3-MEDIUM", F.date_format(day, "yyyy/MM/dd"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(day, "yyyy-MM-dd HH:mm:ss'Z'"))
        .otherwise(F.date_format(day, "yyyy-MM-'32'"))
    )
    return (
        t.table(spark, sf, "orders")
        .select("o_orderkey", given.alias("given"))
        .withColumn("start_date", text.start_date(F.col("given")))
    )


@query(
    "validate_names",
    r"""SELECT lang, count(*) AS words,
               count(*) FILTER (regexp_matches(word, '^[a-zA-Z][\p{L}\p{N}_]{0,62}$')) AS valid_names
        FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY lang""",
)
def validate_names(spark, sf):
    words = t.table(spark, sf, "documents").select("lang", F.explode_outer(F.split("text", " ")).alias("word"))
    return words.groupBy("lang").agg(
        F.count(F.lit(1)).alias("words"), F.count_if(text.is_valid_name(F.col("word"))).alias("valid_names")
    )


_KEY_SQL = """
    SELECT c_custkey, 'train/' || c_mktsegment || '/' || replace(c_name, '#', '%23+') ||
           CASE c_mktsegment WHEN 'BUILDING' THEN '.related.csv' WHEN 'MACHINERY' THEN '.metadata.csv'
                             WHEN 'FURNITURE' THEN '.v2.csv' ELSE '.csv' END AS "key"
    FROM customer"""


def _keys(spark, sf):
    segment = F.col("c_mktsegment")
    ending = (
        F.when(segment == "BUILDING", ".related.csv")
        .when(segment == "MACHINERY", ".metadata.csv")
        .when(segment == "FURNITURE", ".v2.csv")
        .otherwise(".csv")
    )
    name = F.replace("c_name", F.lit("#"), F.lit("%23+"))
    return t.table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("train/"), segment, F.lit("/"), name, ending).alias("key")
    )


@query(
    "route_files",
    f"""SELECT c_custkey, "key",
               CASE WHEN suffix(k, '.related.csv') THEN 'RELATED_TIME_SERIES'
                    WHEN suffix(k, '.metadata.csv') THEN 'ITEM_METADATA' ELSE 'TARGET_TIME_SERIES' END AS dataset_type,
               split_part(f, '.', 1) AS prefix,
               split_part(f, '.', 1) || CASE WHEN suffix(k, '.related.csv') THEN '_related'
                    WHEN suffix(k, '.metadata.csv') THEN '_metadata' ELSE '' END AS dataset_name
        FROM (SELECT *, "key" AS k, split_part("key", '/', -1) AS f FROM ({_KEY_SQL}))""",
)
def route_files(spark, sf):
    key = F.col("key")
    return _keys(spark, sf).select(
        "c_custkey",
        "key",
        text.dataset_type(key).alias("dataset_type"),
        text.file_prefix(key).alias("prefix"),
        text.dataset_name(key).alias("dataset_name"),
    )


@query(
    "parse_keys",
    f"""SELECT c_custkey, 's3://demand/' || replace(replace("key", '+', ' '), '%23', '#') AS url,
               'demand' AS bucket, replace(replace("key", '+', ' '), '%23', '#') AS decoded,
               's3://demand/train/' || split_part("key", '/', 2) || '/' AS folder,
               replace(replace(split_part("key", '/', 3), '+', ' '), '%23', '#') AS file_name
        FROM ({_KEY_SQL})""",
)
def parse_keys(spark, sf):
    url = F.col("url")
    return (
        _keys(spark, sf)
        .select("c_custkey", F.concat(F.lit("s3://demand/"), text.decoded_key(F.col("key"))).alias("url"))
        .select(
            "c_custkey",
            "url",
            text.url_bucket(url).alias("bucket"),
            text.url_key(url).alias("decoded"),
            text.url_folder(url).alias("folder"),
            text.file_name(url).alias("file_name"),
        )
    )


# Three stages of each of the actions a status can be about.
_STATUS_BY_ORDER = {"F": "FAILED", "O": "IN_PROGRESS", "P": "PENDING"}
_ACTION_BY_PRIORITY = {"1-URGENT": "CREATE", "2-HIGH": "UPDATE", "3-MEDIUM": "DELETE"}


@query(
    "status_class",
    f"""WITH s AS (SELECT coalesce({t._choose_sql("o_orderpriority", _ACTION_BY_PRIORITY)} || '_' ||
                   {t._choose_sql("o_orderstatus", _STATUS_BY_ORDER)}, 'ACTIVE') AS status FROM orders)
        SELECT status, status = 'ACTIVE' AS finalized,
               contains(status, 'PENDING') OR contains(status, 'IN_PROGRESS') AS updating,
               contains(status, 'FAILED') AS failed, count(*) AS runs
        FROM s GROUP BY status""",
)
def status_class(spark, sf):
    status = F.coalesce(
        F.concat(
            t._choose("o_orderpriority", _ACTION_BY_PRIORITY),
            F.lit("_"),
            t._choose("o_orderstatus", _STATUS_BY_ORDER),
        ),
        F.lit("ACTIVE"),
    )
    counted = (
        t.table(spark, sf, "orders").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("runs"))
    )
    return counted.select("status", *status_classes(F.col("status")), "runs")


# What orders stand for when they play pairs of frequencies.
_DATA_FREQUENCY = {"F": "1min", "O": "H", "P": "30s"}
_FORECAST_FREQUENCY = {"1-URGENT": "Y", "2-HIGH": "W", "3-MEDIUM": "H", "4-NOT SPECIFIED": "5min", "5-LOW": "1min"}


@query(
    "freq_order",
    f"""WITH f AS (SELECT {t._choose_sql("o_orderstatus", _DATA_FREQUENCY)} AS data_frequency,
                          {t._choose_sql("o_orderpriority", _FORECAST_FREQUENCY)} AS forecast_frequency
                   FROM orders),
             r AS (SELECT *, list_position([{", ".join(f"'{f}'" for f in FREQUENCIES)}], data_frequency) AS a,
                          list_position([{", ".join(f"'{f}'" for f in FREQUENCIES)}], forecast_frequency) AS b FROM f)
        SELECT data_frequency, forecast_frequency, a AS data_rank, b AS forecast_rank,
               a >= b AS usable, count(*) AS datasets
        FROM r GROUP BY ALL""",
)
def freq_order(spark, sf):
    pairs = t.table(spark, sf, "orders").select(
        t._choose("o_orderstatus", _DATA_FREQUENCY).alias("data_frequency"),
        t._choose("o_orderpriority", _FORECAST_FREQUENCY).alias("forecast_frequency"),
    )
    counted = pairs.groupBy("data_frequency", "forecast_frequency").agg(F.count(F.lit(1)).alias("datasets"))
    return counted.select(
        "data_frequency",
        "forecast_frequency",
        frequency_rank(F.col("data_frequency")).alias("data_rank"),
        frequency_rank(F.col("forecast_frequency")).alias("forecast_rank"),
        (frequency_rank(F.col("data_frequency")) >= frequency_rank(F.col("forecast_frequency"))).alias("usable"),
        "datasets",
    )


@query(
    "geolocation",
    """WITH g AS (SELECT c_custkey, c_mktsegment, c_acctbal / 100 AS lat, c_acctbal / 50 AS lon FROM customer)
       SELECT c_custkey,
              CASE WHEN c_mktsegment <> 'MACHINERY' AND lat BETWEEN -90 AND 90 THEN lat END AS latitude,
              CASE WHEN c_mktsegment <> 'MACHINERY' AND lon BETWEEN -180 AND 180 THEN lon END AS longitude
       FROM g""",
)
def geolocation(spark, sf):
    place = F.concat_ws(
        "_",
        (F.col("c_acctbal") / 100).cast("string"),
        F.when(F.col("c_mktsegment") != "MACHINERY", (F.col("c_acctbal") / 50).cast("string")),
    )
    places = t.table(spark, sf, "customer").select("c_custkey", place.alias("geolocation"))
    return split_geolocation(places, "geolocation").select("c_custkey", "latitude", "longitude")


# wall time at noon, which exists once on every day in every zone used
@query(
    "timezone",
    """SELECT o_orderkey, zone,
              ((o_orderdate + INTERVAL 12 HOUR) AT TIME ZONE zone) AT TIME ZONE 'UTC' AS "timestamp"
       FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'America/New_York'
                       WHEN 'O' THEN 'Europe/Paris' ELSE 'Asia/Kolkata' END AS zone FROM orders)""",
)
def timezone(spark, sf):
    zone = (
        F.when(F.col("o_orderstatus") == "F", "America/New_York")
        .when(F.col("o_orderstatus") == "O", "Europe/Paris")
        .otherwise("Asia/Kolkata")
    )
    local = t.table(spark, sf, "orders").select(
        "o_orderkey",
        zone.alias("zone"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=F.lit(12))).alias("timestamp"),
    )
    return to_utc(local, "timestamp", F.col("zone"))
