"""Registered queries: run records, datasets, uploads."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandlake.operators import manifest as m
from demandlake.plans import tables as t
from demandlake.plans.registry import query
from demandlake.sources import names

NOW = "2001-08-08 00:00:00"


@query(
    "latest_active_run",
    f"""SELECT * FROM ({t.RUNS_SQL}) WHERE status = 'ACTIVE'
        QUALIFY row_number() OVER (PARTITION BY kind, parent ORDER BY created DESC, run DESC) = 1""",
)
def latest_active_run(spark, sf):
    return m.latest_active_run(t.runs(spark, sf))


@query(
    "run_history",
    f"""SELECT *, row_number() OVER (PARTITION BY kind, parent ORDER BY modified DESC, run DESC) AS position
        FROM ({t.RUNS_SQL})""",
)
def run_history(spark, sf):
    return m.run_history(t.runs(spark, sf), ["kind", "parent"], by="modified")


@query(
    "run_history_created",
    f"""SELECT *, row_number() OVER (PARTITION BY parent ORDER BY created DESC, run DESC) AS position
        FROM ({t.RUNS_SQL}) WHERE status = 'ACTIVE'""",
)
def run_history_created(spark, sf):
    return m.run_history(t.runs(spark, sf), by="created", status="ACTIVE")


@query(
    "latest_change",
    f"""SELECT "group", max(modified) AS latest_modified,
               strftime(max(modified), '%Y_%m_%d_%H_%M_%S') AS latest_stamp
        FROM ({t.DATASETS_SQL}) GROUP BY 1""",
)
def latest_change(spark, sf):
    return m.latest_change(t.datasets(spark, sf))


_IMPORTED_SQL = f"(SELECT DISTINCT parent FROM ({t.RUNS_SQL}) WHERE status = 'ACTIVE')"


@query(
    "readiness",
    f"""SELECT *, not_active = 0 AND not_imported = 0 AS ready FROM (
          SELECT "group", count(*) AS datasets,
                 count(*) FILTER (status <> 'ACTIVE') AS not_active,
                 count(*) FILTER (dataset NOT IN {_IMPORTED_SQL}) AS not_imported
          FROM ({t.DATASETS_SQL}) GROUP BY 1)""",
)
def readiness(spark, sf):
    return m.readiness(t.datasets(spark, sf), t.runs(spark, sf))


@query(
    "readiness_offenders",
    f"""WITH d AS ({t.DATASETS_SQL})
        SELECT "group", dataset, 'status ' || status AS reason FROM d WHERE status <> 'ACTIVE'
        UNION ALL
        SELECT "group", dataset, 'no active import' FROM d
        WHERE "group" NOT IN (SELECT "group" FROM d WHERE status <> 'ACTIVE')
          AND dataset NOT IN {_IMPORTED_SQL}""",
)
def readiness_offenders(spark, sf):
    return m.readiness_offenders(t.datasets(spark, sf), t.runs(spark, sf))


_CHANGED_SQL = f"""(SELECT "group", max(modified) AS data_modified FROM ({t.DATASETS_SQL}) GROUP BY 1)"""


@query(
    "retrain_needed",
    f"""WITH groups AS (SELECT DISTINCT "group" FROM ({t.DATASETS_SQL})),
             last AS (SELECT * FROM ({t.GROUP_RUNS_SQL}) WHERE kind = 'predictor'
                      QUALIFY row_number() OVER (PARTITION BY "group" ORDER BY created DESC, run DESC) = 1)
        SELECT "group", run, reason, reason <> 'up to date' AS retrain FROM (
          SELECT "group", run, CASE WHEN run IS NULL THEN 'no predictor'
                 WHEN contains(status, 'FAILED') THEN 'last predictor failed'
                 WHEN data_modified > modified AND modified < TIMESTAMP '{NOW}' - INTERVAL 604800 SECOND
                   THEN 'too old for changed data'
                 ELSE 'up to date' END AS reason
          FROM groups LEFT JOIN last USING ("group") LEFT JOIN {_CHANGED_SQL} USING ("group"))""",
)
def retrain_needed(spark, sf):
    datasets = t.datasets(spark, sf)
    predictors = t.group_runs(spark, sf).where(F.col("kind") == "predictor")
    return m.retrain_needed(
        datasets.select("group").distinct(), predictors, datasets, F.lit(NOW).cast("timestamp")
    )


@query(
    "forecast_stale",
    f"""WITH runs AS ({t.GROUP_RUNS_SQL}),
             forecasts AS (SELECT "group", predictor, run, created, modified FROM runs
                           WHERE kind <> 'import'),
             current AS (SELECT "group", predictor FROM runs WHERE status <> 'CREATE_FAILED'
                         QUALIFY row_number() OVER (PARTITION BY "group" ORDER BY created DESC, run DESC) = 1),
             last AS (SELECT * FROM forecasts
                      QUALIFY row_number() OVER (PARTITION BY "group", predictor ORDER BY modified DESC, run DESC) = 1)
        SELECT "group", predictor, reason, reason <> 'fresh' AS stale FROM (
          SELECT current.*, CASE
                 WHEN "group" NOT IN (SELECT "group" FROM forecasts) THEN 'no forecast'
                 WHEN run IS NULL THEN 'other predictor'
                 WHEN data_modified > created THEN 'data changed' ELSE 'fresh' END AS reason
          FROM current LEFT JOIN last USING ("group", predictor) LEFT JOIN {_CHANGED_SQL} USING ("group"))""",
)
def forecast_stale(spark, sf):
    runs = t.group_runs(spark, sf)
    forecasts = runs.where(F.col("kind") != "import")
    current = m.newest(
        runs.where(F.col("status") != "CREATE_FAILED").select("group", "predictor", "run", "created"),
        ["group"],
        "created",
        "run",
    )
    return m.forecast_stale(current, forecasts, t.datasets(spark, sf))


_SIGNATURE_SQL = """
    SELECT dataset, md5(CAST(count(*) AS VARCHAR) || ':' ||
           CAST(sum(CAST(('0x' || substr(md5(line), 1, 15)) AS HUGEINT)) AS VARCHAR)) AS signature
    FROM ({lines}) GROUP BY dataset"""
_LINE_SQL = "CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR) || ',' || CAST({quantity} AS VARCHAR)"
_NOW_SQL = _SIGNATURE_SQL.format(
    lines=f"SELECT l_suppkey AS dataset, {_LINE_SQL.format(quantity='l_quantity')} AS line FROM lineitem"
)
_BEFORE_SQL = _SIGNATURE_SQL.format(
    lines=f"""SELECT l_suppkey AS dataset,
              {_LINE_SQL.format(quantity="CASE WHEN s_acctbal > 5000 AND l_quantity = 7 THEN 8.0 ELSE l_quantity END")} AS line
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
)


@query(
    "content_changed",
    f"""WITH imports AS (SELECT s_suppkey AS dataset,
               CASE WHEN s_acctbal < 1000 THEN 'CREATE_FAILED' ELSE 'ACTIVE' END AS status,
               CASE WHEN s_acctbal < 3000 THEN NULL ELSE signature END AS old
             FROM supplier JOIN ({_BEFORE_SQL}) ON dataset = s_suppkey WHERE s_acctbal < 9000)
        SELECT dataset, reason, reason IN ('never imported', 'no signature', 'changed') AS reimport FROM (
          SELECT n.dataset, CASE WHEN status IS NULL THEN 'never imported'
                 WHEN status <> 'ACTIVE' THEN 'import not active' WHEN old IS NULL THEN 'no signature'
                 WHEN old <> signature THEN 'changed' ELSE 'same' END AS reason
          FROM ({_NOW_SQL}) n LEFT JOIN imports USING (dataset))""",
)
def content_changed(spark, sf):
    """Suppliers are datasets, their line items the lines; some quantities differ from the last import."""
    items = t.table(spark, sf, "lineitem")
    supplier = t.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("dataset"), "s_acctbal")

    def line(quantity):
        return F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), quantity.cast("string"))

    current = m.content_signature(
        items.select(F.col("l_suppkey").alias("dataset"), line(F.col("l_quantity")).alias("value")), ["dataset"]
    )
    old = F.when((F.col("s_acctbal") > 5000) & (F.col("l_quantity") == 7), F.lit(8.0)).otherwise(F.col("l_quantity"))
    before = m.content_signature(
        items.withColumn("dataset", F.col("l_suppkey")).join(supplier, "dataset").select("dataset", line(old).alias("value")),
        ["dataset"],
    )
    imports = before.join(supplier.where(F.col("s_acctbal") < 9000), "dataset").select(
        "dataset",
        F.when(F.col("s_acctbal") < 1000, "CREATE_FAILED").otherwise("ACTIVE").alias("status"),
        F.when(F.col("s_acctbal") >= 3000, F.col("signature")).alias("signature"),
    )
    return m.content_changed(current, imports)


@query(
    "latest_upload",
    """SELECT user_id AS "group", max_by(event_id, (ts, event_id)) AS file, max(ts) AS updated,
              count(*) - 1 AS superseded
       FROM events GROUP BY 1""",
)
def latest_upload(spark, sf):
    uploads = t.table(spark, sf, "events").select(
        F.col("user_id").alias("group"), F.col("event_id").alias("file"), F.col("ts").alias("updated")
    )
    return m.latest_upload(uploads)


@query(
    "dependents",
    """SELECT c_custkey AS "group", c_custkey AS dependent FROM customer
       UNION SELECT CAST(c_nationkey AS BIGINT), c_custkey FROM customer WHERE c_acctbal < 0""",
)
def dependents(spark, sf):
    groups = t.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("group"),
        F.when(F.col("c_acctbal") < 0, F.col("c_nationkey").cast("bigint")).alias("from_group"),
    )
    return m.dependents(groups)


@query(
    "schema_drift",
    """SELECT dataset, concat_ws(',', a, b, c, d, e) AS differences FROM (
         SELECT p_partkey AS dataset,
                CASE WHEN p_size > 45 THEN 'dataset_type' END AS a, CASE WHEN p_size < 5 THEN 'domain' END AS b,
                CASE WHEN p_brand = 'Brand#3' THEN 'frequency' END AS c,
                CASE WHEN p_brand IN ('Brand#3', 'Brand#4') THEN 'schema' END AS d,
                CASE WHEN p_type = 'SMALL' THEN 'group_domain' END AS e FROM part)
       WHERE differences <> ''""",
)
def schema_drift(spark, sf):
    part = t.table(spark, sf, "part")
    size, brand = F.col("p_size"), F.col("p_brand")
    requested = part.select(
        F.col("p_partkey").alias("dataset"),
        F.col("p_type").alias("group"),
        F.lit("TARGET_TIME_SERIES").alias("dataset_type"),
        F.lit("RETAIL").alias("domain"),
        F.lit("D").alias("frequency"),
        F.lit("item_id,timestamp,demand").alias("schema"),
    )
    existing = part.select(
        F.col("p_partkey").alias("dataset"),
        F.when(size > 45, "RELATED_TIME_SERIES").otherwise("TARGET_TIME_SERIES").alias("dataset_type"),
        F.when(size < 5, "CUSTOM").otherwise("RETAIL").alias("domain"),
        F.when(brand == "Brand#3", F.lit(None)).otherwise("D").alias("frequency"),
        F.when(brand.isin("Brand#3", "Brand#4"), "timestamp,item_id,demand")
        .otherwise("item_id,timestamp,demand")
        .alias("schema"),
    )
    groups = part.select(F.col("p_type").alias("group")).distinct().withColumn(
        "group_domain", F.when(F.col("group") == "SMALL", "CUSTOM").otherwise("RETAIL")
    )
    return m.schema_drift(existing, requested, groups).withColumn(
        "differences", F.concat_ws(",", "differences")
    )


# Which dataset type a market segment stands for.
_TYPES = {
    "AUTOMOBILE": "TARGET_TIME_SERIES",
    "BUILDING": "RELATED_TIME_SERIES",
    "FURNITURE": "TARGET_TIME_SERIES",
    "HOUSEHOLD": "ITEM_METADATA",
    "MACHINERY": "RELATED_TIME_SERIES",
}


@query(
    "spec_checks",
    f"""WITH c AS (SELECT "group", {t._choose_sql("segment", _TYPES)} AS dataset_type FROM ({t.DATASETS_SQL})),
             n AS (SELECT "group", dataset_type, count(*) AS copies FROM c GROUP BY 1, 2)
        SELECT *, has_target AND duplicate_types = 0 AS valid FROM (
          SELECT "group", bool_or(dataset_type = 'TARGET_TIME_SERIES') AS has_target,
                 count(*) FILTER (copies > 1) AS duplicate_types FROM n GROUP BY 1)""",
)
def spec_checks(spark, sf):
    configured = t.datasets(spark, sf).select("group", t._choose("segment", _TYPES).alias("dataset_type"))
    return m.required_datasets(configured)


_AUTO_SQL = "predictor = '1-URGENT'"


@query(
    "run_names",
    f"""SELECT run, parent || '_' || stamp AS import_name,
               CASE WHEN auto THEN parent || '_auto_' || stamp ELSE parent || '_' || stamp END AS predictor_name,
               CASE WHEN auto THEN 'export_' || parent || '_auto_' || made ELSE 'export_' || parent || '_' || made END AS backtest_export_name,
               CASE WHEN auto THEN 'forecast_ap_' || parent || '_' || stamp ELSE 'forecast_' || parent || '_' || stamp END AS forecast_name,
               CASE WHEN auto THEN 'export_ap_' || parent || '_' || stamp ELSE 'export_' || parent || '_' || stamp END AS forecast_export_name
        FROM (SELECT run, 'group_' || CAST(parent AS VARCHAR) AS parent, {_AUTO_SQL} AS auto,
                     strftime(modified, '%Y_%m_%d_%H_%M_%S') AS stamp, strftime(created, '%Y_%m_%d_%H_%M_%S') AS made
              FROM ({t.RUNS_SQL}))""",
)
def run_names(spark, sf):
    group = F.concat(F.lit("group_"), F.col("parent").cast("string"))
    automatic = F.col("predictor") == "1-URGENT"
    return t.runs(spark, sf).select(
        "run",
        names.import_name(group, F.col("modified")).alias("import_name"),
        names.predictor_name(group, F.col("modified"), automatic).alias("predictor_name"),
        names.backtest_export_name(group, F.col("created"), automatic).alias("backtest_export_name"),
        names.forecast_name(group, F.col("modified"), automatic).alias("forecast_name"),
        names.forecast_export_name(group, F.col("modified"), automatic).alias("forecast_export_name"),
    )


@query(
    "latest_run_names",
    f"""WITH last AS (SELECT "group", created, {_AUTO_SQL} AS auto FROM ({t.GROUP_RUNS_SQL})
                      QUALIFY row_number() OVER (PARTITION BY "group" ORDER BY created DESC, run DESC) = 1),
             named AS (SELECT "group", coalesce(auto, false) AS auto, strftime(max(modified), '%Y_%m_%d_%H_%M_%S') AS stamp,
                              strftime(created, '%Y_%m_%d_%H_%M_%S') AS made
                       FROM ({t.DATASETS_SQL}) LEFT JOIN last USING ("group") GROUP BY "group", auto, created)
        SELECT "group", "group" || CASE WHEN auto THEN '_auto_' ELSE '_' END || stamp AS predictor_name,
               'export_' || "group" || CASE WHEN auto THEN '_auto_' ELSE '_' END || made AS backtest_export_name,
               'forecast_' || CASE WHEN auto THEN 'ap_' ELSE '' END || "group" || '_' || stamp AS forecast_name,
               'export_' || CASE WHEN auto THEN 'ap_' ELSE '' END || "group" || '_' || stamp AS forecast_export_name
        FROM named""",
)
def latest_run_names(spark, sf):
    """Names of the next runs of each group, from its newest dataset change and its newest run."""
    predictors = t.group_runs(spark, sf).withColumn("automatic", F.col("predictor") == "1-URGENT")
    return m.latest_names(t.datasets(spark, sf), predictors)


@query(
    "required_by_default",
    f"""WITH own AS (SELECT "group", count(*) FILTER (segment <> 'BUILDING') AS configured, bool_or(segment = 'FURNITURE') AS target,
                            count(*) FILTER (segment <> 'BUILDING') - count(DISTINCT segment) FILTER (segment <> 'BUILDING') AS more
                     FROM ({t.DATASETS_SQL}) GROUP BY 1),
             copies AS (SELECT "group", count(*) FILTER (n > 1) AS duplicate_types FROM (
                          SELECT "group", segment, count(*) AS n FROM ({t.DATASETS_SQL}) WHERE segment <> 'BUILDING' GROUP BY 1, 2) GROUP BY 1)
        SELECT own."group", configured = 0 OR target AS has_target, coalesce(duplicate_types, 0) AS duplicate_types,
               (configured = 0 OR target) AND coalesce(duplicate_types, 0) = 0 AS valid
        FROM own LEFT JOIN copies USING ("group")""",
)
def required_by_default(spark, sf):
    """Every group, those without a configured type included: they need a target series, and nothing else."""
    datasets = t.datasets(spark, sf)
    kind = F.when(F.col("segment") == "FURNITURE", "TARGET_TIME_SERIES").otherwise(F.col("segment"))
    configured = datasets.where(F.col("segment") != "BUILDING").select("group", kind.alias("dataset_type"))
    return m.required_datasets(m.with_default_types(datasets, configured))


@query(
    "export_path",
    f"""SELECT run, kind, CASE kind WHEN 'import' THEN 's3://demand/train/' || CAST(parent AS VARCHAR) || '.csv'
               WHEN 'backtest_export' THEN 's3://demand/exports/' || CAST(run AS VARCHAR) || '/forecasted-values'
               ELSE 's3://demand/exports/' || CAST(run AS VARCHAR) END AS path
        FROM ({t.RUNS_SQL})""",
)
def export_path(spark, sf):
    kind = F.col("kind")
    destination = F.when(kind != "import", F.concat(F.lit("s3://demand/exports/"), F.col("run").cast("string")))
    source = F.when(kind == "import", F.concat(F.lit("s3://demand/train/"), F.col("parent").cast("string"), F.lit(".csv")))
    return t.runs(spark, sf).select("run", "kind", names.data_path(kind, destination, source).alias("path"))
