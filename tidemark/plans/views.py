"""Platform tables derived from the driver's test tables.

The reference keeps runs, pipelines, connections, schedules, edges and the
drift log in a metadata database. For tests and benchmarks they are
derived deterministically from the given tables, so their size grows with
the data. The same definitions are written as SQL in ``__spark_entry__``.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import plus_seconds, ts_lit

AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)
TARGET_CUTOFF = _dt.datetime(2000, 1, 1)
BATCH_SINCE = _dt.datetime(1999, 7, 1)
BATCH_STATUS = "Z"
DUP_KEY = "l_orderkey"
DUP_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_TARGET_BEFORE = _dt.datetime(1998, 1, 1)
LINE_BATCH_SINCE = _dt.datetime(1997, 1, 1)
ERROR_REPEAT = 250

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All test tables; opened concurrently (each open lists files and
    reads a footer for the schema, which is latency, not work)."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(16, len(TABLES))) as pool:
        dfs = list(pool.map(lambda t: table(spark, sf_dir, t), TABLES))
    return dict(zip(TABLES, dfs))


def runs(events: DataFrame) -> DataFrame:
    """Run history: one run per event."""
    et = F.col("event_type")
    status = (F.when(et == "error", F.lit("failed"))
              .when(et == "view", F.lit("running")).otherwise(F.lit("complete")))
    ended = F.when(et == "view", F.lit(None).cast("timestamp_ntz")).otherwise(
        plus_seconds(F.col("ts"), (F.col("event_id") % 600).cast("int")))
    rows = F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("bigint")).otherwise(
        F.floor(F.col("value") * 10).cast("bigint"))
    return events.select(F.col("event_id").alias("run_id"),
                         (F.col("user_id") % 10).alias("pipeline_id"),
                         F.col("ts").alias("started_at"), status.alias("status"),
                         ended.alias("ended_at"), rows.alias("rows_loaded"))


def run_patches(events: DataFrame) -> DataFrame:
    """Append-only run-record patches: run = user, arrival order = event id."""
    et = F.col("event_type")
    status = (F.when(et == "error", F.lit("failed"))
              .when(et == "purchase", F.lit("complete"))
              .when(et == "view", F.lit("running")))
    rows = F.when(et == "purchase", F.floor(F.col("value") * 10).cast("bigint"))
    err = F.when(et == "error", F.repeat(F.concat(F.col("props"), F.lit(" ")), ERROR_REPEAT))
    phase = (F.when(et == "click", F.lit(1)).when(et == "signup", F.lit(2))
             .when(et == "purchase", F.lit(3)))
    return events.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"),
                         F.col("ts").alias("patched_at"), status.alias("status"),
                         rows.alias("rows_loaded"), err.alias("error_message"),
                         phase.alias("phase_completed"))


def load_target(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderdate") < ts_lit(TARGET_CUTOFF))


def load_batch(orders: DataFrame) -> DataFrame:
    return (orders.where(F.col("o_orderdate") >= ts_lit(BATCH_SINCE))
            .withColumn("o_orderstatus", F.lit(BATCH_STATUS)))


def pipelines(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return customer.select(
        k.alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("connection_id"),
        (k % 30).alias("destination_connection_id"),
        seg.alias("source_table"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 4 == 1, F.lit(""))
        .otherwise(F.lit("updated_at")).alias("watermark_column"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("id")).alias("merge_key_column"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("analytics")).alias("target_database"),
        F.when(k % 2 == 0, F.lower(seg)).otherwise(F.lit("")).alias("target_schema_name"),
        F.lower(seg).alias("target_table"),
        (F.lit(150) + k % 3 * 50).cast("int").alias("volume_alert_upper_pct"),
        (F.lit(50) - k % 4 * 10).cast("int").alias("volume_alert_lower_pct"),
        plus_seconds(ts_lit("2023-01-01 00:00:00"), k * 60).alias("created_at"),
        (k % 7 != 0).alias("is_active"))


def connections(nation: DataFrame) -> DataFrame:
    k = F.col("n_nationkey")
    wh = F.col("n_regionkey") == 0
    return nation.select(
        k.alias("id"), F.col("n_name").alias("name"),
        F.when(wh, F.lit("snowflake")).otherwise(F.lit("postgresql")).alias("db_type"),
        F.lower(F.col("n_name")).alias("host"),
        F.when(wh, F.lit(443)).otherwise(F.lit(5432)).alias("port"),
        F.lower(F.col("n_name")).alias("db_name"),
        F.lit("loader").alias("db_user"),
        F.concat(F.lit("pw-"), k.cast("string")).alias("db_password"),
        F.when(wh, F.lit("LOAD_WH")).alias("snowflake_warehouse"),
        F.when(wh, F.lit("LOADER")).alias("snowflake_role"),
        F.when(wh & (k % 2 == 0), F.lit("staging")).alias("snowflake_schema"),
        plus_seconds(ts_lit("2023-01-01 00:00:00"), k * 86400).alias("created_at"),
        (k % 6 != 5).alias("is_active"))


def target_connections(nation: DataFrame) -> DataFrame:
    """Connections of another environment: same names, other ids, and the
    nations of region 2 missing."""
    return (connections(nation.where(F.col("n_regionkey") != 2))
            .withColumn("id", F.col("id") + 100))


def schedules(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return (customer.where(k % 2 == 0)
            .select(k.alias("id"), k.alias("pipeline_id"),
                    F.lit("0 2 * * *").alias("cron_expression"),
                    plus_seconds(ts_lit("2023-06-01 00:00:00"), k * 60).alias("created_at")))


def dependencies(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return (customer.where((k >= 2) & (k % 3 != 0))
            .select(k.alias("pipeline_id"), F.floor(k / 2).cast("bigint").alias("depends_on_id")))


def drift_events(events: DataFrame) -> DataFrame:
    """Drift log: one event per source event, for pipeline = user."""
    et = F.col("event_type")
    change = (F.when(et.isin("click", "view"), F.lit("column_added"))
              .when(et.isin("error", "signup"), F.lit("type_changed"))
              .otherwise(F.lit("column_dropped")))
    old = (F.when(change == "type_changed", F.lit("VARCHAR(16777216)"))
           .when(change == "column_dropped", F.lit("NUMBER(38,0)")))
    new = (F.when(change == "type_changed", F.lit("NUMERIC(18,4)"))
           .when(change == "column_added", F.lit("TEXT")))
    status = (F.when((change == "column_added") & (F.col("event_id") % 97 == 0),
                     F.lit("error: column already exists"))
              .when(change == "column_added", F.lit("auto_resolved"))
              .otherwise(F.lit("pending_review")))
    return events.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("pipeline_id"),
        F.col("ts").alias("detected_at"),
        F.concat(F.lit("COL_"), (F.col("event_id") % 13).cast("string")).alias("column_name"),
        change.alias("change_type"), old.alias("old_definition"), new.alias("new_definition"),
        status.alias("status"))


def drift_resolutions(events: DataFrame) -> DataFrame:
    """Dismissals: every third pending-type event is resolved an hour later."""
    return (events.where(F.col("event_type").isin("error", "signup", "purchase")
                         & (F.col("event_id") % 3 == 0))
            .select(F.col("event_id").alias("drift_id"),
                    plus_seconds(F.col("ts"), F.lit(3600)).alias("resolved_at"),
                    F.col("user_id").alias("resolved_by")))


CATALOG_NAMES = ("id", "name", "updated_at", "modified_date", "last_update_ts", "amount", "status",
                 "created_at", "email")
CATALOG_TYPES = ("integer", "bigint", "text", "numeric", "timestamp without time zone", "date",
                 "boolean", "double precision")
TARGET_TYPES = ("NUMBER(38,0)", "VARCHAR(16777216)", "NUMBER(18,4)", "NUMBER(10,2)", "TIMESTAMP_NTZ(9)",
                "DATE", "BOOLEAN", "FLOAT")


def _pick(values, index) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def catalog(customer: DataFrame) -> DataFrame:
    """A source's column catalog: a table of 3 to 8 columns per customer,
    every eleventh a system table."""
    k = F.col("c_custkey")
    i = F.col("ordinal_position")
    name = F.when(k % 11 == 0, F.concat(F.lit("pg_"), k.cast("string"))).otherwise(
        F.concat(F.lit("tab_"), k.cast("string")))
    return (customer.select(k, name.alias("table_name"),
                            F.explode(F.sequence(F.lit(1), (k % 6 + 3).cast("int"))).alias("ordinal_position"))
            .select("table_name", _pick(CATALOG_NAMES, k + i).alias("column_name"), "ordinal_position",
                    _pick(CATALOG_TYPES, k * 7 + i * 3).alias("data_type")))


def catalog_target(customer: DataFrame) -> DataFrame:
    """The warehouse's columns for the same tables, by a rule of its own: 4 to
    7 columns, and no target for every thirteenth table."""
    k = F.col("c_custkey")
    i = F.col("ordinal_position")
    return (customer.where(k % 13 != 0)
            .select(k, F.explode(F.sequence(F.lit(1), (k % 4 + 4).cast("int"))).alias("ordinal_position"))
            .select(F.concat(F.lit("tab_"), k.cast("string")).alias("table_name"),
                    F.upper(_pick(CATALOG_NAMES, k + i * 2)).alias("column_name"), "ordinal_position",
                    _pick(TARGET_TYPES, k + i * 5).alias("data_type")))


def dag(customer: DataFrame) -> DataFrame:
    """Edges of a graph with several prerequisites per pipeline and a chain
    deeper than 64: to the one before (up to 66), to the half and the third."""
    k = F.col("c_custkey")
    ends = F.array_distinct(F.filter(F.array(F.when(k <= 66, k - 1), F.floor(k / 2), F.floor(k / 3)),
                                     lambda x: x > 0))
    return customer.select(k.alias("pipeline_id"), F.explode(ends.cast("array<bigint>")).alias("depends_on_id"))


def unassigned_runs(events: DataFrame) -> DataFrame:
    """The run history with every seventeenth run of no pipeline."""
    return runs(events).withColumn("pipeline_id", F.when(F.col("run_id") % 17 != 0, F.col("pipeline_id")))


HOT_MOMENT = _dt.datetime(2024, 1, 15, 12, 0, 0)


def hot_day_runs(events: DataFrame) -> DataFrame:
    """The run history with a third of all runs starting at one moment."""
    return runs(events).withColumn("started_at", F.when(F.col("run_id") % 3 == 0, ts_lit(HOT_MOMENT))
                                   .otherwise(F.col("started_at")))
