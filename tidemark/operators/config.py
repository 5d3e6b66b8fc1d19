"""Connections and pipeline configuration: listings, export, resolution,
and the pipeline overview with last-run figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import DEFAULT_CRON, DEFAULT_MERGE_KEY, DEFAULT_WATERMARK_COLUMN, first_nonblank, target_name
from tidemark.operators.graph import dependency_lists
from tidemark.operators.runs import latest_runs

SECRET_COLUMNS = ("db_user", "db_password")
WAREHOUSE_TYPE = "snowflake"


def _newest_first(df: DataFrame) -> DataFrame:
    """Newest first by ``created_at`` (nulls first, as the reference's
    database orders a descending list), then id; by id alone without it."""
    cols = [c for c in ("created_at", "id") if c in df.columns]
    return df.orderBy(*[F.col(c).desc_nulls_first() for c in cols])


def active_only(df: DataFrame) -> DataFrame:
    """Rows not soft-deleted (F2)."""
    return df.where(F.col("is_active"))


def list_connections(connections: DataFrame) -> DataFrame:
    """Connections without credentials (soft-deleted ones included, with
    their ``is_active``), newest first."""
    return _newest_first(connections.drop(*SECRET_COLUMNS))


def source_connections(connections: DataFrame) -> DataFrame:
    return connections.where(F.col("db_type") != WAREHOUSE_TYPE)


def destination_connections(connections: DataFrame) -> DataFrame:
    return connections.where(F.col("db_type") == WAREHOUSE_TYPE)


def connection_roles(connections: DataFrame) -> DataFrame:
    """Credential-free listing with each connection's role."""
    role = F.when(F.col("db_type") == WAREHOUSE_TYPE, F.lit("destination")).otherwise(F.lit("source"))
    return list_connections(connections).withColumn("role", role)


def with_defaults(pipelines: DataFrame) -> DataFrame:
    """Watermark column defaults to ``updated_at``, merge key to ``id``."""
    return (pipelines
            .withColumn("watermark_column",
                        first_nonblank("watermark_column", default=DEFAULT_WATERMARK_COLUMN))
            .withColumn("merge_key_column",
                        first_nonblank("merge_key_column", default=DEFAULT_MERGE_KEY)))


def target_names(pipelines: DataFrame, connections: DataFrame) -> DataFrame:
    """Fully resolved warehouse names of each pipeline's target:
    database = pipeline value, else the destination's database; schema =
    pipeline value, else the destination's schema, else PUBLIC; all upper."""
    dest = connections.select(F.col("id").alias("destination_connection_id"),
                              F.col("db_name").alias("_dest_db"),
                              F.col("snowflake_schema").alias("_dest_schema"))
    return (pipelines.join(dest, "destination_connection_id", "left")
            .withColumn("target_db", F.upper(first_nonblank("target_database", "_dest_db")))
            .withColumn("target_schema", target_name("target_schema_name", "_dest_schema"))
            .withColumn("target_tbl", F.upper("target_table"))
            .withColumn("target_fqn", F.concat_ws(".", "target_db", "target_schema", "target_tbl"))
            .drop("_dest_db", "_dest_schema"))


def latest_schedules(schedules: DataFrame) -> DataFrame:
    """At most one schedule per pipeline: the newest (by created_at, id)."""
    pick = F.max_by(F.struct("id", "cron_expression"), F.struct("created_at", "id"))
    return (schedules.groupBy("pipeline_id").agg(pick.alias("s"))
            .select("pipeline_id", F.col("s.cron_expression").alias("cron_expression")))


def export_pipelines(pipelines: DataFrame, connections: DataFrame,
                     schedules: DataFrame) -> DataFrame:
    """Portable configuration: connection ids replaced by names, the cron
    expression defaulting to the daily 02:00 schedule."""
    src = connections.select(F.col("id").alias("connection_id"),
                             F.col("name").alias("source_connection_name"))
    dst = connections.select(F.col("id").alias("destination_connection_id"),
                             F.col("name").alias("destination_connection_name"))
    return (pipelines.join(src, "connection_id", "left")
            .join(dst, "destination_connection_id", "left")
            .join(latest_schedules(schedules), pipelines["id"] == F.col("pipeline_id"), "left")
            .select(F.col("id").alias("pipeline_id"), "name", "source_connection_name",
                    "destination_connection_name", "source_table", "watermark_column",
                    "merge_key_column", "target_database", "target_schema_name", "target_table",
                    F.coalesce("cron_expression", F.lit(DEFAULT_CRON)).alias("cron_expression"),
                    "volume_alert_upper_pct", "volume_alert_lower_pct"))


def export_json(exported: DataFrame) -> DataFrame:
    """One JSON document per exported pipeline (nulls written out)."""
    body = F.struct(*[c for c in exported.columns if c != "pipeline_id"],
                    F.array().cast("array<string>").alias("depends_on_names"))
    return exported.select("pipeline_id",
                           F.to_json(body, {"ignoreNullFields": "false"}).alias("config_json"))


def resolve_connections(exported: DataFrame, target_connections: DataFrame) -> DataFrame:
    """Map exported connection names to ids of another environment.

    ``status`` is ``ok``, or names the missing side; the reference refuses
    such a pipeline, here it is reported instead."""
    by_name = target_connections.select("name", "id")
    src = by_name.select(F.col("name").alias("source_connection_name"),
                         F.col("id").alias("connection_id"))
    dst = by_name.select(F.col("name").alias("destination_connection_name"),
                         F.col("id").alias("destination_connection_id"))
    out = (exported.join(src, "source_connection_name", "left")
           .join(dst, "destination_connection_name", "left"))
    missing_src = F.col("source_connection_name").isNotNull() & F.col("connection_id").isNull()
    missing_dst = (F.col("destination_connection_name").isNotNull()
                   & F.col("destination_connection_id").isNull())
    status = (F.when(missing_src, F.lit("missing_source"))
              .when(missing_dst, F.lit("missing_destination"))
              .otherwise(F.lit("ok")))
    return out.select("pipeline_id", "name", "source_connection_name", "connection_id",
                      "destination_connection_name", "destination_connection_id",
                      status.alias("status"))


def missing_connection_names(exported: DataFrame, target_connections: DataFrame) -> DataFrame:
    """Distinct connection names the other environment lacks."""
    # both name columns from one pass over the export
    names = (exported.select(F.explode(F.array("source_connection_name",
                                                "destination_connection_name")).alias("name"))
             .where(F.col("name").isNotNull()).distinct())
    return names.join(target_connections.select("name"), "name", "left_anti")


def pipeline_overview(pipelines: DataFrame, connections: DataFrame, schedules: DataFrame,
                      runs: DataFrame, deps: DataFrame) -> DataFrame:
    """Active pipelines with source and destination connection, schedule,
    run count, last run and their prerequisites."""
    src = connections.select(F.col("id").alias("connection_id"),
                             F.col("name").alias("connection_name"), "db_type")
    dst = connections.select(F.col("id").alias("destination_connection_id"),
                             F.col("name").alias("destination_name"),
                             F.col("db_type").alias("destination_db_type"))
    last = latest_runs(runs).drop("last_run_id")
    lists = dependency_lists(deps)
    p = active_only(pipelines)
    return (p.join(src, "connection_id", "left")
            .join(dst, "destination_connection_id", "left")
            .join(latest_schedules(schedules).withColumnRenamed("pipeline_id", "id"), "id", "left")
            .join(last.withColumnRenamed("pipeline_id", "id"), "id", "left")
            .join(lists.withColumnRenamed("pipeline_id", "id"), "id", "left")
            .withColumn("total_runs", F.coalesce("total_runs", F.lit(0).cast("bigint")))
            .withColumn("depends_on", F.coalesce("depends_on", F.array().cast("array<bigint>")))
            .transform(_newest_first))


def recent_pipelines(pipelines: DataFrame, n: int = 6) -> DataFrame:
    """Newest ``n`` active pipelines (dashboard list)."""
    w = [F.col("created_at").desc_nulls_first(), F.col("id").desc_nulls_first()]
    return active_only(pipelines).orderBy(*w).limit(n)
