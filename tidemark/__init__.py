"""tidemark: incremental extract-load and load monitoring on Spark.

Every operator is a function from DataFrames to a DataFrame, built from
Spark SQL expressions so that Catalyst can prune, push down and plan it.
Only ``plans`` (loads, targets, sinks) and ``streaming`` write anything.

    from tidemark import Connection, LoadSpec, run_load, VersionedTable
    from tidemark import upsert_delete_insert, upsert_last_wins, volume_anomaly
"""

from tidemark.session import checkpoint_dir, get_session
from tidemark.sources.connection import Connection
from tidemark.sources.readers import (
    ParquetSource, discover_schema, key_bounds, read_incremental, read_partitioned, read_table,
)
from tidemark.functions.types import cast_report, cast_to_target, map_type
from tidemark.operators.upsert import (
    dedup_last_wins, load_stats, match_keys, upsert_delete_insert, upsert_last_wins,
)
from tidemark.operators.runs import (
    anomaly_feed, latest_runs, platform_stats, recent_runs, resolve_watermark, run_page,
    run_state, run_status_totals, volume_anomaly, volume_history, volume_scale,
)
from tidemark.operators.schema import (
    detect_drift, drift_state, heal_and_align, pending_drift, schema_summary, schema_tree,
    suggest_load_keys, suggest_watermark,
)
from tidemark.operators.graph import dependency_edges, dependency_levels, isolated_pipelines
from tidemark.operators.config import export_pipelines, pipeline_overview, resolve_connections
from tidemark.plans.load import LoadResult, LoadSpec, resolve_drift, run_load
from tidemark.plans.tables import VersionedTable
from tidemark.plans.schema_cache import SchemaCache, cached_schema
from tidemark.plans.sinks import jdbc_upsert, warehouse_writer
from tidemark.streaming.upsert_stream import stream_upsert

__all__ = [
    "checkpoint_dir", "get_session", "Connection", "ParquetSource", "discover_schema",
    "key_bounds", "read_incremental", "read_partitioned", "read_table", "cast_report",
    "cast_to_target", "map_type", "dedup_last_wins", "load_stats", "match_keys",
    "upsert_delete_insert", "upsert_last_wins", "anomaly_feed", "latest_runs",
    "platform_stats", "recent_runs", "resolve_watermark", "run_page", "run_state",
    "run_status_totals", "volume_anomaly", "volume_history", "volume_scale", "detect_drift",
    "drift_state", "heal_and_align", "pending_drift", "schema_summary", "schema_tree",
    "suggest_load_keys", "suggest_watermark", "dependency_edges", "dependency_levels",
    "isolated_pipelines", "export_pipelines", "pipeline_overview", "resolve_connections",
    "LoadResult", "LoadSpec", "resolve_drift", "run_load", "VersionedTable", "SchemaCache",
    "cached_schema", "jdbc_upsert", "warehouse_writer", "stream_upsert",
]
