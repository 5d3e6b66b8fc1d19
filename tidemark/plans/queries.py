"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Each reads the driver's tables (or views derived from them) whole. The
matching DuckDB SQL is in ``tidemark.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.types import cast_report, cast_to_target, map_type
from tidemark.operators import config as cfg
from tidemark.operators import graph, runs as R, schema as S, upsert as U
from tidemark.plans import views as V
from tidemark.plans.load import upper_columns
from tidemark.sources.readers import ParquetSource, discover_schema, key_bounds_df, read_incremental

Query = Callable[[SparkSession, str], DataFrame]

# Declared source types of lineitem (money as numeric, flags as varchar),
# as a source database would report them.
LINEITEM_DEFS = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "integer"), ("l_quantity", "double precision"),
    ("l_extendedprice", "numeric"), ("l_discount", "numeric"), ("l_tax", "numeric"),
    ("l_returnflag", "character varying"), ("l_linestatus", "character varying"),
    ("l_shipdate", "timestamp without time zone"),
]
DOCUMENT_DEFS = [
    ("doc_id", "bigint"), ("text", "character varying"), ("lang", "character varying"),
    ("source", "text"), ("n_chars", "integer"),
]
ORDER_TYPE_CHANGES = {
    "o_custkey": "INTEGER", "o_totalprice": "NUMERIC(18,4)",
    "o_orderdate": "DATE", "o_orderpriority": "INTEGER",
}
ORDER_LOSSY_CHANGES = {"o_custkey": "INTEGER", "o_totalprice": "INTEGER", "o_orderdate": "DATE",
                       "o_orderpriority": "INTEGER"}
FAILED_PAGE = 2


def _t(spark, sf, name):
    return V.table(spark, sf, name)


def _runs(spark, sf):
    return V.runs(_t(spark, sf, "events"))


def _flagged(spark, sf):
    return R.with_anomaly_flags(_runs(spark, sf), thresholds=_pipelines(spark, sf))


def _pipelines(spark, sf):
    return V.pipelines(_t(spark, sf, "customer"))


def _connections(spark, sf):
    return V.connections(_t(spark, sf, "nation"))


def _deps(spark, sf):
    return V.dependencies(_t(spark, sf, "customer"))


def _drift_state(spark, sf):
    ev = _t(spark, sf, "events")
    return S.drift_state(V.drift_events(ev), V.drift_resolutions(ev))


def _schema_cols(spark, sf):
    return discover_schema(spark, ParquetSource(sf), tables=V.all_tables(spark, sf))


# ------------------------------------------------------------------ loading

def incremental_scan(spark, sf):
    orders = _t(spark, sf, "orders")
    return upper_columns(read_incremental(spark, ParquetSource(sf), "orders", "o_orderdate",
                                          V.BATCH_SINCE, df=orders))


def key_bounds(spark, sf):
    return key_bounds_df(_t(spark, sf, "orders"), "o_orderkey")


def resolve_watermark(spark, sf):
    return R.resolve_watermark(_runs(spark, sf), _pipelines(spark, sf), V.AS_OF)


def upsert_delete_insert(spark, sf):
    orders = _t(spark, sf, "orders")
    return U.upsert_delete_insert(V.load_target(orders), V.load_batch(orders), "o_orderkey")


def upsert_last_wins(spark, sf):
    li = _t(spark, sf, "lineitem")
    target = U.dedup_last_wins(li.where(F.col("l_shipdate") < V.ts_lit(V.LINE_TARGET_BEFORE)),
                               V.DUP_KEY, [F.col(c) for c in V.DUP_ORDER])
    batch = li.where(F.col("l_shipdate") >= V.ts_lit(V.LINE_BATCH_SINCE))
    return U.upsert_last_wins(target, batch, V.DUP_KEY, V.DUP_ORDER)


def dedup_last_wins(spark, sf):
    return U.dedup_last_wins(_t(spark, sf, "lineitem"), V.DUP_KEY, V.DUP_ORDER)


def match_keys(spark, sf):
    orders = _t(spark, sf, "orders")
    return U.match_keys(V.load_target(orders), V.load_batch(orders), "o_orderkey", "left_semi")


def append_only(spark, sf):
    orders = _t(spark, sf, "orders")
    return U.append(V.load_target(orders), V.load_batch(orders))


def load_rows(spark, sf):
    orders = _t(spark, sf, "orders")
    return U.load_stats(V.load_target(orders), V.load_batch(orders), "o_orderkey")


def cast_to_target_q(spark, sf):
    return upper_columns(cast_to_target(_t(spark, sf, "lineitem"), LINEITEM_DEFS))


def cast_report_q(spark, sf):
    return cast_report(_t(spark, sf, "documents"), DOCUMENT_DEFS)


# ------------------------------------------------------------------- schema

def schema_columns(spark, sf):
    return _schema_cols(spark, sf).withColumn("target_type", map_type("data_type"))


def _catalog(spark, sf):
    return S.user_tables(V.catalog(_t(spark, sf, "customer")))


def suggest_watermark(spark, sf):
    return S.suggest_watermark(_catalog(spark, sf))


def suggest_load_keys(spark, sf):
    return S.suggest_load_keys(_catalog(spark, sf))


def schema_tree(spark, sf):
    tree = S.schema_tree(_catalog(spark, sf))
    flat = F.array_join(F.transform("columns", lambda c: F.concat_ws(":", c["name"], c["type"])), ",")
    return tree.select("table_name", F.size("columns").alias("n_columns"), flat.alias("columns"))


def schema_summary(spark, sf):
    return S.schema_summary(_catalog(spark, sf))


def detect_drift(spark, sf):
    return S.detect_drift(_catalog(spark, sf), V.catalog_target(_t(spark, sf, "customer")))


def drift_cast_loss(spark, sf):
    return S.cast_loss(_t(spark, sf, "orders"), ORDER_LOSSY_CHANGES)


def target_columns_q(spark, sf):
    """Columns of a target as the catalog reports them."""
    from tidemark.sources.readers import target_columns
    target = _bucketed(spark, upper_columns(V.load_target(_t(spark, sf, "orders"))), "O_ORDERKEY")
    return target_columns(spark, "orders", catalog_table=target.name)


def drift_append(spark, sf):
    """The drift log after two appends."""
    from tidemark.plans.sinks import log_drift
    from tidemark.session import fresh_scratch
    path = fresh_scratch(spark, "drift_append")
    events = V.drift_events(_t(spark, sf, "events"))
    late = F.col("detected_at") >= V.ts_lit("2024-01-15 00:00:00")
    log_drift(events.where(~late), path)
    log_drift(events.where(late), path)
    return spark.read.parquet(path)


def heal_and_align(spark, sf):
    orders = _t(spark, sf, "orders")
    target = V.load_target(orders).drop("o_orderpriority")
    batch = V.load_batch(orders).drop("o_totalprice")
    healed, aligned = S.heal_and_align(target, batch)
    return U.upsert_delete_insert(healed, aligned, "o_orderkey")


def type_change_check(spark, sf):
    return S.type_change_check(_t(spark, sf, "orders"), ORDER_TYPE_CHANGES)


def pending_drift(spark, sf):
    return S.pending_drift(_drift_state(spark, sf), _pipelines(spark, sf))


def drift_log(spark, sf):
    return S.drift_log(_drift_state(spark, sf), status="resolved")


# --------------------------------------------------------------------- runs

def run_state(spark, sf):
    return R.run_state(V.run_patches(_t(spark, sf, "events")))


def latest_runs(spark, sf):
    return R.latest_runs(_runs(spark, sf))


def recent_runs(spark, sf):
    return R.runs_feed(_runs(spark, sf), _pipelines(spark, sf))


def volume_anomaly(spark, sf):
    return R.volume_anomaly(_runs(spark, sf), thresholds=_pipelines(spark, sf))


def volume_anomaly_unassigned(spark, sf):
    """The check where some runs belong to no pipeline: they are a group."""
    return R.volume_anomaly(V.unassigned_runs(_t(spark, sf, "events")), thresholds=_pipelines(spark, sf))


def recent_for_pipeline(spark, sf):
    return R.recent_for_pipeline(_runs(spark, sf), 3)


def volume_history(spark, sf):
    return R.volume_history(_flagged(spark, sf), V.AS_OF)


def volume_scale(spark, sf):
    return R.volume_scale(R.volume_history(_flagged(spark, sf), V.AS_OF))


def platform_stats(spark, sf):
    return R.platform_stats(_pipelines(spark, sf), _connections(spark, sf), _flagged(spark, sf),
                            _drift_state(spark, sf), V.AS_OF)


def run_status_totals(spark, sf):
    return R.run_status_totals(_flagged(spark, sf), by_pipeline=True)


def anomaly_feed(spark, sf):
    return R.anomaly_feed(_flagged(spark, sf))


def run_page(spark, sf):
    return R.run_page(_runs(spark, sf), FAILED_PAGE, status="failed")


def run_durations(spark, sf):
    return R.run_durations(_runs(spark, sf))


# ---------------------------------------------------------- config / graph

def pipeline_overview(spark, sf):
    ov = cfg.pipeline_overview(_pipelines(spark, sf), _connections(spark, sf),
                               V.schedules(_t(spark, sf, "customer")), _runs(spark, sf),
                               _deps(spark, sf))
    return ov.select("id", "name", "connection_name", "db_type", "destination_name",
                     "destination_db_type", "cron_expression", "total_runs", "last_status",
                     "last_run_at", "last_rows_loaded",
                     F.array_join(F.col("depends_on").cast("array<string>"), ",").alias("depends_on"))


def dependency_edges(spark, sf):
    return graph.dependency_edges(_deps(spark, sf), _pipelines(spark, sf))


def dependency_levels(spark, sf):
    return graph.dependency_levels(_pipelines(spark, sf), _deps(spark, sf))


def dependency_levels_dag(spark, sf):
    return graph.dependency_levels(_pipelines(spark, sf), V.dag(_t(spark, sf, "customer")))


def isolated_pipelines(spark, sf):
    return graph.isolated_pipelines(_pipelines(spark, sf), _deps(spark, sf)).select("id", "name")


def export_pipelines(spark, sf):
    return cfg.export_pipelines(_pipelines(spark, sf), _connections(spark, sf),
                                V.schedules(_t(spark, sf, "customer")))


def export_json(spark, sf):
    return cfg.export_json(export_pipelines(spark, sf))


def resolve_connections(spark, sf):
    exported = export_pipelines(spark, sf)
    return cfg.resolve_connections(exported, V.target_connections(_t(spark, sf, "nation")))


def connection_roles(spark, sf):
    return cfg.connection_roles(_connections(spark, sf))


def target_names(spark, sf):
    p = cfg.with_defaults(_pipelines(spark, sf))
    return cfg.target_names(p, _connections(spark, sf)).select(
        "id", "watermark_column", "merge_key_column", "target_db", "target_schema",
        "target_tbl", "target_fqn")


def recent_pipelines(spark, sf):
    return cfg.recent_pipelines(_pipelines(spark, sf)).select("id", "name", "created_at")


def run_load_q(spark, sf):
    """Two scheduled loads of one pipeline, end to end: a full first load
    of the orders known before 2000, then an incremental load of all
    orders (status changed) from the mark the first run left."""
    import dataclasses
    import os
    import uuid
    from tidemark.plans.buckets import BucketedTarget
    from tidemark.plans.load import LoadSpec, run_load
    from tidemark.session import scratch_path
    root = scratch_path(spark, os.path.join("run_load", uuid.uuid4().hex))
    orders = _t(spark, sf, "orders")
    first, later = os.path.join(root, "src1"), os.path.join(root, "src2")
    V.load_target(orders).write.parquet(os.path.join(first, "orders.parquet"))
    orders.withColumn("o_orderstatus", F.lit(V.BATCH_STATUS)) \
        .write.parquet(os.path.join(later, "orders.parquet"))
    log = os.path.join(root, "runs")
    spec = LoadSpec(pipeline_id=1, source=ParquetSource(first), source_table="orders",
                    target_path=os.path.join(root, "target"), target_table="load_" + uuid.uuid4().hex,
                    buckets=BUCKETS, watermark_column="o_orderdate", merge_key="o_orderkey", mode="full")
    run_load(spark, spec, V.BATCH_SINCE, run_id=1, run_log=log)
    history = R.run_state(spark.read.parquet(log))
    run_load(spark, dataclasses.replace(spec, source=ParquetSource(later), mode="incremental"),
             V.AS_OF, run_id=2, runs=history, run_log=log)
    return BucketedTarget(spark, spec.target_table, "O_ORDERKEY", BUCKETS).read()


def empty_load(spark, sf):
    """Run records of a full load and of an incremental one that finds nothing
    new: it completes with no rows and leaves the target as it is."""
    import dataclasses
    import os
    import uuid
    from tidemark.plans.load import LoadSpec, run_load
    from tidemark.session import fresh_scratch
    root = fresh_scratch(spark, "empty_load")
    V.load_target(_t(spark, sf, "orders")).write.parquet(os.path.join(root, "src", "orders.parquet"))
    log = os.path.join(root, "runs")
    spec = LoadSpec(pipeline_id=1, source=ParquetSource(os.path.join(root, "src")), source_table="orders",
                    target_path=os.path.join(root, "target"), target_table="load_" + uuid.uuid4().hex,
                    buckets=BUCKETS, watermark_column="o_orderdate", merge_key="o_orderkey", mode="full")
    run_load(spark, spec, V.TARGET_CUTOFF, run_id=1, run_log=log)
    history = R.run_state(spark.read.parquet(log))
    run_load(spark, dataclasses.replace(spec, mode="incremental"), V.AS_OF, run_id=2, runs=history, run_log=log)
    return R.run_state(spark.read.parquet(log)).select("run_id", "pipeline_id", "status", "rows_loaded",
                                                       "phase_completed", "cast_issues")


def cached_schema_q(spark, sf):
    import os
    import uuid
    from tidemark.plans.schema_cache import SchemaCache, cached_schema
    from tidemark.session import scratch_path
    cache = SchemaCache(spark, scratch_path(spark, os.path.join("schema_cache", uuid.uuid4().hex)))
    return cached_schema(cache, 1, lambda: _schema_cols(spark, sf))


def dependency_lists(spark, sf):
    lists = graph.dependency_lists(_deps(spark, sf))
    return lists.select("pipeline_id", F.size("depends_on").alias("n_prerequisites"),
                        F.array_join(F.col("depends_on").cast("array<string>"), ",")
                        .alias("depends_on"))


def drift_counts(spark, sf):
    return S.drift_counts(_drift_state(spark, sf))


def missing_connections(spark, sf):
    return cfg.missing_connection_names(export_pipelines(spark, sf),
                                        V.target_connections(_t(spark, sf, "nation")))


def run_page_count(spark, sf):
    return R.page_count(_runs(spark, sf), status="failed")


def volume_totals(spark, sf):
    """Daily volume of all pipelines together (the monitor's "all" view)."""
    return R.volume_history(_flagged(spark, sf), V.AS_OF, by_pipeline=False)


def run_totals(spark, sf):
    return R.run_status_totals(_flagged(spark, sf))


def stream_upsert(spark, sf):
    from tidemark.streaming.upsert_stream import stream_upsert_table
    return stream_upsert_table(spark, sf)


# ------------------------------------------------- targets and files laid out

BUCKETS = 16


def _bucketed(spark, df, key):
    """A bucketed target below the checkpoint folder, under a name of its own."""
    import uuid
    from tidemark.plans.buckets import BucketedTarget
    from tidemark.session import fresh_scratch
    return BucketedTarget.create(df, "target_" + uuid.uuid4().hex, key, BUCKETS, fresh_scratch(spark, "bucketed"))


def bucketed_upsert(spark, sf):
    """A load of orders into a target in folders by key hash, replayed once."""
    orders = _t(spark, sf, "orders")
    target = _bucketed(spark, V.load_target(orders), "o_orderkey")
    for _ in range(2):
        target.upsert(V.load_batch(orders), "load-1")
    return target.read()


def bucketed_last_wins(spark, sf):
    """Line items: two runs into a target in folders by key hash, the last row
    of each order wins; the first run is replayed after the second."""
    li = _t(spark, sf, "lineitem")
    target = _bucketed(spark, li.limit(0), V.DUP_KEY)
    runs = {"first": li.where(F.col("l_shipdate") < V.ts_lit(V.LINE_TARGET_BEFORE)),
            "second": li.where(F.col("l_shipdate") >= V.ts_lit(V.LINE_BATCH_SINCE))}
    for name in ("first", "second", "first"):
        target.upsert(runs[name], name, V.DUP_ORDER)
    return target.read()


def key_bounds_footers(spark, sf):
    from tidemark.plans.layout import footer_bounds
    return footer_bounds(spark, ParquetSource(sf).path("orders"), "o_orderkey")


def _clustered(spark, df, by, **how):
    from tidemark.plans.layout import write_clustered
    from tidemark.session import fresh_scratch
    path = fresh_scratch(spark, "clustered")
    write_clustered(df, path, by, **how)
    return spark.read.parquet(path)


def incremental_scan_clustered(spark, sf):
    """The incremental scan over orders laid out by their mark."""
    from tidemark.plans.layout import since_mark
    orders = _clustered(spark, _t(spark, sf, "orders"), ["o_orderdate", "o_orderkey"])
    return upper_columns(since_mark(orders, "o_orderdate", V.BATCH_SINCE))


def _kept_summary(spark, sf):
    """A summary made of the runs before the last days, and brought in line
    with all of them: late runs, and runs that had been running."""
    from tidemark.plans.summary import RunSummary, days_of
    from tidemark.session import fresh_scratch, materialize
    runs = materialize(_flagged(spark, sf), fresh_scratch(spark, "flagged-runs"))
    late = (F.col("started_at") >= V.ts_lit(V.AS_OF) - F.expr("interval 3 days")) | (F.col("run_id") % 97 == 0)
    summary = RunSummary(spark, fresh_scratch(spark, "run-summary"))
    summary.refresh(runs.where(~late))
    summary.refresh(runs, days_of(runs.where(late)))
    return summary, runs


def run_totals_kept(spark, sf):
    return _kept_summary(spark, sf)[0].totals()


def run_status_totals_kept(spark, sf):
    return _kept_summary(spark, sf)[0].totals(by_pipeline=True)


def volume_history_kept(spark, sf):
    summary, runs = _kept_summary(spark, sf)
    return summary.history(runs, V.AS_OF)


def match_keys_skipping(spark, sf):
    """Key matching over a target laid out by key with Bloom filters."""
    from tidemark.plans.layout import match_keys_pruned
    orders = _t(spark, sf, "orders")
    target = _clustered(spark, V.load_target(orders), "o_orderkey", bloom="o_orderkey")
    return match_keys_pruned(target, V.load_batch(orders), "o_orderkey")


def volume_anomaly_hot_day(spark, sf):
    """The check where a third of all runs start at one moment."""
    return R.volume_anomaly(V.hot_day_runs(_t(spark, sf, "events")), thresholds=_pipelines(spark, sf),
                            split_days=True)


# ------------------------------------------------------ pages and fingerprints

def _pages(spark, sf):
    from tidemark.plans.pages import RunPages
    from tidemark.session import fresh_scratch
    pages = RunPages(spark, fresh_scratch(spark, "run-pages"))
    pages.build(_runs(spark, sf))
    return pages


def run_page_indexed(spark, sf):
    return _pages(spark, sf).page(FAILED_PAGE, status="failed")


def run_page_bounds(spark, sf):
    """Every page of the history, of each status, each pipeline, and of both."""
    return _pages(spark, sf).index()


def detect_drift_changed(spark, sf):
    return S.detect_drift_changed(_catalog(spark, sf), V.catalog_target(_t(spark, sf, "customer")))


def drifted_tables(spark, sf):
    return S.drifted_tables(_catalog(spark, sf), V.catalog_target(_t(spark, sf, "customer")))


# ------------------------------------------------------------ stateful streams

SLICES = 3
STREAM_DAYS = 45


def _streamed(spark, df, by, changes, keys):
    """What a stream has made of ``df``, which arrives out of order in scheduled
    runs of ``SLICES`` slices by a hash of ``by``; the first arrives twice."""
    from tidemark.session import fresh_scratch
    from tidemark.streaming.run_stream import ChangeLog, run_stream
    root = fresh_scratch(spark, "run-stream")
    for i in [*range(SLICES), 0]:
        df.where(F.pmod(F.xxhash64(by), F.lit(SLICES)) == i).write.mode("append").parquet(f"{root}/in")
        made = changes(spark.readStream.schema(df.schema).parquet(f"{root}/in"))
        log = ChangeLog(spark, f"{root}/log", made.schema)
        run_stream(made, log, f"{root}/checkpoint").awaitTermination()
    return log.read(keys)


def run_state_stream(spark, sf):
    from tidemark.streaming.run_stream import fold_patches
    return _streamed(spark, V.run_patches(_t(spark, sf, "events")), "seq", fold_patches, ["run_id"])


def volume_anomaly_stream(spark, sf):
    """The check from a stream that holds ``STREAM_DAYS`` of runs a pipeline;
    pipelines with later ones are computed from the run table."""
    from tidemark.streaming.run_stream import trailing_history, volume_from
    runs = _runs(spark, sf)
    kept = _streamed(spark, runs, "started_at", lambda s: trailing_history(s, STREAM_DAYS), ["run_id"])
    return volume_from(kept, runs, _pipelines(spark, sf))


QUERIES: dict[str, Query] = {
    "incremental_scan": incremental_scan,
    "key_bounds": key_bounds,
    "resolve_watermark": resolve_watermark,
    "upsert_delete_insert": upsert_delete_insert,
    "upsert_last_wins": upsert_last_wins,
    "dedup_last_wins": dedup_last_wins,
    "match_keys": match_keys,
    "append_only": append_only,
    "load_rows": load_rows,
    "cast_to_target": cast_to_target_q,
    "cast_report": cast_report_q,
    "schema_columns": schema_columns,
    "suggest_watermark": suggest_watermark,
    "suggest_load_keys": suggest_load_keys,
    "schema_tree": schema_tree,
    "schema_summary": schema_summary,
    "detect_drift": detect_drift,
    "heal_and_align": heal_and_align,
    "type_change_check": type_change_check,
    "pending_drift": pending_drift,
    "drift_log": drift_log,
    "run_state": run_state,
    "latest_runs": latest_runs,
    "recent_runs": recent_runs,
    "volume_anomaly": volume_anomaly,
    "volume_history": volume_history,
    "volume_scale": volume_scale,
    "platform_stats": platform_stats,
    "run_status_totals": run_status_totals,
    "anomaly_feed": anomaly_feed,
    "run_page": run_page,
    "run_durations": run_durations,
    "pipeline_overview": pipeline_overview,
    "dependency_edges": dependency_edges,
    "dependency_levels": dependency_levels,
    "isolated_pipelines": isolated_pipelines,
    "export_pipelines": export_pipelines,
    "resolve_connections": resolve_connections,
    "connection_roles": connection_roles,
    "target_names": target_names,
    "recent_pipelines": recent_pipelines,
    "stream_upsert": stream_upsert,
    "run_load": run_load_q,
    "dependency_lists": dependency_lists,
    "drift_counts": drift_counts,
    "missing_connections": missing_connections,
    "run_page_count": run_page_count,
    "run_totals": run_totals,
    "volume_totals": volume_totals,
    "cached_schema": cached_schema_q,
    "drift_cast_loss": drift_cast_loss,
    "dependency_levels_dag": dependency_levels_dag,
    "volume_anomaly_unassigned": volume_anomaly_unassigned,
    "target_columns": target_columns_q,
    "empty_load": empty_load,
    "drift_append": drift_append,
    "recent_for_pipeline": recent_for_pipeline,
    "export_json": export_json,
    "bucketed_upsert": bucketed_upsert,
    "bucketed_last_wins": bucketed_last_wins,
    "key_bounds_footers": key_bounds_footers,
    "incremental_scan_clustered": incremental_scan_clustered,
    "match_keys_skipping": match_keys_skipping,
    "run_totals_kept": run_totals_kept,
    "run_status_totals_kept": run_status_totals_kept,
    "volume_history_kept": volume_history_kept,
    "volume_anomaly_hot_day": volume_anomaly_hot_day,
    "run_page_indexed": run_page_indexed,
    "run_page_bounds": run_page_bounds,
    "detect_drift_changed": detect_drift_changed,
    "drifted_tables": drifted_tables,
    "run_state_stream": run_state_stream,
    "volume_anomaly_stream": volume_anomaly_stream,
}
