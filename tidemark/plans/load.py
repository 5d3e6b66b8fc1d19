"""One load of one pipeline, end to end.

high-water mark -> incremental read -> project, upper-case, cast -> detect
drift from the schemas -> write the batch once, as a new layer of the target,
counted by an ``Observation`` on that write -> commit -> volume check -> run
record.

The source is read once and the batch written once: the layer's files lie in
the target before they are committed, and a batch that fails its checks is
never committed. For a database target, or one in folders by key hash, the
batch is staged once under the shared checkpoint directory and applied from there.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import ERROR_TEXT_LIMIT, ts_lit
from tidemark.functions.types import (
    TYPE_MAP, cast_metrics, cast_to_target, held_type, source_type_name, target_type_for, widest,
)
from tidemark.operators import runs as R
from tidemark.operators import schema as S
from tidemark.operators import upsert as U
from tidemark.plans import sinks
from tidemark.plans.buckets import BucketedTarget
from tidemark.plans.tables import VersionedTable
from tidemark.session import checkpoint_dir, path_exists
from tidemark.sources.connection import Connection
from tidemark.sources.readers import (
    ParquetSource, declared_columns, read_incremental, read_partitioned, read_table,
)


def project_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The discovered columns, in their order."""
    return df.select(*cols)


def upper_columns(df: DataFrame) -> DataFrame:
    """Every column name upper-cased."""
    return df.toDF(*[c.upper() for c in df.columns])


@dataclass(frozen=True)
class LoadSpec:
    pipeline_id: int
    source: Connection | ParquetSource
    source_table: str
    target_path: str = ""              # versioned Parquet target, or:
    buckets: int | None = None         # a target in so many folders by key hash, as catalog table
                                       # ``target_table`` (below ``target_path``, if given)
    watermark_column: str | None = "updated_at"
    merge_key: str | None = "id"       # used where the source has such a column
    mode: str = "incremental"          # or "full"
    upsert: str = "delete_insert"      # or "last_wins", "append"
    order_cols: tuple[str, ...] = ()   # last_wins order, descending; by default the mark column
    upper_pct: int = R.VOLUME_UPPER_PCT
    lower_pct: int = R.VOLUME_LOWER_PCT
    col_defs: tuple[tuple[str, str], ...] | None = None
    jdbc_partitions: int = 8
    jdbc_split: str = "range"          # or "mod": even splits for clustered keys
    upper_case: bool = True
    mark: str = "run_end"              # or "max_seen": highest watermark value loaded
    compact_max_layers: int = 16       # fold layers into a new base after this many,
    compact_ratio: float = 0.1         # or once they hold this share of the base's rows
    on_cast_error: str = "fail"        # "fail": stop before the target; "null": report and load null
    target_connection: Connection | None = None  # a JDBC target table instead
    target_table: str | None = None
    target_database: str | None = None  # of a warehouse target
    target_schema: str | None = None

    def __post_init__(self):
        choices = {"mode": ("incremental", "full"),
                   "upsert": ("delete_insert", "last_wins", "append"),
                   "mark": ("run_end", "max_seen"), "on_cast_error": ("null", "fail"),
                   "jdbc_split": ("range", "mod")}
        for name, allowed in choices.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {getattr(self, name)!r}")
        if self.buckets is not None:
            if not self.target_table or self.target_connection is not None:
                raise ValueError("buckets need a target_table of the catalog")
            if self.buckets < 1 or self.upsert == "append" or not self.merge_key:
                raise ValueError("buckets need a merge_key and an upsert by it")
        elif not self.target_path and self.target_connection is None:
            raise ValueError("a target is needed: target_path, target_connection or buckets")
        if self.upsert == "last_wins" and not (self.order_cols or self.watermark_column):
            raise ValueError("last_wins needs order_cols or a watermark_column")

    def order(self, name: Callable[[str], str]) -> list[str]:
        return [name(c) for c in self.order_cols or (self.watermark_column,) if c]


@dataclass
class LoadResult:
    run_id: int
    status: str
    rows_loaded: int
    volume_anomaly: bool
    pct: float | None
    watermark: _dt.datetime | None
    version: int | None
    drift: list[dict] = field(default_factory=list)
    error_message: str | None = None
    max_seen: str | None = None
    cast_issues: dict = field(default_factory=dict)

    @property
    def n_added(self) -> int:
        return sum(1 for d in self.drift if d["change_type"] == "column_added"
                   and d["status"] == "auto_resolved")

    @property
    def n_pending(self) -> int:
        return sum(1 for d in self.drift if d["status"] == "pending_review")


PATCH_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("patched_at", T.TimestampNTZType()), T.StructField("pipeline_id", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("rows_loaded", T.LongType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("volume_anomaly_flag", T.BooleanType()),
    T.StructField("phase_completed", T.IntegerType()),
    T.StructField("max_seen", T.StringType()),
    T.StructField("cast_issues", T.StringType()),
])


def _patch_row(run_id: int, seq: int, at: _dt.datetime, pipeline_id: int, fields: dict) -> tuple:
    err = fields.get("error_message")
    if err is not None:
        err = err[:ERROR_TEXT_LIMIT]
    return (run_id, seq, at, pipeline_id, fields.get("status"), fields.get("rows_loaded"), err,
            fields.get("volume_anomaly_flag"), fields.get("phase_completed"),
            fields.get("max_seen"), fields.get("cast_issues"))


def record_patch(spark: SparkSession, log_path: str | None, run_id: int, seq: int,
                 at: _dt.datetime, pipeline_id: int, **fields) -> None:
    """Append one run-record patch (K7 input); only given fields are set."""
    if log_path:
        write_patches(spark, log_path, [_patch_row(run_id, seq, at, pipeline_id, fields)])


def write_patches(spark: SparkSession, log_path: str, rows: list[tuple]) -> None:
    if rows:
        (spark.createDataFrame(rows, PATCH_SCHEMA).coalesce(1)
         .write.mode("append").parquet(log_path))


_last_seq = [0]


def _next_seq() -> int:
    """Patch order: microseconds since the epoch, strictly increasing in this
    process, so a retried run's patches sort after its earlier attempt's."""
    now = time.time_ns() // 1000
    _last_seq[0] = max(now, _last_seq[0] + 1)
    return _last_seq[0]


def _source_defs(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, source_type_name(f.dataType)) for f in df.schema.fields]


def _declared_defs(spark: SparkSession, spec: LoadSpec, df: DataFrame) -> list[tuple[str, str]]:
    """Declared column types: a database's own from its column catalog
    where the type map knows the name; else the names of the Spark types that
    the database's own types are read as."""
    if isinstance(spec.source, Connection):
        name = spec.source_table.rpartition(".")
        listed = declared_columns(spark, spec.source, name[2], name[0] or None)
        known = {r["column_name"].lower(): r["data_type"] for r in listed}
        if known:
            return [(n, name if (name := known.get(n.lower(), t)) in TYPE_MAP else t) for n, t in _source_defs(df)]
    return _source_defs(df)


def _read_source(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """The source table, unfiltered (filters are added lazily and pushed down)."""
    return read_table(spark, spec.source, spec.source_table)


def volume_check(runs: DataFrame | None, pipeline_id: int, rows: int,
                 upper: int, lower: int) -> tuple[bool, float | None]:
    """Compare ``rows`` with the mean of the pipeline's last 7 complete runs."""
    if runs is None:
        return False, None
    hist = (R.recent_runs(runs.where((F.col("pipeline_id") == pipeline_id)
                                     & (F.col("status") == "complete")),
                          R.VOLUME_HISTORY_RUNS)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg(F.coalesce(F.col("rows_loaded"), F.lit(0))).alias("mean"))).first()
    if hist is None or not hist["n"] or hist["mean"] is None or hist["mean"] <= 0:
        return False, None
    pct = rows / hist["mean"] * 100.0
    return (pct < lower or pct > upper), pct


def run_load(spark: SparkSession, spec: LoadSpec, as_of: _dt.datetime, run_id: int,
             runs: DataFrame | None = None, run_log: str | None = None,
             drift_log_path: str | None = None,
             clock: Callable[[], _dt.datetime] | None = None) -> LoadResult:
    """Run one load. ``runs`` is the run history used for the mark and the
    volume check; ``run_log`` (optional) receives run patches and
    ``drift_log_path`` drift events. Run events are stamped with ``clock()``
    when given, else with ``as_of`` (deterministic)."""
    # The opening patch is written at once (the run shows as running); the
    # phase patches are kept and written with the closing one, in one file.
    pending: list[tuple] = []

    def patch(**kw):
        at = clock() if clock is not None else as_of
        pending.append(_patch_row(run_id, _next_seq(), at, spec.pipeline_id, kw))

    def flush():
        if run_log:
            write_patches(spark, run_log, pending[flushed[0]:])
        flushed[0] = len(pending)

    flushed = [0]
    patch(status="running", phase_completed=0)
    flush()
    try:
        # phase 1: high-water mark (A3)
        base = _read_source(spark, spec)
        wm = spec.watermark_column if spec.mode == "incremental" else None
        since = None
        if spec.mode == "incremental":
            default = as_of - _dt.timedelta(days=R.WATERMARK_LOOKBACK_DAYS)
            since = default
            if runs is not None:
                done = runs.where((F.col("pipeline_id") == spec.pipeline_id)
                                  & (F.col("status") == "complete"))
                if (spec.mark == "max_seen" and "max_seen" in runs.columns
                        and wm in base.columns):
                    # values were stored as text; compare them in the column's type
                    row = done.agg(F.max(F.col("max_seen").try_cast(base.schema[wm].dataType))
                                   .alias("m")).first()
                else:
                    row = done.agg(F.max("ended_at").alias("m")).first()
                if row is not None and row["m"] is not None:
                    since = row["m"]
        patch(phase_completed=1)

        # extract, project, cast, stage once (S2 P1 P2 P3 K10); the row count,
        # the highest watermark value and the values the target types cannot
        # hold are all observed in that same single pass
        if isinstance(spec.source, Connection) and spec.merge_key in base.columns:
            src = read_partitioned(spark, spec.source, spec.source_table, spec.merge_key,
                                   spec.jdbc_partitions, wm_col=wm, since=since, split=spec.jdbc_split,
                                   schema=base.schema)
        else:
            src = read_incremental(spark, spec.source, spec.source_table, wm, since, df=base)
        defs = list(spec.col_defs) if spec.col_defs else _declared_defs(spark, spec, src)
        metrics = [F.count(F.lit(1)).alias("rows")]
        if spec.watermark_column and spec.watermark_column in src.columns:
            metrics.append(F.max(F.col(spec.watermark_column)).cast("string").alias("max_seen"))
        metrics += cast_metrics(src, defs)
        obs = Observation(f"extract_{spec.pipeline_id}_{run_id}_{uuid.uuid4().hex[:8]}")
        batch = cast_to_target(src.observe(obs, *metrics), defs)
        if spec.upper_case:
            batch = upper_columns(batch)

        def observed() -> tuple[int, str | None, dict]:
            got = obs.get
            issues = {n: {"n_failed": int(got.get(f"{n}__f", 0)), "n_too_long": int(got.get(f"{n}__l", 0))}
                      for n, _ in defs if got.get(f"{n}__f", 0) or got.get(f"{n}__l", 0)}
            if issues:
                patch(cast_issues=json.dumps(issues, sort_keys=True))
            if spec.on_cast_error == "fail" and any(i["n_failed"] for i in issues.values()):
                raise ValueError(f"values the target types cannot hold: {issues}")
            return int(got.get("rows", 0)), got.get("max_seen"), issues

        version = None
        drift_rows: list[dict] = []
        if spec.target_connection is not None or spec.buckets is not None:
            # the target sees only a batch that is whole and checked
            stage = os.path.join(checkpoint_dir(spark), "stage",
                                 f"pipeline={spec.pipeline_id}", f"run={run_id}")
            batch.write.mode("overwrite").parquet(stage)
            rows, max_seen, issues = observed()
            patch(phase_completed=2)
            if rows > 0:
                load = (_load_bucketed_target if spec.target_connection is None else
                        _load_warehouse_target if spec.target_connection.is_warehouse else _load_jdbc_target)
                drift_rows = load(spark, spec, spark.read.parquet(stage), defs, as_of, run_id, drift_log_path)
            anomaly, pct = volume_check(runs, spec.pipeline_id, rows, spec.upper_pct,
                                        spec.lower_pct)
            patch(status="complete", phase_completed=3, rows_loaded=rows,
                  volume_anomaly_flag=anomaly, max_seen=max_seen)
            flush()
            return LoadResult(run_id, "complete", rows, anomaly, pct, since, None, drift_rows,
                              max_seen=max_seen, cast_issues=issues)
        vt = VersionedTable(spark, spec.target_path)
        tag = f"run:{spec.pipeline_id}:{run_id}"  # pipelines may number their runs alone
        replayed = vt.has_tag(tag)  # a replayed run is not applied twice
        upper = (lambda c: c.upper()) if spec.upper_case else (lambda c: c)
        key = upper(spec.merge_key) if spec.merge_key else None
        latest = vt.latest_version()
        drift = None
        if latest is not None:
            # drift needs schemas only, so it is known before the batch is written
            current = vt.read()
            src_cols = spark.createDataFrame(
                [(spec.source_table, upper(n), i + 1, t) for i, (n, t) in enumerate(defs)], S.COLUMNS_SCHEMA)
            drift = S.detect_drift(src_cols, S.describe_target(current, spec.source_table))
            # Dropped columns become null, added ones travel with the
            # batch, changed types are widened by readers
            batch = S.align_batch(batch, current)
        keyed = spec.upsert != "append" and bool(key) and key in batch.columns
        if keyed and spec.upsert == "last_wins":
            batch = U.dedup_last_wins(batch, key, spec.order(upper))
        # the batch is written once, into the version's folder, and counted on
        # the way; readers see it only once it is committed
        nxt = 0 if latest is None else max(latest + 1, run_id)
        layer_rows = vt.write_files(batch, nxt)
        rows, max_seen, issues = observed()
        patch(phase_completed=2)
        if rows > 0 and not replayed:
            version = nxt
            if drift is not None:
                # bounded by the schema width, not by the data
                drift_rows = [r.asDict() for r in drift.collect()]
                if drift_log_path and drift_rows:
                    events = _drift_events(spark, drift_rows, spec.pipeline_id, run_id, as_of)
                    _only_new_drift(spark, events, drift_log_path, spec.pipeline_id) \
                        .write.mode("append").parquet(drift_log_path)
            # K1: the first load creates the table; K3/K4/K5: later ones add a layer
            vt.commit_files(version, layer_rows, None if not keyed or latest is None else key,
                            base=latest is None, committed_at=as_of, tag=tag)
            if latest is not None and vt.should_compact(spec.compact_max_layers, spec.compact_ratio):
                vt.compact(committed_at=as_of)

        anomaly, pct = volume_check(runs, spec.pipeline_id, rows, spec.upper_pct, spec.lower_pct)
        patch(status="complete", phase_completed=3, rows_loaded=rows,
              volume_anomaly_flag=anomaly, max_seen=max_seen)
        flush()
        return LoadResult(run_id, "complete", rows, anomaly, pct, since, version, drift_rows,
                          max_seen=max_seen, cast_issues=issues)
    except Exception as e:  # recorded, then raised as the reference does
        patch(status="failed", error_message=str(e))
        flush()
        raise


def _load_bucketed_target(spark: SparkSession, spec: LoadSpec, staged: DataFrame,
                          defs: list[tuple[str, str]], as_of: _dt.datetime, run_id: int,
                          drift_log_path: str | None) -> list[dict]:
    """The load's target lies in folders by key hash: the first load creates it
    (K1); later ones log the drift, add new columns (D1 D2) and rewrite the
    folders of the batch's keys (K3/K4). A replayed run changes nothing. A
    column whose type in the target does not hold every value of the new type
    ends the load before any row is applied; the drift is in the log then."""
    name = (lambda n: n.upper()) if spec.upper_case else (lambda n: n)
    key = name(spec.merge_key)
    if key not in staged.columns:
        raise ValueError(f"the source has no column {spec.merge_key} to deal its rows by")
    target = BucketedTarget(spark, spec.target_table, key, spec.buckets)
    run = f"run:{spec.pipeline_id}:{run_id}"  # pipelines may number their runs alone
    drift_rows: list[dict] = []
    if not target.exists():
        BucketedTarget.create(staged.limit(0), spec.target_table, key, spec.buckets, spec.target_path or None,
                              exist_ok=True)
    elif target.applied(run):
        return drift_rows
    else:
        current = target.read()
        src_cols = spark.createDataFrame(
            [(spec.source_table, name(n), i + 1, t) for i, (n, t) in enumerate(defs)], S.COLUMNS_SCHEMA)
        # bounded by the schema width, not by the data
        drift_rows = [r.asDict() for r in S.detect_drift(
            src_cols, S.describe_target(current, spec.source_table)).collect()]
        if drift_log_path and drift_rows:
            events = _drift_events(spark, drift_rows, spec.pipeline_id, run_id, as_of)
            _only_new_drift(spark, events, drift_log_path, spec.pipeline_id).write.mode("append").parquet(
                drift_log_path)
        staged = S.align_batch(staged, current)
    target.upsert(staged, run, spec.order(name) if spec.upsert == "last_wins" else None, written=True)
    return drift_rows


def _load_jdbc_target(spark: SparkSession, spec: LoadSpec, staged: DataFrame,
                      defs: list[tuple[str, str]], as_of: _dt.datetime, run_id: int,
                      drift_log_path: str | None) -> list[dict]:
    """The load's target is a database table (the reference's warehouse or
    fallback path), all set-based: create it with the mapped types when
    missing (K1); otherwise detect drift against its columns and add new
    ones with ALTER TABLE, recording ``auto_resolved`` or the error cut to
    200 characters (D1 D2); then stage the batch and apply it in one
    transaction (K3/K4/K5).

    A column that could not be added, or one whose type in the table does not
    hold every value of the new type, ends the load before any row is applied:
    the database would drop or round values. The drift is in the log then."""
    conn = spec.target_connection
    table = spec.target_table or spec.source_table.upper()
    name = (lambda n: n.upper()) if spec.upper_case else (lambda n: n)
    types = {name(n): target_type_for(t) for n, t in defs}
    key = name(spec.merge_key) if spec.merge_key else None
    keyed = spec.upsert != "append" and key is not None and key in staged.columns
    mode = "last_wins" if spec.upsert == "last_wins" else "delete_insert"
    order = spec.order(name)
    drift_rows: list[dict] = []
    existing = sinks.jdbc_table_schema(spark, conn, table)
    if existing is not None:
        src_cols = spark.createDataFrame(
            [(table, name(n), i + 1, t) for i, (n, t) in enumerate(defs)], S.COLUMNS_SCHEMA)
        tgt = S.describe_target(spark.createDataFrame([], existing), table)
        drift_rows = [r.asDict() for r in S.detect_drift(src_cols, tgt).collect()]
        for d in drift_rows:
            if d["change_type"] == "column_added":
                ddl = conn.add_column(table, d["column_name"], d["new_definition"])
                try:
                    sinks.execute_jdbc(spark, conn, [ddl])
                    d["status"] = S.heal_status(None)
                except Exception as e:  # the reference logs the failure and goes on
                    d["status"] = S.heal_status(str(e))
        if drift_log_path and drift_rows:
            events = _drift_events(spark, drift_rows, spec.pipeline_id, run_id, as_of)
            _only_new_drift(spark, events, drift_log_path, spec.pipeline_id) \
                .write.mode("append").parquet(drift_log_path)
        refuse_losses(drift_rows, staged, existing)
    sinks.jdbc_upsert(staged, conn, table, key if keyed else None, mode=mode, order_cols=order,
                      column_types=types, run_tag=f"{spec.pipeline_id}:{run_id}")
    return drift_rows


def refuse_losses(drift_rows: list[dict], staged: DataFrame, target: T.StructType) -> None:
    """Raise if the target cannot take the staged batch whole: a column that
    was to be added and was not, or a changed type that is wider than, or
    unlike, the target's own (``target`` lists the types that are known)."""
    lost = [r["column_name"] for r in drift_rows
            if r["change_type"] == "column_added" and r["status"] not in ("auto_resolved", "pending_review")]
    if lost:
        raise ValueError(f"columns that the target lacks could not be added: {lost}")
    held = {f.name.upper(): f.dataType for f in target.fields}
    mine = {f.name.upper(): f.dataType for f in staged.schema.fields}
    changed = [r["column_name"] for r in drift_rows if r["change_type"] == "type_changed"]
    unlike = [c for c in changed if c.upper() in mine and (
        c.upper() not in held or widest(held[c.upper()], mine[c.upper()]) != held[c.upper()])]
    if unlike:
        raise ValueError(f"types that the target's columns cannot hold, change them first: {unlike}")


def _load_warehouse_target(spark: SparkSession, spec: LoadSpec, staged: DataFrame,
                           defs: list[tuple[str, str]], as_of: _dt.datetime, run_id: int,
                           drift_log_path: str | None) -> list[dict]:
    """The load's target is a warehouse table: one path for creating it with
    the mapped types (K1), detecting drift and adding columns (D1 D2), last
    wins (K4), staging and one set of statements (K2 K3), through the
    warehouse's Spark connector."""
    conn = spec.target_connection
    table = (spec.target_table or spec.source_table).upper()
    database = spec.target_database or conn.db_name
    name = (lambda n: n.upper()) if spec.upper_case else (lambda n: n)
    key = name(spec.merge_key) if spec.merge_key else None
    keyed = spec.upsert != "append" and key is not None and key in staged.columns
    have = sinks.warehouse_columns(spark, conn, database, spec.target_schema, table)
    drift_rows: list[dict] = []
    if have:
        src = spark.createDataFrame([(table, name(n), i + 1, t) for i, (n, t) in enumerate(defs)], S.COLUMNS_SCHEMA)
        tgt = spark.createDataFrame([(table, c, i, t) for c, t, i in have], S.COLUMNS_SCHEMA)
        drift_rows = [r.asDict() for r in S.detect_drift(src, tgt).collect()]
        if drift_log_path and drift_rows:  # in the log even if the load ends here
            _only_new_drift(spark, _drift_events(spark, drift_rows, spec.pipeline_id, run_id, as_of), drift_log_path,
                            spec.pipeline_id).write.mode("append").parquet(drift_log_path)
        held = {c.upper(): held_type(t) for c, t, _ in have}
        refuse_losses(drift_rows, staged, T.StructType([T.StructField(c, t) for c, t in held.items() if t is not None]))
    if keyed and spec.upsert == "last_wins":
        staged = U.dedup_last_wins(staged, key, spec.order(name))
    sinks.warehouse_writer(staged, conn, database, spec.target_schema, table, key if keyed else None,
                           types={name(n): target_type_for(t) for n, t in defs},
                           have=[c for c, _, _ in have] if have else None,
                           run_tag=f"{spec.pipeline_id}:{run_id}").save()
    return drift_rows


def _drift_events(spark: SparkSession, rows: list[dict], pipeline_id: int, run_id: int,
                  as_of: _dt.datetime) -> DataFrame:
    """Log rows of drift events. An event's id is a hash of what it is about,
    so ids of different runs and wide tables do not meet."""
    return (spark.createDataFrame(rows, S.DRIFT_SCHEMA)
            .withColumn("pipeline_id", F.lit(pipeline_id).cast("bigint"))
            .withColumn("detected_at", ts_lit(as_of))
            .withColumn("id", F.xxhash64("pipeline_id", F.lit(run_id).cast("bigint"), "table_name",
                                         "column_name", "change_type")))


def _only_new_drift(spark: SparkSession, events: DataFrame, log_path: str,
                    pipeline_id: int) -> DataFrame:
    """Drop events already pending for the same column and change (Q11)."""
    from pyspark.errors import AnalysisException
    if path_exists(spark, log_path) is False:
        return events
    try:
        logged = spark.read.parquet(log_path).where(F.col("pipeline_id") == pipeline_id)
    except AnalysisException:
        return events
    return S.new_drift_events(events, logged)


def resolve_drift(spark: SparkSession, state: DataFrame, drift_id: int, action: str,
                  resolved_by, as_of: _dt.datetime, target_path: str | None = None,
                  resolutions_path: str | None = None, target_connection: Connection | None = None,
                  target_table: str | None = None, on_cast_error: str = "fail") -> DataFrame:
    """Resolve one drift event (D5): ``dismiss``, or ``apply_type_change``
    (type changes only), which first changes the column - as a new version of
    a versioned target, or with ALTER TABLE on a database or warehouse, whose
    own values are read and tested before. Without a target,
    or where values would be lost (unless ``on_cast_error="null"``), it
    refuses. Only then is the resolution appended to ``resolutions_path`` and
    returned."""
    ev = state.where(F.col("id") == drift_id).select("change_type", "column_name",
                                                      "new_definition").first()
    if ev is None:
        raise KeyError(f"drift event {drift_id} not found")
    res = S.resolution_event(spark, drift_id, action, resolved_by, as_of)
    if action == "apply_type_change":
        if ev["change_type"] != "type_changed":
            raise ValueError("apply_type_change is only valid for type_changed events")
        if target_path:
            vt = VersionedTable(spark, target_path)
            cur = vt.read()
            col = next((c for c in cur.columns if c.upper() == ev["column_name"].upper()), None)
            if col is None:
                raise KeyError(f"the target has no column {ev['column_name']}")
            loss = S.cast_loss(cur, {col: ev["new_definition"]}).first()
            if on_cast_error == "fail" and (loss["n_failed"] or loss["n_changed"]):
                raise ValueError(f"{col} to {ev['new_definition']} would lose values: {loss.asDict()}")
            vt.write(S.apply_type_change(cur, col, ev["new_definition"]), vt.next_version(),
                     None, as_of)
        elif target_connection is not None and target_table:
            change = target_connection.change_type(target_table, ev["column_name"], ev["new_definition"])
            if on_cast_error == "fail":
                loss = S.cast_loss(sinks.read_column(spark, target_connection, target_table, ev["column_name"]),
                                   {ev["column_name"]: ev["new_definition"]}).first()
                if loss["n_failed"] or loss["n_changed"]:
                    raise ValueError(f"{ev['column_name']} to {ev['new_definition']} would lose values: {loss.asDict()}")
            if target_connection.is_warehouse:
                sinks.execute_warehouse(spark, target_connection, [change])
            else:
                sinks.execute_jdbc(spark, target_connection, [change])
        else:
            raise ValueError("apply_type_change needs a target_path, or a target_connection and target_table")
    if resolutions_path:
        res.write.mode("append").parquet(resolutions_path)
    return res
