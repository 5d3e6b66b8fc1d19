"""Run history analytics: high-water marks, volume checks, run feeds.

Input ``runs`` has the columns of a run record: run_id, pipeline_id,
status, started_at, ended_at, rows_loaded (and, where flagged,
volume_anomaly_flag). Every time-dependent function takes ``as_of``;
nothing reads the wall clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import (
    DEFAULT_BLOCK_ROWS, group_row_number, range_row_number, ranged, trailing_frame,
)
from tidemark.functions.exprs import (
    ERROR_TEXT_LIMIT, TERMINAL_STATUSES, cut, duration_seconds, minus_interval,
    month_day, ts_lit,
)

# --- fixed values: defaults of the reference ---------------------------------
VOLUME_UPPER_PCT = 200
VOLUME_LOWER_PCT = 50
VOLUME_HISTORY_RUNS = 7
WATERMARK_LOOKBACK_DAYS = 30
RECENT_RUNS_LIMIT = 30
FEED_PER_PIPELINE = 100
PAGE_SIZE = 10
ANOMALY_FEED_SIZE = 6
# --- end of fixed values -----------------------------------------------------

def _newest() -> list[Column]:
    """Newest first, as the run history is listed: nulls first, like a
    descending order in the reference's database."""
    return [F.col("started_at").desc_nulls_first(), F.col("run_id").desc_nulls_first()]


def _as_of(as_of: _dt.datetime | str | Column) -> Column:
    return as_of if isinstance(as_of, Column) else ts_lit(as_of)


# ---------------------------------------------------------------- filters (F*)

def trailing(df: DataFrame, ts_col: str, as_of, days: int = 0, hours: int = 0) -> DataFrame:
    """Rows with ``ts_col >= as_of - interval``."""
    return df.where(F.col(ts_col) >= minus_interval(_as_of(as_of), days=days, hours=hours))


def with_status(df: DataFrame, *statuses: str) -> DataFrame:
    return df.where(F.col("status").isin(*statuses))


def filter_runs(runs: DataFrame, pipeline_id=None, status: str | None = None) -> DataFrame:
    """Optional pipeline and status filters; ``None`` means all."""
    if pipeline_id is not None:
        runs = runs.where(F.col("pipeline_id") == F.lit(pipeline_id))
    if status is not None:
        runs = runs.where(F.col("status") == F.lit(status))
    return runs


def outside_band(rows: Column, mean: Column, lower: Column, upper: Column) -> Column:
    """True when rows / mean * 100 is below ``lower`` or above ``upper``
    percent; false when there is no positive mean (F11)."""
    has_mean = mean.isNotNull() & (mean > 0)
    pct = F.when(has_mean, rows / mean * F.lit(100.0))
    return F.coalesce(has_mean & ((pct < lower) | (pct > upper)), F.lit(False))


def anomalies_or_failures(runs: DataFrame) -> DataFrame:
    return runs.where(F.coalesce(F.col("volume_anomaly_flag"), F.lit(False))
                      | (F.col("status") == "failed"))


# ----------------------------------------------------------- watermark (A3)

def resolve_watermark(runs: DataFrame, pipelines: DataFrame | None = None, as_of=None,
                      lookback_days: int = WATERMARK_LOOKBACK_DAYS) -> DataFrame:
    """High-water mark per pipeline: end of the last complete run, else
    ``as_of`` minus 30 days. With ``pipelines`` given, every pipeline gets a
    row (those without a complete run get the default)."""
    marks = (runs.where(F.col("status") == "complete")
             .groupBy("pipeline_id").agg(F.max("ended_at").alias("last_complete_end")))
    if pipelines is not None:
        marks = (pipelines.select(F.col("id").alias("pipeline_id"))
                 .join(marks, "pipeline_id", "left"))
    default = minus_interval(_as_of(as_of), days=lookback_days)
    return marks.select("pipeline_id", F.coalesce("last_complete_end", default).alias("watermark"),
                        F.col("last_complete_end").isNull().alias("is_default"))


# ----------------------------------------------------- latest / recent

def latest_runs(runs: DataFrame) -> DataFrame:
    """Run count and newest run (by started_at, then run_id) per pipeline.

    A grouped ``max_by`` rather than a window: it combines map-side, so a
    pipeline holding most runs is reduced before the shuffle."""
    last = F.max_by(F.struct("run_id", "status", "started_at", "ended_at", "rows_loaded"),
                    F.struct("started_at", "run_id"))
    return (runs.groupBy("pipeline_id")
            .agg(F.count(F.lit(1)).alias("total_runs"), last.alias("last"))
            .select("pipeline_id", "total_runs",
                    F.col("last.run_id").alias("last_run_id"),
                    F.col("last.status").alias("last_status"),
                    F.col("last.started_at").alias("last_run_at"),
                    F.col("last.rows_loaded").alias("last_rows_loaded")))


def recent_runs(runs: DataFrame, n: int = RECENT_RUNS_LIMIT,
                partition: str = "pipeline_id") -> DataFrame:
    """Newest ``n`` runs of every pipeline.

    ``row_number() <= n`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so at most ``n`` rows per pipeline and map task
    are exchanged however large one pipeline's history is."""
    w = Window.partitionBy(partition).orderBy(*_newest())
    return (runs.withColumn("recency", F.row_number().over(w))
            .where(F.col("recency") <= n))


def runs_feed(runs: DataFrame, pipelines: DataFrame,
              per_pipeline: int = FEED_PER_PIPELINE) -> DataFrame:
    """Newest runs of each pipeline with the pipeline's name, newest first."""
    names = pipelines.select(F.col("id").alias("pipeline_id"), F.col("name").alias("pipeline_name"))
    return (recent_runs(runs, per_pipeline).drop("recency")
            .join(names, "pipeline_id", "inner")
            .orderBy(*_newest()))


def recent_for_pipeline(runs: DataFrame, pipeline_id, n: int = RECENT_RUNS_LIMIT) -> DataFrame:
    """One pipeline's newest ``n`` runs (a top-k, not a full sort)."""
    return filter_runs(runs, pipeline_id).orderBy(*_newest()).limit(n)


# -------------------------------------------------------- volume check

def volume_anomaly(runs: DataFrame, upper_pct: int = VOLUME_UPPER_PCT,
                   lower_pct: int = VOLUME_LOWER_PCT,
                   thresholds: DataFrame | None = None,
                   history: int = VOLUME_HISTORY_RUNS, block_rows: int = DEFAULT_BLOCK_ROWS,
                   keep: list[str] | None = None, split_days: bool = False) -> DataFrame:
    """Flag each complete run whose row count is outside the band around the
    mean of the previous ``history`` complete runs of its pipeline.

    pct = rows / mean * 100; flagged when pct < lower or pct > upper. Null
    row counts count as 0 in the mean. No history, or a mean <= 0, is never
    flagged. ``thresholds`` (id, volume_alert_upper_pct,
    volume_alert_lower_pct) overrides the bounds per pipeline.

    Runs are numbered by pipeline and day and the trailing frame is evaluated
    in blocks, so a pipeline holding most runs is spread over many tasks. Runs
    without a pipeline are a group of their own.

    With ``split_days`` the runs are dealt into ranges of (pipeline, start, id)
    by quantiles and written once, so that a day, or a moment, holding most runs
    is spread over many tasks too; the flags are the same. Without it nothing is
    written, and the runs of one pipeline and day are numbered by one task.
    """
    base_cols = ["run_id", "pipeline_id", "started_at", "rows_loaded"]
    carried = base_cols + [c for c in (keep or []) if c not in base_cols]
    done = runs.where(F.col("status") == "complete").select(*carried)
    rows0 = F.coalesce(F.col("rows_loaded"), F.lit(0))
    aggs = {"history_runs": F.count(F.lit(1)), "avg_prev": F.avg(rows0)}
    order = ["started_at", "run_id"]
    if split_days:
        numbered = range_row_number(ranged(done, ["pipeline_id", *order]), ["pipeline_id"], order).drop("_part")
    else:
        numbered = group_row_number(done, "pipeline_id", order, F.to_date("started_at"))
    scored = trailing_frame(numbered, "pipeline_id", "rn", history, aggs, block_rows).drop("rn")
    return judge_volume(scored, upper_pct, lower_pct, thresholds)


def judge_volume(scored: DataFrame, upper_pct: int = VOLUME_UPPER_PCT, lower_pct: int = VOLUME_LOWER_PCT,
                 thresholds: DataFrame | None = None) -> DataFrame:
    """``scored`` runs (with ``history_runs`` and ``avg_prev``) with their share
    of the mean, ``pct``, and ``volume_anomaly_flag``."""
    base_cols = ["run_id", "pipeline_id", "started_at", "rows_loaded"]
    extra = [c for c in scored.columns if c not in (*base_cols, "history_runs", "avg_prev")]
    if thresholds is not None:
        th = thresholds.select(F.col("id").alias("pipeline_id"),
                               F.col("volume_alert_upper_pct").alias("_up"),
                               F.col("volume_alert_lower_pct").alias("_lo"))
        scored = scored.join(th, "pipeline_id", "left")
        up = F.coalesce(F.col("_up"), F.lit(upper_pct))
        lo = F.coalesce(F.col("_lo"), F.lit(lower_pct))
    else:
        up, lo = F.lit(upper_pct), F.lit(lower_pct)
    has_mean = (F.col("history_runs") > 0) & (F.col("avg_prev") > 0)
    pct = F.when(has_mean, F.col("rows_loaded") / F.col("avg_prev") * F.lit(100.0))
    out = scored.withColumn("pct", pct).withColumn(
        "volume_anomaly_flag",
        outside_band(F.col("rows_loaded"), F.when(F.col("history_runs") > 0, F.col("avg_prev")),
                     lo, up))
    return out.select(*base_cols, "history_runs", "avg_prev", "pct", "volume_anomaly_flag", *extra)


def with_anomaly_flags(runs: DataFrame, **kwargs) -> DataFrame:
    """Runs with ``volume_anomaly_flag`` (false for runs that are not complete).

    Complete runs carry all their columns through the check and the others
    are added back with a false flag: a union, not a join back on run id."""
    cols = [c for c in runs.columns if c != "volume_anomaly_flag"]
    scored = volume_anomaly(runs.select(*cols), keep=cols, **kwargs).select(
        *cols, "volume_anomaly_flag")
    rest = (runs.select(*cols).where(~F.coalesce(F.col("status") == "complete", F.lit(False)))
            .withColumn("volume_anomaly_flag", F.lit(False)))
    return scored.unionByName(rest)


# ----------------------------------------------------- daily volume (A2 A10)

def volume_history(runs: DataFrame, as_of, days: int = WATERMARK_LOOKBACK_DAYS,
                   by_pipeline: bool = True) -> DataFrame:
    """Per pipeline and day of the last ``days`` days: rows, runs, whether a
    run failed or was flagged. ``by_pipeline=False`` sums all pipelines."""
    keys = (["pipeline_id"] if by_pipeline else []) + ["run_date"]
    flag = (F.col("volume_anomaly_flag") if "volume_anomaly_flag" in runs.columns
            else F.lit(False))
    return (trailing(runs, "started_at", as_of, days=days)
            .withColumn("run_date", F.to_date("started_at"))
            .withColumn("_anom", flag)
            .groupBy(*keys)
            .agg(F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
                 F.count(F.lit(1)).alias("run_count"),
                 F.max(F.when(F.col("status") == "failed", 1).otherwise(0)).alias("had_failure"),
                 F.max(F.when(F.col("_anom"), 1).otherwise(0)).alias("had_anomaly"))
            .orderBy(*keys))


def volume_scale(daily: DataFrame, partition: str | None = "pipeline_id") -> DataFrame:
    """Peak daily rows (at least 1) and each day's share of it, with a
    month-day label. The daily table is one row per pipeline and day."""
    w = Window.partitionBy(partition) if partition else Window.partitionBy()
    peak = F.greatest(F.max(F.coalesce(F.col("rows_loaded"), F.lit(0))).over(w), F.lit(1))
    return (daily.withColumn("peak_rows", peak.cast("bigint"))
            .withColumn("share_of_peak",
                        F.coalesce(F.col("rows_loaded"), F.lit(0)) / F.col("peak_rows"))
            .withColumn("day_label", month_day("run_date")))


# -------------------------------------------------------- counters

def platform_stats(pipelines: DataFrame, connections: DataFrame, runs: DataFrame,
                   drift: DataFrame, as_of) -> DataFrame:
    """Dashboard counters in one row. Each input contributes tagged rows to
    one union that a single global aggregate folds (no joins of one-row
    frames)."""
    ref = _as_of(as_of)
    day = minus_interval(ref, hours=24)
    week = minus_interval(ref, days=7)
    zero = F.lit(0)
    cols = ["p", "c", "r24", "f24", "a7", "d"]

    def tagged(df: DataFrame, **vals: Column) -> DataFrame:
        return df.select(*[F.when(vals[c], 1).otherwise(0).alias(c) if c in vals
                           else zero.alias(c) for c in cols])

    parts = (tagged(pipelines, p=F.col("is_active"))
             .unionByName(tagged(connections, c=F.col("is_active")))
             .unionByName(tagged(runs,
                                 r24=F.col("started_at") >= day,
                                 f24=(F.col("started_at") >= day) & (F.col("status") == "failed"),
                                 a7=F.coalesce(F.col("volume_anomaly_flag"), F.lit(False))
                                 & (F.col("started_at") >= week)))
             .unionByName(tagged(drift, d=F.col("status") == "pending_review")))
    names = {"p": "total_pipelines", "c": "total_connections", "r24": "runs_today",
             "f24": "failed_today", "a7": "anomalies_7d", "d": "drift_pending"}
    return parts.agg(*[F.coalesce(F.sum(c), zero).cast("bigint").alias(names[c]) for c in cols])


def run_status_totals(runs: DataFrame, by_pipeline: bool = False) -> DataFrame:
    """Run totals by status plus flagged runs, overall or per pipeline."""
    st = F.col("status")
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_if(st == "complete").alias("complete"),
            F.count_if(st == "failed").alias("failed"),
            F.count_if(st == "running").alias("running"),
            F.count_if(F.coalesce(F.col("volume_anomaly_flag"), F.lit(False))).alias("anomalies")]
    return runs.groupBy("pipeline_id").agg(*aggs) if by_pipeline else runs.agg(*aggs)


# ------------------------------------------------------ feeds and pages (L*)

def anomaly_feed(runs: DataFrame, n: int = ANOMALY_FEED_SIZE) -> DataFrame:
    """Newest ``n`` runs that were flagged or failed (top-k)."""
    return anomalies_or_failures(runs).orderBy(*_newest()).limit(n)


def run_page(runs: DataFrame, page: int, size: int = PAGE_SIZE, pipeline_id=None,
             status: str | None = None) -> DataFrame:
    """Page ``page`` (0-based) of the filtered runs, newest first."""
    return (filter_runs(runs, pipeline_id, status).orderBy(*_newest())
            .offset(page * size).limit(size))


def page_count(runs: DataFrame, size: int = PAGE_SIZE, pipeline_id=None,
               status: str | None = None) -> DataFrame:
    return (filter_runs(runs, pipeline_id, status)
            .agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("bigint").alias("total_pages")))


def run_durations(runs: DataFrame) -> DataFrame:
    """Whole-second duration of each run and its display text."""
    d = duration_seconds("started_at", "ended_at")
    label = (F.when(d.isNotNull(), F.concat(d.cast("string"), F.lit("s")))
             .when(F.col("status") == "running", F.lit("running…"))
             .otherwise(F.lit("—")))
    return runs.select("run_id", "pipeline_id", "status", "started_at", "ended_at",
                       d.alias("duration_s"), label.alias("duration_label"))


# ------------------------------------------------------ run record fold (K7)

_PATCH_FIELDS = ("status", "rows_loaded", "error_message", "volume_anomaly_flag",
                 "phase_completed", "max_seen", "cast_issues")


def run_state(patches: DataFrame, id_col: str = "run_id", seq_col: str = "seq",
              at_col: str = "patched_at") -> DataFrame:
    """Current record of each run from its append-only patch events.

    A patch changes only the fields it carries (non-null); later patches
    (by ``seq``) win. Error text is cut to 2000 characters. A patch with a
    terminal status sets ``ended_at`` to its own time. One grouped
    aggregate: every field is a ``max_by`` over the patches that set it.
    """
    seq = F.col(seq_col)
    fields = [f for f in ("pipeline_id", *_PATCH_FIELDS) if f in patches.columns]
    aggs = [F.min(at_col).alias("started_at"), F.count(F.lit(1)).alias("n_patches")]
    for f in fields:
        # error text is cut before it is shuffled
        value = cut("error_message", ERROR_TEXT_LIMIT) if f == "error_message" else F.col(f)
        aggs.append(F.max_by(value, F.when(F.col(f).isNotNull(), seq)).alias(f))
    terminal = F.col("status").isin(*TERMINAL_STATUSES)
    aggs.append(F.max_by(F.col(at_col), F.when(terminal, seq)).alias("ended_at"))
    return patches.groupBy(id_col).agg(*aggs)
