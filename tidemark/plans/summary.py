"""Run counts by pipeline and day, kept up as runs arrive or are corrected.

The monitor's totals and daily volumes are sums over (pipeline, day). Those
sums are stored in a folder per day; a refresh computes the days that changed
anew, from the runs of those days alone, and overwrites their folders. Totals
then read the summary, a few numbers per pipeline and day, not the history.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import minus_interval
from tidemark.operators import runs as R
from tidemark.plans.buckets import _setting

DAY = "run_date"
COUNTS = ["total", "complete", "failed", "running", "anomalies"]


def summarise(runs: DataFrame) -> DataFrame:
    """(pipeline_id, run_date) with the sum of rows and the counts of runs, by
    status and flagged. Runs without a start have a null day; without a
    pipeline, a null pipeline."""
    flag = F.col("volume_anomaly_flag") if "volume_anomaly_flag" in runs.columns else F.lit(False)
    status = F.col("status")
    return (runs.groupBy("pipeline_id", F.to_date("started_at").alias(DAY))
            .agg(F.sum("rows_loaded").cast("bigint").alias("rows_loaded"), F.count(F.lit(1)).alias("total"),
                 *[F.count_if(status == s).alias(s) for s in COUNTS[1:4]],
                 F.count_if(F.coalesce(flag, F.lit(False))).alias("anomalies")))


def days_of(*runs: DataFrame) -> list[_dt.date | None]:
    """Days on which the given runs start, one value per day. A corrected run
    counts with its old and its new record."""
    found: set[_dt.date | None] = set()
    for df in runs:
        found |= {r[0] for r in df.select(F.to_date("started_at")).distinct().collect()}
    return sorted(found, key=lambda d: (d is not None, d))


def on_days(runs: DataFrame, days: list[_dt.date | None]) -> DataFrame:
    """Runs that start on one of ``days``. The range of the days goes to the
    scan as a filter on ``started_at``."""
    at, whole = F.col("started_at"), [d for d in days if d is not None]
    cond = F.lit(False)
    if whole:
        kind = runs.schema["started_at"].dataType
        first, after = (F.lit(d).cast(kind) for d in (min(whole), max(whole) + _dt.timedelta(days=1)))
        cond = (at >= first) & (at < after) & F.to_date(at).isin(whole)
    if None in days:
        cond = cond | at.isNull()
    return runs.where(cond)


class RunSummary:
    """A summary at ``path``; the first ``refresh`` (with ``days=None``) makes it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def refresh(self, runs: DataFrame, days: list[_dt.date | None] | None = None) -> None:
        """Brings ``days`` (None: all) in line with ``runs``, the whole run
        table. A day that lost its last run gets an empty record, so that its
        folder is replaced as well. Repeating a refresh changes nothing."""
        new = summarise(runs if days is None else on_days(runs, days))
        if days:
            gone = self.spark.createDataFrame([(d,) for d in days], f"{DAY} date")
            new = new.unionByName(gone.withColumn("total", F.lit(0).cast("bigint")), allowMissingColumns=True)
        elif days is not None:
            return
        mode = "static" if days is None else "dynamic"
        with _setting(self.spark, "spark.sql.sources.partitionOverwriteMode", mode):
            new.repartition(DAY).write.partitionBy(DAY).mode("overwrite").parquet(self.path)

    def read(self) -> DataFrame:
        schema = ("pipeline_id long, rows_loaded long, total long, complete long, failed long, running long, "
                  f"anomalies long, {DAY} date")
        return self.spark.read.schema(schema).parquet(self.path).where("total > 0")

    def totals(self, by_pipeline: bool = False) -> DataFrame:
        """``run_status_totals`` of all runs."""
        sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in COUNTS]
        return self.read().groupBy("pipeline_id").agg(*sums) if by_pipeline else self.read().agg(*sums)

    def history(self, runs: DataFrame, as_of: _dt.datetime | str | Column,
                days: int = R.WATERMARK_LOOKBACK_DAYS, by_pipeline: bool = True) -> DataFrame:
        """``volume_history`` of ``runs``. Whole days come from the summary; of
        the runs only the window's first, partial day is read."""
        start = minus_interval(R._as_of(as_of), days=days)
        first = self.spark.range(1).select(F.to_date(start)).first()[0]
        part = summarise(R.trailing(on_days(runs, [first]), "started_at", as_of, days=days))
        whole = self.read().where(F.col(DAY) > F.lit(first))
        keys = (["pipeline_id"] if by_pipeline else []) + [DAY]
        return (whole.unionByName(part.select(whole.columns)).groupBy(*keys)
                .agg(F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
                     F.sum("total").cast("bigint").alias("run_count"),
                     F.max(F.when(F.col("failed") > 0, 1).otherwise(0)).alias("had_failure"),
                     F.max(F.when(F.col("anomalies") > 0, 1).otherwise(0)).alias("had_anomaly"))
                .orderBy(*keys))
