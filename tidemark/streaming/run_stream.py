"""Run records and volume histories kept up by streams.

``fold_patches`` is the run-record fold (``run_state``) as a streaming
aggregate: one state entry per run, updated by the patches that arrive, in any
order and however often. ``trailing_history`` keeps, per pipeline, the complete
runs that a late run may still touch, and emits every run whose seven
predecessors changed. ``ChangeLog`` stores what a stream emits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.runs import VOLUME_HISTORY_RUNS, judge_volume, run_state, volume_anomaly
from tidemark.plans.buckets import _setting
from tidemark.plans.layout import _micros

BATCH = "_batch"
NONE = -(2**63)  # no pipeline, no start: the least key, first in order
DAY_US = 86_400_000_000
_STATE = "started array<long>, ids array<long>, rows array<long>, known array<boolean>, open_from long"
_OUT = "_key long, run_id long, started_us long, rows_loaded long, history_runs long, sum_prev long, late boolean"

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package


def fold_patches(patches: DataFrame, id_col: str = "run_id", seq_col: str = "seq",
                 at_col: str = "patched_at") -> DataFrame:
    """``run_state`` of a stream of patches, for update mode: the record of each
    run that got a patch. A patch is known by its run and ``seq``, so one that
    arrives again changes nothing. Patches of a micro-batch are combined before
    they are shuffled, so a run with most patches is no hot task."""
    return run_state(patches.dropDuplicates([id_col, seq_col]), id_col, seq_col, at_col)


def _histories(rows: dict[int, tuple], history: int) -> dict[int, tuple]:
    """id -> (start, rows, known, number of predecessors, their sum), in order of (start, id)."""
    ids = sorted(rows, key=lambda i: (rows[i][0], i))
    total = np.concatenate([[0], np.cumsum([rows[i][1] for i in ids], dtype=np.int64)])
    out = {}
    for place, i in enumerate(ids):
        first = max(0, place - history)
        out[i] = (*rows[i], place - first, int(total[place] - total[first]))
    return out


def _update(history: int, lateness_us: int | None):
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old, open_from = {}, NONE
        if state.exists:
            started, ids, counts, known, open_from = state.get
            old = {int(i): (int(s), int(n), bool(k)) for s, i, n, k in zip(started, ids, counts, known)}
        arrived: dict[int, tuple] = {}
        for pdf in batches:
            for i, *run in zip(pdf["run_id"], pdf["started_us"], pdf["n"], pdf["known"]):
                run = (int(run[0]), int(run[1]), bool(run[2]))
                arrived[int(i)] = max(arrived.get(int(i), run), run)
        # runs before open_from serve as predecessors only: what stood before them is no longer held
        late = {i for i, run in arrived.items() if old.get(i) != run
                and (run[0] < open_from or (i in old and old[i][0] < open_from))}
        new = {**old, **{i: run for i, run in arrived.items() if i not in late}}
        before = _histories(old, history)
        out = [(i, s, n if k else None, m, t, False) for i, (s, n, k, m, t) in _histories(new, history).items()
               if s >= open_from and i not in late and before.get(i) != (s, n, k, m, t)]
        out += [(i, s, n if k else None, None, None, True) for i, (s, n, k) in arrived.items() if i in late]
        if lateness_us is not None and new:
            newest = max(v[0] for v in new.values())
            open_from = max(open_from, newest - lateness_us if newest != NONE else NONE)
            ids = sorted(new, key=lambda i: (new[i][0], i))
            closed = [i for i in ids if new[i][0] < open_from]
            for i in closed[:max(0, len(closed) - history)]:
                del new[i]
        state.update(([v[0] for v in new.values()], list(new), [v[1] for v in new.values()],
                      [v[2] for v in new.values()], open_from))
        if not out:
            return
        yield pd.DataFrame({
            "_key": pd.array([key[0]] * len(out), "Int64"),
            **{name: pd.array([o[j] for o in out], kind) for j, (name, kind) in enumerate((
                ("run_id", "Int64"), ("started_us", "Int64"), ("rows_loaded", "Int64"), ("history_runs", "Int64"),
                ("sum_prev", "Int64"), ("late", "boolean")))}})
    return update


def trailing_history(runs: DataFrame, lateness_days: float | None = None,
                     history: int = VOLUME_HISTORY_RUNS) -> DataFrame:
    """Number and sum of rows of the ``history`` complete runs before each
    complete run of its pipeline, for update mode. A run that arrives late, or
    again with another count or an earlier start, changes up to ``history`` runs
    after it: these are emitted anew. A run that arrives again unchanged emits
    nothing. Of two records of a run in one micro-batch the one with the greater
    start and count is taken. A run keeps its pipeline, and its start does not
    move forward (it is the time of its first patch).

    State per pipeline: runs not older than ``lateness_days`` before its newest
    one, and ``history`` more; with ``None`` all of them. A run older than that
    is emitted with ``late`` set and without a history; ``volume_from`` computes
    the pipelines that have one from the whole run table. Runs without an id
    are no run records and left out; without a pipeline they are a group."""
    at = F.coalesce(_micros(F.col("started_at").cast("timestamp_ntz")), F.lit(NONE))
    done = (runs.where((F.col("status") == "complete") & F.col("run_id").isNotNull())
            .select(F.coalesce(F.col("pipeline_id").cast("long"), F.lit(NONE)).alias("_key"),
                    F.col("run_id").cast("long").alias("run_id"), at.alias("started_us"),
                    F.coalesce(F.col("rows_loaded").cast("long"), F.lit(0)).alias("n"),
                    F.col("rows_loaded").isNotNull().alias("known")))
    late = None if lateness_days is None else int(lateness_days * DAY_US)
    out = done.groupBy("_key").applyInPandasWithState(
        _update(history, late), _OUT, _STATE, "update", GroupStateTimeout.NoTimeout)
    start = F.timestamp_add("MICROSECOND", F.nullif("started_us", F.lit(NONE)),
                            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return out.select("run_id", F.nullif("_key", F.lit(NONE)).alias("pipeline_id"), start.alias("started_at"),
                      "rows_loaded", "history_runs",
                      F.when(F.col("history_runs") > 0, F.col("sum_prev") / F.col("history_runs")).alias("avg_prev"),
                      "late")


def volume_from(kept: DataFrame, runs: DataFrame, thresholds: DataFrame | None = None, **bounds) -> DataFrame:
    """``volume_anomaly`` from the newest rows of ``trailing_history``. Pipelines
    with a run that came too late are computed from ``runs``, the run table."""
    repair = kept.where("late").select(F.col("pipeline_id").alias("_p")).distinct()
    same = F.col("pipeline_id").eqNullSafe(F.col("_p"))
    good = judge_volume(kept.join(repair, same, "left_anti").drop("late"), thresholds=thresholds, **bounds)
    return good.unionByName(volume_anomaly(runs.join(repair, same, "left_semi"), thresholds=thresholds, **bounds))


class ChangeLog:
    """What a stream in update mode emits, at ``path``: a folder per
    micro-batch, replaced when a batch is replayed. ``read`` gives the newest
    row of each key."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def sink(self):
        """The ``foreachBatch`` function. One stream (one checkpoint) a log."""
        path = self.path

        def write(batch: DataFrame, batch_id: int) -> None:
            with _setting(batch.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                (batch.withColumn(BATCH, F.lit(int(batch_id)).cast("long"))
                 .write.partitionBy(BATCH).mode("overwrite").parquet(path))

        return write

    def read(self, keys: Sequence[str]) -> DataFrame:
        log = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())]))
        rest = [c for c in self.schema.names if c not in keys]
        return (log.parquet(self.path).groupBy(*keys)
                .agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("_row"))
                .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in self.schema.names]))


def run_stream(changes: DataFrame, log: ChangeLog, checkpoint_location: str, available_now: bool = True,
               processing_time: str | None = None):
    """Start writing ``changes``, a streaming DataFrame of the functions above,
    into ``log``. Returns the StreamingQuery."""
    writer = (changes.writeStream.outputMode("update").foreachBatch(log.sink())
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 minute")
    return writer.start()
