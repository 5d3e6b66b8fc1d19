"""Stateful streams of runs and patches against the batch operators."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import runs as R
from tidemark.streaming.run_stream import (
    ChangeLog, fold_patches, run_stream, trailing_history, volume_from,
)

BASE = dt.datetime(2024, 1, 1)
RUN = "run_id long, pipeline_id long, started_at timestamp_ntz, status string, rows_loaded long"
PATCH = ("run_id long, seq long, patched_at timestamp_ntz, status string, rows_loaded long, error_message string, "
         "phase_completed int")


def rows(df, *cols):
    return sorted(map(repr, df.select(*(cols or df.columns)).collect()))


def stream(spark, tmp, batches, schema, changes, keys):
    """The log after each list of rows has arrived in a run of its own."""
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(tmp + "/in")
        made = changes(spark.readStream.schema(schema).parquet(tmp + "/in"))
        log = ChangeLog(spark, tmp + "/log", made.schema)
        run_stream(made, log, tmp + "/checkpoint").awaitTermination()
    return log.read(keys)


def history(n=300):
    rnd = random.Random(6)
    return [(i, rnd.choice([0, 0, 0, 1, None]), BASE + dt.timedelta(hours=rnd.choice([0, i, i, i])),
             rnd.choice(["complete"] * 5 + ["failed"]), rnd.choice([None, 0, 10, 10, 100, 900])) for i in range(n)]


def test_patches_out_of_order_and_replayed(spark, tmp):
    rnd = random.Random(2)
    patches = [(i % 20, i, BASE + dt.timedelta(minutes=i), rnd.choice([None, "running", "complete", "failed"]),
                rnd.choice([None, i]), rnd.choice([None, "x" * 3000]), rnd.choice([None, 1, 2, 3])) for i in range(200)]
    mixed = rnd.sample(patches, 200)
    got = stream(spark, tmp, [mixed[:90], mixed[80:150], mixed[150:], mixed[:50]], PATCH, fold_patches, ["run_id"])
    want = R.run_state(spark.createDataFrame(patches, PATCH))
    assert rows(got, *want.columns) == rows(want)


@pytest.mark.parametrize("days", [None, 30])
def test_history_out_of_order_replayed_and_corrected(spark, tmp, days):
    all_runs = history()
    rnd = random.Random(3)
    mixed = rnd.sample(all_runs, len(all_runs))
    fixed = [(*r[:4], 77) for r in mixed[:20]]  # counts corrected afterwards
    got = stream(spark, tmp, [mixed[:120], mixed[100:], mixed[:60], fixed], RUN,
                 lambda s: trailing_history(s, days), ["run_id"])
    runs = spark.createDataFrame(fixed + mixed[20:], RUN)
    assert got.where("late").isEmpty()
    want = R.volume_anomaly(runs)
    assert rows(volume_from(got, runs)) == rows(want) and not want.where("volume_anomaly_flag").isEmpty()


def test_runs_too_late_are_marked_and_repaired(spark, tmp):
    all_runs = sorted(history(), key=lambda r: r[2])
    late = [r for r in all_runs[40:60] if r[1] in (0, None)]
    on_time = [r for r in all_runs if r not in late]
    half = len(on_time) // 2
    got = stream(spark, tmp, [on_time[:half], on_time[half:], late, on_time[half:]], RUN,
                 lambda s: trailing_history(s, 0.5), ["run_id"])
    marked = {r["pipeline_id"] for r in got.where("late").collect()}
    assert {None, 0} <= marked
    runs = spark.createDataFrame(all_runs, RUN)
    assert rows(volume_from(got, runs)) == rows(R.volume_anomaly(runs))


def test_state_holds_no_more_than_the_late_runs_need(spark):
    from tidemark.streaming.run_stream import DAY_US, _update
    import pandas as pd

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    state, update = State(), _update(7, 10)
    for first in range(0, 500, 25):
        pdf = pd.DataFrame({"run_id": range(first, first + 25), "started_us": range(first, first + 25),
                            "n": [1] * 25, "known": [True] * 25})
        out = pd.concat(list(update((1,), iter([pdf]), state)))
        assert len(out) == 25 and not out["late"].any()
        assert len(state.get[1]) == 11 + 7
    assert DAY_US == 24 * 3600 * 10**6


def test_nothing_arrives(spark, tmp):
    none = spark.createDataFrame([], RUN)
    got = stream(spark, tmp, [[(1, 0, BASE, "failed", 3)]], RUN, trailing_history, ["run_id"])
    assert got.collect() == [] and volume_from(got, none).collect() == []
    assert got.where(F.col("late")).isEmpty()
