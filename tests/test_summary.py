"""The kept summary of runs against the full queries."""
import datetime as dt

import pytest

from tidemark.operators import runs as R
from tidemark.plans.summary import RunSummary, days_of, on_days

SCHEMA = ("run_id long, pipeline_id long, started_at timestamp_ntz, status string, rows_loaded long, "
          "volume_anomaly_flag boolean")
BASE = dt.datetime(2024, 1, 1, 6)


def run(i, hours, status="complete", rows=10, pipeline=None, flag=False):
    return (i, i % 3 if pipeline is None else pipeline, BASE + dt.timedelta(hours=hours), status, rows, flag)


FIRST = [run(i, 5 * i, ["complete", "failed", "running"][i % 3], None if i % 7 == 0 else i, flag=i % 11 == 0)
         for i in range(200)] + [(900, None, BASE, "complete", 4, None), (901, 1, None, "failed", 3, True)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def same(spark, summary, runs):
    assert rows(summary.totals()) == rows(R.run_status_totals(runs))
    assert rows(summary.totals(True)) == rows(R.run_status_totals(runs, True))
    for as_of in (dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 7, 13, 30)):
        for by in (True, False):
            assert rows(summary.history(runs, as_of, by_pipeline=by)) == rows(
                R.volume_history(runs, as_of, by_pipeline=by))


@pytest.fixture()
def made(spark, tmp):
    runs = spark.createDataFrame(FIRST, SCHEMA)
    summary = RunSummary(spark, tmp + "/summary")
    summary.refresh(runs)
    return runs, summary


def test_equals_the_full_queries(spark, made):
    same(spark, made[1], made[0])


def test_late_and_corrected_runs(spark, made):
    runs, summary = made
    # 17 moves to a day of its own, 40 fails afterwards, 901 gets a start, new ones arrive late
    new = [run(17, 9000), run(40, 200, "failed", 7), (901, 1, BASE, "failed", 3, True), run(1000, 3), run(1001, 9500)]
    ids = [r[0] for r in new]
    changed = spark.createDataFrame(new, SCHEMA)
    after = runs.where(~runs["run_id"].isin(ids)).union(changed)
    days = days_of(changed, runs.where(runs["run_id"].isin(ids)))
    assert None in days
    for _ in range(2):  # a repeat changes nothing
        summary.refresh(after, days)
        same(spark, summary, after)


def test_a_day_that_loses_its_runs(spark, made):
    runs, summary = made
    day = dt.date(2024, 1, 9)
    after = runs.where(f"to_date(started_at) <> date'{day}' or started_at is null")
    summary.refresh(after, [day])
    assert summary.read().where(f"run_date = date'{day}'").isEmpty()
    same(spark, summary, after)


def test_only_changed_days_are_written_and_read(spark, made, tmp):
    runs, summary = made
    before = set(summary.read().inputFiles())
    day = dt.date(2024, 1, 9)
    summary.refresh(runs, [day])
    assert {f for f in before ^ set(summary.read().inputFiles()) if f"run_date={day}" not in f} == set()
    runs.write.parquet(tmp + "/runs")
    one = on_days(spark.read.parquet(tmp + "/runs"), [day])
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = one._jdf.queryExecution().explainString(formatted)
    pushed = plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
    assert "GreaterThanOrEqual(started_at,2024-01-09T00:00)" in pushed
    assert "LessThan(started_at,2024-01-10T00:00)" in pushed


def test_no_runs(spark, tmp):
    none = spark.createDataFrame([], SCHEMA)
    summary = RunSummary(spark, tmp + "/s")
    summary.refresh(none)
    assert rows(summary.totals()) == [(0, 0, 0, 0, 0)]
    summary.refresh(none, [])
    summary.refresh(none, [dt.date(2024, 1, 1), None])
    assert rows(summary.totals()) == [(0, 0, 0, 0, 0)] and rows(summary.totals(True)) == []
