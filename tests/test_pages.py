"""Pages by an index against ``offset`` over the whole history."""
import datetime as dt
import random

import pytest

from tidemark.operators import runs as R
from tidemark.plans.pages import RunPages

SCHEMA = "run_id long, pipeline_id long, started_at timestamp_ntz, status string, rows_loaded long"
BASE = dt.datetime(2024, 1, 1)


def history(n=600):
    rnd = random.Random(4)
    # a third starts at one moment; some have no start, no pipeline, no status
    return [(i, rnd.choice([0, 0, 0, 1, 2, None]),
             BASE if i % 3 == 0 else None if i % 41 == 0 else BASE + dt.timedelta(minutes=rnd.randrange(5000)),
             rnd.choice(["complete", "failed", "running", None]), i) for i in range(n)]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    runs = spark.createDataFrame(history(), SCHEMA).repartition(7)
    pages = RunPages(spark, str(tmp_path_factory.mktemp("pages") / "p"))
    pages.build(runs, partitions=6)
    return runs, pages


@pytest.mark.parametrize("pipeline, status", [(None, None), (0, None), (None, "failed"), (0, "complete"),
                                              (7, "lost")])
def test_any_page_equals_offset(made, pipeline, status):
    runs, pages = made
    n = pages.page_count(pipeline, status).first()[0]
    assert n == R.page_count(runs, pipeline_id=pipeline, status=status).first()[0]
    for k in sorted({0, n // 2, max(n - 1, 0), n}):
        got = pages.page(k, pipeline, status)
        assert got.columns == runs.columns
        assert got.collect() == R.run_page(runs, k, pipeline_id=pipeline, status=status).collect(), k


def test_every_run_is_on_one_page(made):
    runs, pages = made
    found = [r["run_id"] for k in range(0, 60) for r in pages.page(k).collect()]
    assert sorted(found) == list(range(600))


def test_a_page_far_back_reads_its_range(spark, made):
    _, pages = made
    last = pages.page_count().first()[0] - 1
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = pages.page(last)._jdf.queryExecution().explainString(formatted)
    pushed = plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
    assert "GreaterThanOrEqual(_at," in pushed and "LessThanOrEqual(_at," in pushed
    assert "TakeOrdered" not in plan and "Offset" not in plan


def test_repeated_rows_and_no_rows(spark, tmp):
    same = spark.createDataFrame([(1, 0, BASE, "failed", 5)] * 25, SCHEMA)
    pages = RunPages(spark, tmp + "/same")
    pages.build(same)
    assert [pages.page(k, status="failed").count() for k in range(4)] == [10, 10, 5, 0]
    none = RunPages(spark, tmp + "/none")
    none.build(same.limit(0))
    assert none.page(0).collect() == [] and none.page_count().first()[0] == 0
    none.build(same)  # built anew
    assert none.page_count().first()[0] == 3
