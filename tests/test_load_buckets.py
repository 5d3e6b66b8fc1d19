"""Loads and streams into targets in folders by key hash."""
import dataclasses
import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import runs as R
from tidemark.plans.buckets import BUCKET, BucketedTarget
from tidemark.plans.load import LoadSpec, run_load
from tidemark.sources.readers import ParquetSource, target_columns
from tidemark.streaming import stream_upsert

T0 = dt.datetime(2024, 1, 1)
COLS = "id long, name string, updated_at timestamp_ntz"


def put(spark, tmp, rows, cols=COLS):
    spark.createDataFrame(rows, cols).write.mode("overwrite").parquet(tmp + "/src/t.parquet")


@pytest.fixture()
def spec(tmp):
    return LoadSpec(pipeline_id=1, source=ParquetSource(tmp + "/src"), source_table="t", mode="full",
                    target_path=tmp + "/target", target_table="t_" + uuid.uuid4().hex, buckets=4)


def target(spark, spec):
    return BucketedTarget(spark, spec.target_table, "ID", spec.buckets)


def rows(spark, spec):
    return sorted(map(tuple, target(spark, spec).read().collect()), key=repr)


def load(spark, tmp, spec, run_id, **kw):
    return run_load(spark, spec, T0, run_id=run_id, run_log=tmp + "/runs", drift_log_path=tmp + "/drift", **kw)


def test_loads_replays_and_rows_without_a_key(spark, tmp, spec):
    put(spark, tmp, [(1, "a", T0), (2, "b", T0), (None, "n", T0)])
    first = load(spark, tmp, spec, 1)
    assert (first.status, first.rows_loaded) == ("complete", 3)
    once = rows(spark, spec)
    assert len(once) == 3
    load(spark, tmp, spec, 1)  # a replay, row without a key included
    assert rows(spark, spec) == once
    put(spark, tmp, [(2, "B", T0), (2, "C", T0), (3, "c", T0), (None, "m", T0)])
    for _ in range(2):
        load(spark, tmp, spec, 2)
    assert rows(spark, spec) == sorted([(1, "a", T0), (2, "B", T0), (2, "C", T0), (3, "c", T0), (None, "n", T0),
                                        (None, "m", T0)], key=repr)
    # another pipeline numbers its runs alone
    put(spark, tmp, [(9, "x", T0)])
    load(spark, tmp, dataclasses.replace(spec, pipeline_id=2), 2)
    assert len(rows(spark, spec)) == 7
    put(spark, tmp, [])
    assert load(spark, tmp, spec, 3).rows_loaded == 0 and len(rows(spark, spec)) == 7
    state = {r["run_id"]: r["status"] for r in R.run_state(spark.read.parquet(tmp + "/runs")).collect()}
    assert state == {1: "complete", 2: "complete", 3: "complete"}
    assert [r["column_name"] for r in target_columns(spark, "t", catalog_table=spec.target_table).collect()] == [
        "ID", "NAME", "UPDATED_AT"]


def test_last_wins(spark, tmp, spec):
    spec = dataclasses.replace(spec, upsert="last_wins")
    put(spark, tmp, [(1, "old", T0), (1, "new", T0 + dt.timedelta(days=1)), (2, "b", T0)])
    load(spark, tmp, spec, 1)
    assert [r[:2] for r in rows(spark, spec)] == [(1, "new"), (2, "b")]


def test_columns_are_added_and_lossy_types_refused(spark, tmp, spec):
    put(spark, tmp, [(1, 5, T0)], "id long, n int, updated_at timestamp_ntz")
    load(spark, tmp, spec, 1)
    put(spark, tmp, [(2, 6, T0, "x")], "id long, n int, updated_at timestamp_ntz, extra string")
    got = load(spark, tmp, spec, 2)
    assert got.n_added == 1
    assert rows(spark, spec) == [(1, 5, T0, None), (2, 6, T0, "x")]
    put(spark, tmp, [(2, 7.5, T0)], "id long, n double, updated_at timestamp_ntz")
    with pytest.raises(ValueError, match="types differ"):
        load(spark, tmp, spec, 3)
    assert rows(spark, spec) == [(1, 5, T0, None), (2, 6, T0, "x")]
    logged = spark.read.parquet(tmp + "/drift").where("change_type = 'type_changed'")
    assert [r["column_name"] for r in logged.collect()] == ["N"]
    states = R.run_state(spark.read.parquet(tmp + "/runs")).where("status = 'failed'")
    assert [r["run_id"] for r in states.collect()] == [3]


def test_a_load_that_created_its_tables_only_is_run_again(spark, tmp, spec):
    put(spark, tmp, [(1, "a", T0)])
    empty = spark.createDataFrame([], "ID long, NAME string, UPDATED_AT timestamp_ntz")
    made = BucketedTarget.create(empty, spec.target_table, "ID", spec.buckets, spec.target_path)
    spark.sql(f"DROP TABLE {made.runs}")
    assert not made.exists()
    load(spark, tmp, dataclasses.replace(spec, target_path=spec.target_path + "2"), 1)
    assert rows(spark, spec) == [(1, "a", T0)]


@pytest.mark.parametrize("wrong", [{"target_table": None}, {"upsert": "append"}, {"merge_key": None}, {"buckets": 0}])
def test_specs_that_make_no_sense(spec, wrong):
    with pytest.raises(ValueError, match="buckets need"):
        dataclasses.replace(spec, **wrong)


def test_a_source_without_the_key_is_refused(spark, tmp, spec):
    put(spark, tmp, [("a", T0)], "name string, updated_at timestamp_ntz")
    with pytest.raises(ValueError, match="no column id"):
        load(spark, tmp, spec, 1)


def test_stream_into_buckets(spark, tmp):
    cols = "id long, name string, seq long"
    schema = spark.createDataFrame([], cols).schema
    into = BucketedTarget.create(spark.createDataFrame([], cols), "s_" + uuid.uuid4().hex, "id", 4, tmp + "/t")
    for batch in ([(1, "a", 1), (2, "b", 1), (1, "a2", 2)], [(2, "b2", 3), (3, "c", 3), (None, "n", 1)], []):
        if batch:
            spark.createDataFrame(batch, cols).write.mode("append").parquet(tmp + "/in")
        stream_upsert(spark, tmp + "/in", schema, into, "id", ["seq"], tmp + "/ckpt").awaitTermination()
    got = sorted(map(repr, (tuple(r) for r in into.read().select("id", "name").collect())))
    assert got == sorted(map(repr, [(1, "a2"), (2, "b2"), (3, "c"), (None, "n")]))
    applied = [r[0] for r in spark.table(into.runs).select("_run").collect()]
    assert sum(a.startswith("stream:") for a in applied) == 2
    assert spark.table(into.name).where(F.col(BUCKET).isNull()).isEmpty()
