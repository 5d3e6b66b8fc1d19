import datetime as dt
import os

from pyspark.sql import functions as F

from tidemark.operators.runs import run_state
from tidemark.plans.load import LoadSpec, run_load
from tidemark.plans.tables import VersionedTable
from tidemark.sources.readers import ParquetSource

T0 = dt.datetime(2024, 1, 1)
RUN_SCHEMA = ("run_id long, pipeline_id long, status string, started_at timestamp_ntz, "
              "ended_at timestamp_ntz, rows_loaded long")


def write_source(spark, root, rows, schema="id long, name string, updated_at timestamp_ntz"):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(os.path.join(root, "items.parquet"))


def test_versioned_table_commit_semantics(spark, tmp):
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    assert not vt.exists()
    vt.write(spark.createDataFrame([(1,)], "a int"), 0)
    # an uncommitted folder (a crashed write) is never read
    spark.createDataFrame([(9,)], "a int").write.parquet(vt.version_path(5))
    assert vt.latest_version() == 0 and [r.a for r in vt.read().collect()] == [1]
    vt.write(spark.createDataFrame([(2,)], "a int"), 1)
    assert [r.a for r in vt.read().collect()] == [2] and vt.committed(1)


def test_run_load_end_to_end(spark, tmp):
    src_root = os.path.join(tmp, "src")
    target = os.path.join(tmp, "target")
    log = os.path.join(tmp, "runs_log")
    drift_path = os.path.join(tmp, "drift")
    write_source(spark, src_root, [(1, "a", T0), (2, "b", T0), (3, "c", T0 - dt.timedelta(days=60))])
    spec = LoadSpec(pipeline_id=7, source=ParquetSource(src_root), source_table="items",
                    target_path=target)
    as_of = T0 + dt.timedelta(days=1)
    # no history: mark = as_of - 30 days, the old row is not extracted
    r1 = run_load(spark, spec, as_of, run_id=1, runs=None, run_log=log)
    assert r1.status == "complete" and r1.rows_loaded == 2 and not r1.volume_anomaly
    got = VersionedTable(spark, target).read()
    assert got.columns == ["ID", "NAME", "UPDATED_AT"] and got.count() == 2

    # second load: a new column appears, key 2 changes, key 4 arrives
    t1 = T0 + dt.timedelta(hours=5)
    write_source(spark, src_root, [(1, "a", T0, None), (2, "b2", t1, "x"), (4, "d", t1, "y")],
                 "id long, name string, updated_at timestamp_ntz, extra string")
    runs = spark.createDataFrame([(1, 7, "complete", T0, T0 + dt.timedelta(hours=1), 2)], RUN_SCHEMA)
    r2 = run_load(spark, spec, as_of, run_id=2, runs=runs, run_log=log, drift_log_path=drift_path)
    assert r2.rows_loaded == 2 and r2.watermark == T0 + dt.timedelta(hours=1)
    assert [(d["column_name"], d["change_type"], d["status"]) for d in r2.drift] == [
        ("EXTRA", "column_added", "auto_resolved")]
    out = {r["ID"]: r for r in VersionedTable(spark, target).read().collect()}
    assert sorted(out) == [1, 2, 4] and out[2]["NAME"] == "b2" and out[1]["EXTRA"] is None
    assert out[4]["EXTRA"] == "y"
    assert spark.read.parquet(drift_path).count() == 1

    # empty batch: no new version, run still complete with 0 rows
    runs2 = runs.union(spark.createDataFrame([(2, 7, "complete", T0, t1 + dt.timedelta(days=1), 2)],
                                             RUN_SCHEMA))
    v_before = VersionedTable(spark, target).latest_version()
    r3 = run_load(spark, spec, as_of, run_id=3, runs=runs2, run_log=log)
    assert r3.rows_loaded == 0 and r3.version is None and r3.volume_anomaly  # 0 of mean 2
    assert VersionedTable(spark, target).latest_version() == v_before

    st = {r["run_id"]: r for r in run_state(spark.read.parquet(log)).collect()}
    assert [st[i]["status"] for i in (1, 2, 3)] == ["complete"] * 3
    assert st[3]["volume_anomaly_flag"] is True and st[2]["rows_loaded"] == 2


def test_run_load_last_wins_and_failure(spark, tmp):
    src_root = os.path.join(tmp, "src")
    write_source(spark, src_root, [(1, "a", T0), (1, "b", T0 + dt.timedelta(hours=1))])
    spec = LoadSpec(pipeline_id=1, source=ParquetSource(src_root), source_table="items",
                    target_path=os.path.join(tmp, "t"), upsert="last_wins",
                    order_cols=("updated_at",))
    run_load(spark, spec, T0 + dt.timedelta(days=1), run_id=1)
    assert [r["NAME"] for r in VersionedTable(spark, spec.target_path).read().collect()] == ["b"]
    bad = LoadSpec(pipeline_id=1, source=ParquetSource(os.path.join(tmp, "missing")),
                   source_table="items", target_path=os.path.join(tmp, "t2"))
    log = os.path.join(tmp, "log")
    try:
        run_load(spark, bad, T0, run_id=5, run_log=log)
        raise AssertionError("expected failure")
    except Exception:
        pass
    st = run_state(spark.read.parquet(log)).first()
    assert st["status"] == "failed" and st["error_message"]


def test_max_seen_mark_and_pending_not_relogged(spark, tmp):
    from tidemark.operators.runs import run_state as fold
    src_root = os.path.join(tmp, "src")
    log = os.path.join(tmp, "log")
    drift_path = os.path.join(tmp, "drift")
    write_source(spark, src_root, [(1, "a", T0), (2, "b", T0 + dt.timedelta(hours=2))])
    spec = LoadSpec(pipeline_id=3, source=ParquetSource(src_root), source_table="items",
                    target_path=os.path.join(tmp, "t"), mark="max_seen")
    as_of = T0 + dt.timedelta(days=1)
    r1 = run_load(spark, spec, as_of, run_id=1, run_log=log)
    assert r1.max_seen.startswith("2024-01-01 02:00")
    # source drops NAME and gains nothing; a row at the mark and one before it
    spark.createDataFrame([(2, T0 + dt.timedelta(hours=2)), (5, T0 + dt.timedelta(hours=1))],
                          "id long, updated_at timestamp_ntz") \
        .write.mode("overwrite").parquet(os.path.join(src_root, "items.parquet"))
    runs = fold(spark.read.parquet(log)).withColumn("pipeline_id", F.lit(3).cast("bigint"))
    r2 = run_load(spark, spec, as_of, run_id=2, runs=runs, run_log=log, drift_log_path=drift_path)
    assert r2.rows_loaded == 1  # only the row at the max seen value
    assert r2.n_pending == 1 and r2.drift[0]["change_type"] == "column_dropped"
    r3 = run_load(spark, spec, as_of, run_id=3, runs=runs, run_log=log, drift_log_path=drift_path)
    assert r3.n_pending == 1
    assert spark.read.parquet(drift_path).count() == 1  # still pending: logged once


def test_resolve_drift_and_schema_cache(spark, tmp):
    from tidemark.operators.schema import drift_state
    from tidemark.plans.load import resolve_drift
    from tidemark.plans.schema_cache import SchemaCache, cached_schema
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    vt.write(spark.createDataFrame([("1",), ("x",)], "AMOUNT string"), 0)
    log = spark.createDataFrame(
        [(1, 1, T0, "AMOUNT", "type_changed", "TEXT", "INTEGER", "pending_review"),
         (2, 1, T0, "B", "column_dropped", "TEXT", None, "pending_review")],
        "id long, pipeline_id long, detected_at timestamp_ntz, column_name string, "
        "change_type string, old_definition string, new_definition string, status string")
    res_path = os.path.join(tmp, "res")
    import pytest
    for where in (None, vt.root):  # nothing to change, or a value would be lost: refused, nothing recorded
        with pytest.raises(ValueError):
            resolve_drift(spark, log, 1, "apply_type_change", 9, T0, where, res_path)
    assert not os.path.exists(res_path)
    resolve_drift(spark, log, 1, "apply_type_change", 9, T0, vt.root, res_path, on_cast_error="null")
    assert [r[0] for r in vt.read().collect()] == [1, None]
    try:
        resolve_drift(spark, log, 2, "apply_type_change", 9, T0)
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
    resolve_drift(spark, log, 2, "dismiss", 9, T0, resolutions_path=res_path)
    st = drift_state(log, spark.read.parquet(res_path))
    assert {r["status"] for r in st.collect()} == {"resolved"}

    cache = SchemaCache(spark, os.path.join(tmp, "cache"))
    calls = []

    def discover(rows):
        def f():
            calls.append(1)
            return spark.createDataFrame(rows, "table_name string, column_name string, "
                                               "ordinal_position int, data_type string")
        return f
    a = cached_schema(cache, 1, discover([("t", "updated_at", 1, "timestamp without time zone")]))
    b = cached_schema(cache, 2, discover([("u", "id", 1, "integer")]))
    assert a.count() == 1 and b.count() == 1 and len(calls) == 2
    assert cached_schema(cache, 1, discover([])).first()["is_suggested_watermark"] is True
    assert len(calls) == 2  # served from the cache
    cached_schema(cache, 1, discover([("t", "x", 1, "text"), ("t", "y", 2, "text")]), refresh=True)
    assert cache.read(1).count() == 2 and cache.read(2).count() == 1  # other connection kept


def test_cast_issues_reported_in_the_same_pass(spark, tmp):
    src_root = os.path.join(tmp, "src")
    spark.createDataFrame([(1, 1e20, "x" * 501), (2, 1.5, "ok")], "id long, amount double, name string") \
        .write.parquet(os.path.join(src_root, "items.parquet"))
    defs = (("id", "bigint"), ("amount", "numeric"), ("name", "character varying"))
    spec = LoadSpec(pipeline_id=1, source=ParquetSource(src_root), source_table="items",
                    target_path=os.path.join(tmp, "t"), mode="full", col_defs=defs, on_cast_error="null")
    log = os.path.join(tmp, "log")
    r = run_load(spark, spec, T0, run_id=1, run_log=log)
    assert '"amount"' in run_state(spark.read.parquet(log)).first()["cast_issues"]
    assert r.cast_issues == {"amount": {"n_failed": 1, "n_too_long": 0},
                             "name": {"n_failed": 0, "n_too_long": 1}}
    import dataclasses
    strict = dataclasses.replace(spec, target_path=os.path.join(tmp, "t2"), on_cast_error="fail")
    try:
        run_load(spark, strict, T0, run_id=2)
        raise AssertionError("expected failure")
    except ValueError:
        pass
    assert not VersionedTable(spark, strict.target_path).exists()


def test_retried_run_id_supersedes_failed_attempt(spark, tmp):
    from tidemark.operators.runs import run_state
    src_root = os.path.join(tmp, "src")
    log = os.path.join(tmp, "log")
    spec = LoadSpec(pipeline_id=1, source=ParquetSource(src_root), source_table="items",
                    target_path=os.path.join(tmp, "t"), mode="full")
    try:  # first attempt: the source is not there yet
        run_load(spark, spec, T0, run_id=7, run_log=log)
    except Exception:
        pass
    write_source(spark, src_root, [(1, "a", T0)])
    run_load(spark, spec, T0, run_id=7, run_log=log)
    st = run_state(spark.read.parquet(log)).first()
    assert st["status"] == "complete" and st["rows_loaded"] == 1


def test_load_spec_validation():
    import pytest
    src = ParquetSource("/x")
    with pytest.raises(ValueError):
        LoadSpec(pipeline_id=1, source=src, source_table="t", target_path="/t", upsert="merge")
    with pytest.raises(ValueError):
        LoadSpec(pipeline_id=1, source=src, source_table="t")
    LoadSpec(pipeline_id=1, source=src, source_table="t", target_path="/t", mode="full")


def test_small_api_pieces(spark, tmp):
    from tidemark.operators.runs import recent_for_pipeline
    from tidemark.plans.load import project_columns, upper_columns
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    vt.ensure(spark.createDataFrame([], "ID long, NAME string").schema)      # K1
    assert vt.exists() and vt.read().count() == 0 and vt.read().columns == ["ID", "NAME"]
    vt.ensure(spark.createDataFrame([], "X int").schema)                      # no-op once there
    assert vt.read().columns == ["ID", "NAME"]
    df = spark.createDataFrame([(1, "a", 2.0)], "id long, name string, x double")
    assert upper_columns(project_columns(df, ["name", "id"])).columns == ["NAME", "ID"]   # P1 P2
    runs = spark.createDataFrame(
        [(i, 1, "complete", T0 + dt.timedelta(hours=i), None, i) for i in range(40)] +
        [(99, 2, "complete", T0, None, 1)], RUN_SCHEMA)
    got = [r["run_id"] for r in recent_for_pipeline(runs, 1).collect()]            # L1
    assert got == list(range(39, 9, -1))


def load_twice(spark, tmp, first, first_schema, then, then_schema, **kw):
    src = os.path.join(tmp, "src")
    spec = LoadSpec(pipeline_id=1, source=ParquetSource(src), source_table="items",
                    target_path=os.path.join(tmp, "t"), mode="full", merge_key="id", **kw)
    write_source(spark, src, first, first_schema)
    run_load(spark, spec, T0, run_id=1)
    write_source(spark, src, then, then_schema)
    return run_load(spark, spec, T0, run_id=2), VersionedTable(spark, spec.target_path).read()


def test_type_drift_changes_no_value(spark, tmp):
    from decimal import Decimal
    r, t = load_twice(spark, os.path.join(tmp, "a"), [(1, 5)], "id int, x int",
                      [(2, Decimal("12.75"))], "id int, x decimal(10,2)")
    assert [(d["column_name"], d["change_type"], d["status"]) for d in r.drift] == [("X", "type_changed", "pending_review")]
    assert {q["ID"]: q["X"] for q in t.collect()} == {1: Decimal("5"), 2: Decimal("12.75")}
    _, t = load_twice(spark, os.path.join(tmp, "b"), [(1, 5)], "id int, x int", [(2, 9_000_000_000)], "id int, x bigint")
    assert {q["ID"]: q["X"] for q in t.collect()} == {1: 5, 2: 9_000_000_000}
    r, t = load_twice(spark, os.path.join(tmp, "c"), [(1, 5)], "id int, x bigint", [(2, "abc"), (3, "n/a")], "id int, x string")
    assert r.n_pending == 1 and {q["ID"]: q["X"] for q in t.collect()} == {1: "5", 2: "abc", 3: "n/a"}


def test_batch_is_written_once_and_replays_are_skipped(spark, tmp):
    src = os.path.join(tmp, "src")
    spec = LoadSpec(pipeline_id=1, source=ParquetSource(src), source_table="items",
                    target_path=os.path.join(tmp, "t"), mode="full", upsert="append", compact_max_layers=1)
    write_source(spark, src, [(1, "a", T0)])
    for run in (1, 2, 3, 4):
        run_load(spark, spec, T0, run_id=run)
    run_load(spark, spec, T0, run_id=2)  # replayed after several compactions
    assert VersionedTable(spark, spec.target_path).read().count() == 4


def test_drift_ids_do_not_meet(spark):
    from tidemark.plans.load import _drift_events
    rows = [{"table_name": "t", "column_name": f"C{i}", "change_type": "column_added", "old_definition": None,
             "new_definition": "TEXT", "status": "auto_resolved"} for i in range(10_050)]
    a = _drift_events(spark, rows, 1, 1, T0).union(_drift_events(spark, rows, 1, 2, T0))
    assert a.select("id").distinct().count() == 2 * len(rows)
