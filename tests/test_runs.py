import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import runs as R
from tidemark.sources.readers import ParquetSource, read_incremental

RUN_SCHEMA = "run_id long, pipeline_id long, status string, started_at timestamp_ntz, " \
             "ended_at timestamp_ntz, rows_loaded long"
T0 = dt.datetime(2024, 1, 1)


def mk_runs(spark, rows_by_pipeline, statuses=None):
    data, rid = [], 0
    for p, counts in rows_by_pipeline.items():
        for i, n in enumerate(counts):
            st = (statuses or {}).get((p, i), "complete")
            s = T0 + dt.timedelta(hours=i)
            data.append((rid, p, st, s, s + dt.timedelta(minutes=5), n))
            rid += 1
    return spark.createDataFrame(data, RUN_SCHEMA)


def flags(df):
    return [r["volume_anomaly_flag"] for r in df.orderBy("pipeline_id", "started_at").collect()]


def test_volume_band_edges(spark):
    # mean of history = 100: 50% and 200% exactly are not flagged
    runs = mk_runs(spark, {1: [100, 100, 50], 2: [100, 200], 3: [100, 49], 4: [100, 201]})
    va = R.volume_anomaly(runs)
    by = {(r["pipeline_id"], r["rows_loaded"]): r["volume_anomaly_flag"] for r in va.collect()}
    assert by[(1, 50)] is False and by[(2, 200)] is False
    assert by[(3, 49)] is True and by[(4, 201)] is True
    # first run has no history
    assert all(not by[(p, 100)] for p in (2, 3, 4))


def test_volume_mean_zero_nulls_and_failed_between(spark):
    runs = mk_runs(spark, {1: [0, 0, 500], 2: [None, 100, 100, 1000], 3: [100, 5, 100]},
                   statuses={(3, 1): "failed"})
    va = {(r["pipeline_id"], r["run_id"]): r for r in R.volume_anomaly(runs).collect()}
    p1 = [r for (p, _), r in va.items() if p == 1]
    assert not any(r["volume_anomaly_flag"] for r in p1)  # mean 0 never flags
    p2_last = max((r for (p, _), r in va.items() if p == 2), key=lambda r: r["started_at"])
    # null counts as 0: mean (0+100+100)/3 = 66.7 -> 1000 is 1500%
    assert abs(p2_last["avg_prev"] - 200 / 3) < 1e-9 and p2_last["volume_anomaly_flag"]
    p3 = sorted((r for (p, _), r in va.items() if p == 3), key=lambda r: r["started_at"])
    assert len(p3) == 2 and p3[1]["history_runs"] == 1  # failed run skipped


def test_volume_history_window_is_seven(spark):
    counts = [10, 10, 10, 10, 10, 10, 10, 1000, 10, 10, 10, 10, 10, 10, 10, 10]
    runs = mk_runs(spark, {1: counts})
    va = R.volume_anomaly(runs).orderBy("started_at").collect()
    assert [r["history_runs"] for r in va[:9]] == [0, 1, 2, 3, 4, 5, 6, 7, 7]
    assert va[15]["avg_prev"] == 10.0  # the 1000 has left the window


def test_blocks_equal_plain_window(spark):
    import random
    from pyspark.sql import Window
    rnd = random.Random(7)
    counts = {p: [rnd.choice([None, 0, 5, 50, 100, 400]) for _ in range(n)]
              for p, n in {1: 300, 2: 40, 3: 3}.items()}
    runs = mk_runs(spark, counts, statuses={(1, 17): "failed", (2, 5): "running"})
    runs = runs.withColumn("pipeline_id", F.when(F.col("pipeline_id") != 2, F.col("pipeline_id")))  # null group
    got = R.volume_anomaly(runs, block_rows=10)
    w = Window.partitionBy("pipeline_id").orderBy("started_at", "run_id").rowsBetween(-7, -1)
    want = (runs.where("status = 'complete'")
            .select("run_id", F.count(F.lit(1)).over(w).alias("history_runs"),
                    F.avg(F.coalesce("rows_loaded", F.lit(0))).over(w).alias("avg_prev")))
    assert (sorted(map(tuple, got.select("run_id", "history_runs", "avg_prev").collect()))
            == sorted(map(tuple, want.collect())))
    assert got.count() == sum(len(v) for v in counts.values()) - 2


def test_watermark_default_and_latest(spark):
    runs = mk_runs(spark, {1: [5, 6], 2: [7]}, statuses={(2, 0): "failed"})
    pipes = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    as_of = dt.datetime(2024, 2, 1)
    wm = {r["pipeline_id"]: r for r in R.resolve_watermark(runs, pipes, as_of).collect()}
    assert wm[1]["watermark"] == T0 + dt.timedelta(hours=1, minutes=5)
    assert wm[2]["watermark"] == as_of - dt.timedelta(days=30) and wm[2]["is_default"]
    assert wm[3]["is_default"]


def test_incremental_includes_mark_and_missing_column_full_scan(spark):
    df = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(seconds=1)),
                                (3, T0 - dt.timedelta(seconds=1))], "id long, updated_at timestamp_ntz")
    src = ParquetSource("/nonexistent")
    got = sorted(r.id for r in read_incremental(spark, src, "t", "updated_at", T0, df=df).collect())
    assert got == [1, 2]
    assert read_incremental(spark, src, "t", "modified_at", T0, df=df).count() == 3


def test_run_state_fold(spark):
    schema = ("run_id long, seq long, patched_at timestamp_ntz, status string, rows_loaded long, "
              "error_message string, phase_completed int")
    at = lambda s: T0 + dt.timedelta(seconds=s)
    patches = spark.createDataFrame([
        (1, 3, at(3), "complete", 10, None, 3),     # arrives first, applies last
        (1, 1, at(1), "running", None, None, 0),
        (1, 2, at(2), None, None, None, 2),         # partial patch
        (2, 1, at(1), "failed", None, "x" * 2001, None),
        (2, 2, at(5), None, 4, None, None),
    ], schema)
    st = {r["run_id"]: r for r in R.run_state(patches).collect()}
    assert st[1]["status"] == "complete" and st[1]["rows_loaded"] == 10
    assert st[1]["phase_completed"] == 3 and st[1]["ended_at"] == at(3)
    assert st[1]["started_at"] == at(1) and st[1]["n_patches"] == 3
    assert len(st[2]["error_message"]) == 2000 and st[2]["ended_at"] == at(1)
    assert st[2]["rows_loaded"] == 4 and st[2]["status"] == "failed"


def test_latest_recent_page_feed(spark):
    runs = mk_runs(spark, {1: list(range(40)), 2: [1, 2]}, statuses={(1, 39): "failed"})
    flagged = R.with_anomaly_flags(runs)
    latest = {r["pipeline_id"]: r for r in R.latest_runs(runs).collect()}
    assert latest[1]["total_runs"] == 40 and latest[1]["last_status"] == "failed"
    rec = R.recent_runs(runs, 30)
    assert rec.where("pipeline_id = 1").count() == 30 and rec.where("pipeline_id = 2").count() == 2
    page = R.run_page(runs, 1, 10, pipeline_id=1).collect()
    assert [r["rows_loaded"] for r in page] == list(range(29, 19, -1))
    assert R.page_count(runs, 10).first()["total_pages"] == 5
    feed = R.anomaly_feed(flagged).collect()
    assert feed[0]["status"] == "failed" and len(feed) <= 6


def test_durations(spark):
    runs = spark.createDataFrame([
        (1, 1, "complete", T0, T0 + dt.timedelta(seconds=61, milliseconds=600), 1),
        (2, 1, "running", T0, None, None),
        (3, 1, "failed", T0, T0, None)], RUN_SCHEMA)
    d = {r["run_id"]: r for r in R.run_durations(runs).collect()}
    assert d[1]["duration_s"] == 62 and d[1]["duration_label"] == "62s"
    assert d[2]["duration_s"] is None and d[2]["duration_label"] == "running…"
    assert d[3]["duration_s"] is None and d[3]["duration_label"] == "—"


def test_platform_stats_counts(spark):
    as_of = T0 + dt.timedelta(days=2)
    runs = spark.createDataFrame([
        (1, 1, "failed", as_of - dt.timedelta(hours=1), None, None),
        (2, 1, "complete", as_of - dt.timedelta(hours=30), None, 5)], RUN_SCHEMA
    ).withColumn("volume_anomaly_flag", F.lit(True))
    pipes = spark.createDataFrame([(1, True), (2, False)], "id long, is_active boolean")
    conns = spark.createDataFrame([(1, True)], "id long, is_active boolean")
    drift = spark.createDataFrame([("pending_review",), ("resolved",)], "status string")
    r = R.platform_stats(pipes, conns, runs, drift, as_of).first().asDict()
    assert r == {"total_pipelines": 1, "total_connections": 1, "runs_today": 1,
                 "failed_today": 1, "anomalies_7d": 2, "drift_pending": 1}


def test_dedup_is_reduced_before_the_shuffle(spark):
    from tidemark.operators.upsert import dedup_last_wins
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS seq")
    plan = dedup_last_wins(df, "k", ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # one row per key and map task is shuffled


def test_seeded_demo_runs_flag_only_the_zero_row_run(spark):
    # the reference's seeded run history: pipeline 2's fourth run failed
    seeded = {1: [980, 1020, 995, 1050, 1010, 0, 1025],
              2: [4980, 5120, 4950, 0, 5010, 5200, 4890],
              3: [450, 460, 445, 470, 455, 462, 448]}
    runs = mk_runs(spark, seeded, statuses={(2, 3): "failed"})
    flagged = [(r["pipeline_id"], r["rows_loaded"]) for r in R.volume_anomaly(runs).collect()
               if r["volume_anomaly_flag"]]
    assert flagged == [(1, 0)]
    wm = {r["pipeline_id"]: r["watermark"] for r in R.resolve_watermark(runs, as_of=T0).collect()}
    assert wm[2] == T0 + dt.timedelta(hours=6, minutes=5)  # last complete run, not the failed one


def test_incremental_read_prunes_partitions(spark, tmp):
    import os
    from tidemark.sources.readers import ParquetSource, read_incremental
    root = os.path.join(tmp, "src")
    df = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 5)) for i in range(50)],
                               "id long, load_date date")
    df.write.partitionBy("load_date").parquet(os.path.join(root, "events.parquet"))
    src = ParquetSource(root)
    inc = read_incremental(spark, src, "events", "load_date", F.lit(dt.date(2024, 1, 4)))
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan and "2024-01-04" in plan
    assert inc.count() == 20


def test_fixture_timestamps_do_not_overflow_for_large_keys(spark):
    from tidemark.plans import views as V
    cust = spark.createDataFrame([(40_000_000, "c", 1, 0.0, "AUTO")],
                                 "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    r = V.pipelines(cust).first()
    assert r["created_at"] == dt.datetime(2023, 1, 1) + dt.timedelta(seconds=40_000_000 * 60)
    assert V.schedules(cust).first()["created_at"].year > 2023


def test_target_columns_and_parquet_bounds(spark, tmp):
    import os
    from tidemark.plans.tables import VersionedTable
    from tidemark.sources.readers import ParquetSource, key_bounds, target_columns
    assert target_columns(spark, "t", path=os.path.join(tmp, "none")).count() == 0   # missing
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    vt.write(spark.createDataFrame([(1, "a")], "id long, name string"), 0)
    cols = [(r["column_name"], r["data_type"]) for r in
            target_columns(spark, "t", path=vt.root).orderBy("ordinal_position").collect()]
    assert cols == [("ID", "BIGINT"), ("NAME", "TEXT")]
    assert target_columns(spark, "t", catalog_table="no_such_table_here").count() == 0
    spark.createDataFrame([(5,), (2,), (None,)], "k long").write.parquet(os.path.join(tmp, "src", "k.parquet"))
    assert key_bounds(spark, ParquetSource(os.path.join(tmp, "src")), "k", "k") == (2, 5)


def test_filter_operators(spark):
    from tidemark.operators import schema as S
    runs = mk_runs(spark, {1: [1, 2, 3], 2: [4]}, statuses={(1, 1): "failed"})
    assert R.filter_runs(runs).count() == 4                                   # F6: none given
    assert R.filter_runs(runs, pipeline_id=1).count() == 3
    assert R.filter_runs(runs, pipeline_id=1, status="failed").count() == 1
    assert R.with_status(runs, "complete", "failed").count() == 4             # F4
    assert R.trailing(runs, "started_at", T0 + dt.timedelta(hours=2), hours=1).count() == 2  # F3
    log = spark.createDataFrame(
        [(1, 10, T0, "pending_review"), (2, 10, T0 + dt.timedelta(hours=1), "resolved"),
         (3, 11, T0, "pending_review")],
        "id long, pipeline_id long, detected_at timestamp_ntz, status string")
    assert [r["id"] for r in S.drift_log(log, pipeline_id=10).collect()] == [2, 1]   # F5, newest first
    assert [r["id"] for r in S.drift_log(log, status="pending_review").collect()] == [3, 1]


def test_a_hot_day_is_split_with_the_same_flags(spark):
    import datetime as dt
    import random
    from tidemark.operators import runs as R
    rnd = random.Random(8)
    at = dt.datetime(2024, 1, 5)
    rows = [(i, rnd.choice([0, 0, 0, 1, None]), "complete" if rnd.random() < 0.8 else "failed",
             at if i % 3 else at + dt.timedelta(hours=rnd.randrange(200)),
             rnd.choice([None, 0, 10, 100, 1000])) for i in range(3000)]
    runs = spark.createDataFrame(rows, "run_id long, pipeline_id long, status string, started_at timestamp_ntz, "
                                       "rows_loaded long").repartition(5)
    plain, split = (sorted(map(repr, R.volume_anomaly(runs, block_rows=50, split_days=s).collect()))
                    for s in (False, True))
    assert plain == split and any("volume_anomaly_flag=True" in r for r in split)
