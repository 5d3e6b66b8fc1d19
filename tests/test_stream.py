import datetime as dt
import os

from tidemark.plans.tables import VersionedTable
from tidemark.streaming import stream_upsert

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, name string, seq long"


def test_stream_upsert_incremental_and_replay_safe(spark, tmp):
    src = os.path.join(tmp, "in")
    target = os.path.join(tmp, "target")
    ckpt = os.path.join(tmp, "ckpt")
    schema = spark.createDataFrame([], SCHEMA).schema
    spark.createDataFrame([(1, "a", 1), (2, "b", 1), (1, "a2", 2)], SCHEMA) \
        .write.mode("append").parquet(src)
    stream_upsert(spark, src, schema, target, "id", ["seq"], checkpoint_location=ckpt).awaitTermination()
    first = sorted((r.id, r.name) for r in VersionedTable(spark, target).read().collect())
    assert first == [(1, "a2"), (2, "b")]
    # new file: only it is read on the next scheduled run
    spark.createDataFrame([(2, "b2", 3), (3, "c", 3)], SCHEMA).write.mode("append").parquet(src)
    stream_upsert(spark, src, schema, target, "id", ["seq"], checkpoint_location=ckpt).awaitTermination()
    second = sorted((r.id, r.name) for r in VersionedTable(spark, target).read().collect())
    assert second == [(1, "a2"), (2, "b2"), (3, "c")]
    # nothing new: a rerun changes nothing
    v = VersionedTable(spark, target).latest_version()
    stream_upsert(spark, src, schema, target, "id", ["seq"], checkpoint_location=ckpt).awaitTermination()
    assert VersionedTable(spark, target).latest_version() == v


def test_many_micro_batches_with_compaction(spark, tmp):
    import random
    from tidemark.operators.upsert import dedup_last_wins
    src, target, ckpt = (os.path.join(tmp, x) for x in ("in", "target", "ckpt"))
    schema = spark.createDataFrame([], SCHEMA).schema
    rnd = random.Random(5)
    everything = []
    for f in range(12):
        rows = [(rnd.randrange(20), f"f{f}r{j}", f * 100 + j) for j in range(6)]
        everything += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    q = stream_upsert(spark, src, schema, target, "id", ["seq"], checkpoint_location=ckpt,
                      max_files_per_trigger=1, compact_max_layers=3, compact_ratio=10.0)
    q.awaitTermination()
    vt = VersionedTable(spark, target)
    got = sorted((r.id, r.name) for r in vt.read().collect())
    want = sorted((r.id, r.name) for r in
                  dedup_last_wins(spark.createDataFrame(everything, SCHEMA), "id", ["seq"]).collect())
    assert got == want
    assert len(vt._epochs()) >= 3  # compacted more than once along the way


def test_second_stream_and_new_checkpoint_lose_nothing(spark, tmp):
    src, other, target = (os.path.join(tmp, x) for x in ("in", "other", "target"))
    schema = spark.createDataFrame([], SCHEMA).schema
    spark.createDataFrame([(1, "a", 1)], SCHEMA).write.parquet(src)
    spark.createDataFrame([(2, "b", 1)], SCHEMA).write.parquet(other)
    for source, ckpt in ((src, "c1"), (other, "c2")):
        stream_upsert(spark, source, schema, target, "id", ["seq"],
                      checkpoint_location=os.path.join(tmp, ckpt)).awaitTermination()
    assert sorted(r.id for r in VersionedTable(spark, target).read().collect()) == [1, 2]
    spark.createDataFrame([(3, "c", 1)], SCHEMA).write.mode("append").parquet(src)
    stream_upsert(spark, src, schema, target, "id", ["seq"],
                  checkpoint_location=os.path.join(tmp, "c3")).awaitTermination()
    assert sorted(r.id for r in VersionedTable(spark, target).read().collect()) == [1, 2, 3]
