"""Targets in folders by key hash."""
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import upsert as U
from tidemark.plans.buckets import BUCKET, BucketedTarget

SCHEMA = "id long, part string, v string, seq int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def make(spark, tmp):
    made = []

    def run(df, key="id", buckets=8):
        t = BucketedTarget.create(df, "t" + uuid.uuid4().hex, key, buckets, tmp)
        made.append(t)
        return t
    yield run
    for t in made:
        t.forget()


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def numbers(spark, n, tag="old"):
    return frame(spark, [(i, "p", f"{tag}{i}", i) for i in range(n)])


def files(target):
    return {r[0] for r in target.spark.table(target.name).select(F.input_file_name()).distinct().collect()}


def test_equals_the_plain_upserts(spark, make):
    old = numbers(spark, 300).union(frame(spark, [(None, "p", "n", 0), (5, "p", "twice", 0)]))
    batch = frame(spark, [(3, "p", "a", 1), (3, "p", "b", 2), (5, "p", "c", 1), (999, "q", "new", 1),
                          (None, "p", "m", 1), (None, None, None, None)])
    for order in (None, ["seq"]):
        t = make(old)
        assert rows(t.read()) == rows(old)
        t.upsert(batch, "r1", order)
        want = U.upsert_last_wins(old, batch, "id", order) if order else U.upsert_delete_insert(old, batch, "id")
        assert rows(t.read()) == rows(want)


def test_only_touched_folders_are_written_anew(spark, make):
    t = make(numbers(spark, 400), buckets=16)
    before = files(t)
    touched = t.upsert(numbers(spark, 3, "new"), "r1")
    assert 1 <= len(touched) <= 3
    gone = before - files(t)
    assert gone and all(any(f"{BUCKET}={b}/" in f for b in touched) for f in gone)
    assert {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in files(t) - before} == set(touched)


def test_a_replay_changes_nothing_even_after_a_later_run(spark, make):
    t = make(numbers(spark, 50))
    first = numbers(spark, 5, "one").union(frame(spark, [(None, "p", "n", 0)]))
    t.upsert(first, "r1")
    t.upsert(numbers(spark, 5, "two"), "r2")
    want, kept = rows(t.read()), files(t)
    assert t.upsert(first, "r1") == []
    assert rows(t.read()) == want and files(t) == kept


def test_a_run_that_ended_half_way_is_applied_once_more(spark, make, monkeypatch):
    t = make(numbers(spark, 50))
    batch = numbers(spark, 5, "one").union(frame(spark, [(None, "p", "n", 0)]))
    with monkeypatch.context() as m:  # the log of runs cannot be written
        m.setattr(BucketedTarget, "runs", property(lambda self: self.name + "_lost"))
        m.setattr(BucketedTarget, "applied", lambda self, run: False)
        with pytest.raises(Exception):
            t.upsert(batch, "r1")
    t.upsert(batch, "r1")
    assert rows(t.read()) == rows(U.upsert_delete_insert(numbers(spark, 50), batch, "id"))


def test_the_target_is_not_shuffled(spark, make):
    t = make(numbers(spark, 400), buckets=16)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = t.merged(numbers(spark, 40, "new"), range(16))
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    target = plan[plan.index("SortMergeJoin"):plan.index("Bucketed: true")]
    scan = target[:target.rindex("FileScan parquet")]
    assert "Exchange" not in scan and "Batched" in plan
    assert "PartitionFilters: [" + BUCKET in plan


def test_only_asked_folders_are_read(spark, make):
    t = make(numbers(spark, 400), buckets=16)
    some = t.spark.table(t.name).where(F.col(BUCKET).isin([1, 2]))
    assert {r[0] for r in some.select(BUCKET).distinct().collect()} == {1, 2}
    assert len(some.inputFiles()) <= len(files(t))


def test_several_key_columns_and_new_columns(spark, make):
    old = frame(spark, [(1, "a", "x", 0), (1, "b", "y", 0), (1, None, "z", 0)])
    t = make(old, ["id", "part"])
    batch = frame(spark, [(1, "a", "new", 1), (1, None, "w", 1)]).drop("seq").withColumn("more", F.lit(2.5))
    t.upsert(batch, "r1")
    assert t.columns() == ["id", "part", "v", "seq", "more"]
    assert rows(t.read()) == sorted([(1, "b", "y", 0, None), (1, None, "z", 0, None), (1, "a", "new", None, 2.5),
                                     (1, None, "w", None, 2.5)], key=repr)


def test_a_changed_type_or_a_missing_key_is_refused(spark, make):
    t = make(numbers(spark, 5))
    want = rows(t.read())
    for bad in (numbers(spark, 2).withColumn("seq", F.lit(1.5)), numbers(spark, 2).drop("id")):
        with pytest.raises(ValueError):
            t.upsert(bad, "r1")
    with pytest.raises(ValueError):
        t.upsert(numbers(spark, 2), "")
    assert rows(t.read()) == want and not t.applied("r1")


def test_empty_batch_and_empty_target(spark, make):
    t = make(frame(spark, []))
    assert rows(t.read()) == []
    assert t.upsert(frame(spark, []), "r0") == [] and t.applied("r0")
    t.upsert(numbers(spark, 5), "r1")
    assert rows(t.read()) == rows(numbers(spark, 5))


def test_a_hot_key(spark, make):
    old = numbers(spark, 200).union(frame(spark, [(7, "p", f"h{i}", i) for i in range(400)]))
    batch = frame(spark, [(7, "p", f"b{i}", i) for i in range(500)]).union(numbers(spark, 3, "new"))
    t = make(old.union(frame(spark, [(7, "p", f"more{i}", i) for i in range(9000)])), buckets=16)
    assert t.hot(range(16)) and not make(numbers(spark, 200), buckets=16).hot(range(16))
    t.upsert(numbers(spark, 200, "all").union(batch), "r1")  # in splits
    t.upsert(batch, "r2")  # dealt by the key again
    want = U.upsert_delete_insert(numbers(spark, 200, "all").where("id not in (0, 1, 2, 7)"), batch, "id")
    assert rows(t.read()) == rows(want)
    by_key = t.spark.table(t.name).groupBy("id").count()
    assert sorted(map(tuple, by_key.collect())) == sorted([(i, 500 if i == 7 else 1) for i in range(200)])
