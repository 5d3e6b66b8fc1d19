import pytest
from hypothesis import given, settings, strategies as st

from tidemark.operators import upsert as U

SCHEMA = "id long, v string, seq int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_delete_insert_null_and_duplicate_keys(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "n", 0)], SCHEMA)
    batch = spark.createDataFrame([(2, "b1", 1), (2, "b2", 2), (3, "c", 1), (None, "m", 1)], SCHEMA)
    out = rows(U.upsert_delete_insert(target, batch, "id"))
    # key 2 replaced by both batch rows; null keys never match, all kept
    assert out == sorted([(1, "a", 0), (None, "n", 0), (2, "b1", 1), (2, "b2", 2), (3, "c", 1),
                          (None, "m", 1)], key=repr)


def test_last_wins_keeps_latest_per_key(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "n", 0)], SCHEMA)
    batch = spark.createDataFrame([(2, "b1", 1), (2, "b2", 2), (3, "c", 1), (None, "m", 1),
                                   (None, "m2", 2)], SCHEMA)
    out = rows(U.upsert_last_wins(target, batch, "id", ["seq"]))
    assert out == sorted([(1, "a", 0), (None, "n", 0), (2, "b2", 2), (3, "c", 1),
                          (None, "m", 1), (None, "m2", 2)], key=repr)


def test_empty_batch_and_empty_target(spark):
    target = spark.createDataFrame([(1, "a", 0)], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(U.upsert_delete_insert(target, empty, "id")) == [(1, "a", 0)]
    assert rows(U.upsert_last_wins(target, empty, "id", ["seq"])) == [(1, "a", 0)]
    assert rows(U.upsert_delete_insert(empty, target, "id")) == [(1, "a", 0)]
    assert rows(U.upsert_last_wins(empty, target, "id", ["seq"])) == [(1, "a", 0)]


def test_dedup_order_descending_nulls_last(spark):
    b = spark.createDataFrame([(1, "x", None), (1, "y", 5), (1, "z", 3)], SCHEMA)
    assert rows(U.dedup_last_wins(b, "id", ["seq"])) == [(1, "y", 5)]


def test_load_stats(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "n", 0)], SCHEMA)
    batch = spark.createDataFrame([(2, "b1", 1), (2, "b2", 2), (3, "c", 1)], SCHEMA)
    r = U.load_stats(target, batch, "id").first().asDict()
    assert r == {"rows_before": 3, "rows_batch": 3, "rows_replaced": 1, "rows_after": 5}


def test_match_keys_semi_anti(spark):
    t = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "n", 0)], SCHEMA)
    k = spark.createDataFrame([(2, "", 0), (None, "", 0)], SCHEMA)
    assert rows(U.match_keys(t, k, "id", "left_semi")) == [(2, "b", 0)]
    assert rows(U.match_keys(t, k, "id", "left_anti")) == sorted([(1, "a", 0), (None, "n", 0)], key=repr)
    with pytest.raises(ValueError):
        U.match_keys(t, k, "id", "inner")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.text(max_size=3)), max_size=15),
       st.dictionaries(st.integers(0, 20), st.text(max_size=3), max_size=10))
def test_applying_unique_batch_twice_equals_once(spark, target_rows, batch_map):
    target = spark.createDataFrame([(k, v, 0) for k, v in target_rows], SCHEMA)
    batch = spark.createDataFrame([(k, v, 1) for k, v in batch_map.items()], SCHEMA)
    for fn in (lambda t: U.upsert_delete_insert(t, batch, "id"),
               lambda t: U.upsert_last_wins(t, batch, "id", ["seq"])):
        once = fn(target)
        assert rows(fn(once)) == rows(once)


def test_ties_are_ordered_and_an_order_is_required(spark):
    b = spark.createDataFrame([(1, v, 5) for v in "abcdef"], SCHEMA)
    kept = {tuple(map(tuple, U.dedup_last_wins(b.repartition(n), "id", ["seq"]).collect())) for n in (1, 2, 5)}
    assert len(kept) == 1
    with pytest.raises(ValueError):
        U.dedup_last_wins(b, "id", [])
