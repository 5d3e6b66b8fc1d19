import os
import random

import pytest
from hypothesis import given, settings, strategies as st

from tidemark.operators import upsert as U
from tidemark.plans.tables import VersionedTable

SCHEMA = "id long, v string, seq int"


def rows(df, cols=("id", "v", "seq")):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_layers_resolve_like_eager_upserts(spark, tmp):
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    base = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "n", 0), (3, "c", 0)], SCHEMA)
    vt.write(base, 0)
    eager = base
    batches = [
        ([(2, "b1", 1), (2, "b2", 1), (4, "d", 1), (None, "m", 1)], "id"),   # dup keys kept
        ([(4, "d2", 2), (5, "e", 2)], "id"),
        ([(1, "x", 3), (6, "f", 3)], None),                                 # plain append
        ([(1, "y", 4)], "id"),                                              # supersedes base and append
    ]
    for i, (data, key) in enumerate(batches, start=1):
        b = spark.createDataFrame(data, SCHEMA)
        vt.write_layer(b, i, key)
        eager = U.upsert_delete_insert(eager, b, key) if key else U.append(eager, b)
        assert rows(vt.read()) == rows(eager)
    assert vt.layers_since_base() == 4
    vt.compact()
    assert vt.layers_since_base() == 0 and rows(vt.read()) == rows(eager)


def test_layer_with_new_column_and_no_base(spark, tmp):
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    vt.write_layer(spark.createDataFrame([(1, "a", 0)], SCHEMA), 0, "id")
    vt.write_layer(spark.createDataFrame([(2, "b", 1, "z")], SCHEMA + ", extra string"), 1, "id")
    out = {r["id"]: r for r in vt.read().collect()}
    assert out[1]["extra"] is None and out[2]["extra"] == "z"
    vt.write_layer(spark.createDataFrame([(1, "a", 0)], SCHEMA), 2, "v")
    with pytest.raises(ValueError):
        vt.read()


def test_tags_and_uncommitted_versions(spark, tmp):
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    vt.write(spark.createDataFrame([(1, "a", 0)], SCHEMA), 0, tag="run:1")
    spark.createDataFrame([(9, "z", 9)], SCHEMA).write.parquet(vt.version_path(1))  # crashed write
    assert vt.has_tag("run:1") and not vt.has_tag("run:2")
    assert rows(vt.read()) == [(1, "a", 0)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("abc")),
                         max_size=6), min_size=1, max_size=4),
       st.booleans())
def test_random_layer_sequences(spark, batches, last_wins):
    import tempfile
    root = tempfile.mkdtemp(prefix="tm-layers-")
    vt = VersionedTable(spark, root)
    eager = spark.createDataFrame([], SCHEMA)
    vt.write(eager, 0)
    for i, data in enumerate(batches, start=1):
        b = spark.createDataFrame([(k, v, i * 10 + j) for j, (k, v) in enumerate(data)], SCHEMA)
        if last_wins:
            layer = U.dedup_last_wins(b, "id", ["seq"])
            eager = U.upsert_last_wins(eager, b, "id", ["seq"])
        else:
            layer = b
            eager = U.upsert_delete_insert(eager, b, "id")
        vt.write_layer(layer, i, "id")
    assert rows(vt.read()) == rows(eager)


def test_compaction_policy(spark, tmp):
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    vt.write(spark.range(100).selectExpr("id", "'a' AS v", "0 AS seq"), 0)
    assert not vt.should_compact()
    vt.write_layer(spark.range(10).selectExpr("id", "'b' AS v", "1 AS seq"), 1, "id")
    assert not vt.should_compact(ratio=0.25)            # 10 rows of 100
    vt.write_layer(spark.range(20).selectExpr("id", "'c' AS v", "2 AS seq"), 2, "id")
    assert vt.should_compact(ratio=0.25)                # 30 rows of 100
    assert not vt.should_compact(max_layers=5, ratio=0.5)
    assert vt.should_compact(max_layers=1, ratio=0.5)
    v = vt.compact()
    assert not vt.should_compact() and vt.read().count() == 100
    # the compaction opened a new epoch; readers see only its one commit
    assert vt._epochs() == [0, v] and [r["kind"] for r in vt._active()] == ["base"]
    assert vt.committed(1) and vt.has_tag("nope") is False


def test_obsolete_paths_lists_versions_before_the_kept_bases(spark, tmp):
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    vt.write(spark.range(5).selectExpr("id", "'a' AS v", "0 AS seq"), 0)
    vt.write_layer(spark.range(2).selectExpr("id", "'b' AS v", "1 AS seq"), 1, "id")
    vt.compact()                                   # base 2
    vt.write_layer(spark.range(1).selectExpr("id", "'c' AS v", "2 AS seq"), 3, "id")
    vt.compact()                                   # base 4
    assert vt.obsolete_paths(keep_bases=2) == [vt.version_path(0), vt.version_path(1)]
    assert vt.obsolete_paths(keep_bases=1) == [vt.version_path(v) for v in (0, 1, 2, 3)]
    assert vt.read().count() == 5


def test_replay_is_found_after_any_number_of_compactions(spark, tmp):
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    vt.write(spark.createDataFrame([(1, "a", 0)], SCHEMA), 0, tag="run:1")
    for i in range(2, 6):
        vt.write_layer(spark.createDataFrame([(i, "a", 0)], SCHEMA), vt.next_version(), None, tag=f"run:{i}")
        vt.compact()
    assert all(vt.has_tag(f"run:{i}") for i in range(1, 6)) and not vt.has_tag("run:6")


def test_changed_types_are_widened_on_read(spark, tmp):
    from decimal import Decimal
    vt = VersionedTable(spark, os.path.join(tmp, "t"))
    vt.write(spark.createDataFrame([(1, 5, 7)], "id int, n int, b bigint"), 0)
    vt.write_layer(spark.createDataFrame([(2, Decimal("12.75"), "abc")], "id bigint, n decimal(18,4), b string"), 1, "id")
    vt.write_layer(spark.createDataFrame([(9_000_000_000, Decimal("1"), None)], "id bigint, n decimal(18,4), b string"),
                   2, "id")
    got = sorted(map(tuple, vt.read().select("id", "n", "b").collect()))
    assert got == [(1, Decimal("5.0000"), "7"), (2, Decimal("12.7500"), "abc"), (9_000_000_000, Decimal("1.0000"), None)]


def test_widest_types():
    from pyspark.sql import types as T
    from tidemark.functions.types import widest
    pairs = [(T.IntegerType(), T.LongType(), T.LongType()), (T.IntegerType(), T.DecimalType(18, 4), T.DecimalType(18, 4)),
             (T.LongType(), T.DecimalType(10, 2), T.DecimalType(21, 2)), (T.LongType(), T.DoubleType(), T.StringType()),
             (T.IntegerType(), T.DoubleType(), T.DoubleType()), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
             (T.BooleanType(), T.IntegerType(), T.StringType()), (T.DecimalType(38, 0), T.DecimalType(38, 10), T.StringType())]
    for a, b, want in pairs:
        assert widest(a, b) == widest(b, a) == want
