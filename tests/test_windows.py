from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.windows import group_row_number, range_row_number, ranged, trailing_frame


def skewed(spark, n=20000):
    # group 0 holds 90% of the rows
    return (spark.range(n).select(
        F.when(F.col("id") % 10 == 0, (F.col("id") % 7) + 1).otherwise(F.lit(0)).alias("g"),
        ((F.col("id") * 7919) % n).alias("ts"), F.col("id").alias("rid"),
        (F.col("id") % 13).alias("v")))


def test_row_numbers_exact_and_hot_group_split(spark):
    df = skewed(spark)
    got = group_row_number(df, "g", ["ts", "rid"], F.floor(F.col("ts") / 100))
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("ts", "rid")) - 1)
    a = sorted(map(tuple, got.select("rid", "rn").collect()))
    b = sorted(map(tuple, ref.select("rid", "rn").collect()))
    assert a == b
    # the hot group is spread: no bucket holds more than 100 of its rows
    most = df.groupBy("g", F.floor(F.col("ts") / 100)).count().agg(F.max("count")).first()[0]
    assert most <= 100


def test_null_groups_and_buckets_are_numbered(spark):
    df = spark.createDataFrame([(None, None, 1), (None, 5, 2), (None, 7, 3), (1, None, 4), (1, 2, 5)],
                               "g int, ts int, rid int")
    got = {r["rid"]: r["rn"] for r in group_row_number(df, "g", ["ts", "rid"], F.floor(F.col("ts") / 2)).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 0, 5: 1}


def test_trailing_frame_blocks_match_window(spark):
    df = skewed(spark, 3000)
    numbered = group_row_number(df, "g", ["ts", "rid"], F.floor(F.col("ts") / 100))
    aggs = {"s": F.sum("v"), "c": F.count(F.lit(1))}
    got = trailing_frame(numbered, "g", "rn", 7, aggs, block_rows=50)
    w = Window.partitionBy("g").orderBy("rn").rowsBetween(-7, -1)
    ref = numbered.withColumn("s", F.sum("v").over(w)).withColumn("c", F.count(F.lit(1)).over(w))
    cols = ["rid", "s", "c"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, ref.select(*cols).collect()))
    # no window partition is larger than a block plus its halo
    sizes = (numbered.withColumn("b", F.floor(F.col("rn") / 50)).groupBy("g", "b").count()
             .agg(F.max("count")).first()[0])
    assert sizes <= 50


def test_ranges_number_like_a_window_and_split_one_moment(spark):
    # group 0 holds 90% of the rows, a third of all rows are of one time
    df = skewed(spark, 6000).withColumn("ts", F.when(F.col("rid") % 3 == 0, 17).otherwise(F.col("ts")))
    df = df.unionByName(df.limit(5).withColumn("g", F.lit(None).cast("int")).withColumn("rid", F.col("rid") + 10000))
    order = ["ts", "rid"]
    dealt = ranged(df, ["g", *order], partitions=12)
    got = range_row_number(dealt, ["g"], order)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)) - 1)
    assert sorted(map(tuple, got.select("rid", "rn").collect())) == sorted(map(tuple, ref.select("rid", "rn").collect()))
    assert dealt.groupBy("_part").count().agg(F.max("count")).first()[0] < 2 * 6005 / 12


def test_ranges_without_a_group(spark):
    df = skewed(spark, 500)
    order = [F.col("ts").desc(), F.col("rid").desc()]
    got = range_row_number(ranged(df, order, partitions=5), [], order)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)) - 1)
    assert sorted(map(tuple, got.select("rid", "rn").collect())) == sorted(map(tuple, ref.select("rid", "rn").collect()))
    empty = df.limit(0)
    assert range_row_number(ranged(empty, order), [], order).collect() == []
