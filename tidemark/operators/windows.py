"""Skew-safe ordered windows.

A window partitioned by a group key sends each group to one task; a
group holding a third of all rows would then be sorted and scanned by a
single task. These helpers number the rows of every group in order and
evaluate short trailing frames without ever putting a whole group in one
partition:

* ``group_row_number`` cuts every group into buckets of a coarse order key
  (such as the day), counts the rows of each bucket, sums the counts up in
  order, and numbers the rows inside a bucket: a row's number is its bucket's
  start plus its place there. No task holds more than one bucket of a group,
  nothing is written and no job runs while the plan is built.
* ``ranged`` deals rows into ranges of (group, order) by Spark's sampled
  quantiles and writes them once; ``range_row_number`` numbers the rows of a
  group from the counts of its ranges. Ranges are cut inside a day, and inside
  rows of one time, so a bucket of the coarse key holding a third of all rows
  is spread as evenly as any other.
* ``trailing_frame`` cuts every group into blocks of ``block_rows``
  consecutive rows and copies the last ``k`` rows of each block into the
  next one, so a frame of the ``k`` previous rows is a window partitioned
  by (group, block): no partition exceeds ``block_rows + k`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import fresh_scratch, materialize

DEFAULT_BLOCK_ROWS = 100_000


def group_row_number(df: DataFrame, group: str, order: Sequence[str], bucket: Column,
                     out: str = "rn") -> DataFrame:
    """``df`` with ``out`` = 0-based position of each row in its group by
    ``order`` (ascending; the order must be unique within a group). ``bucket``
    must rise with the first order column. Null groups and buckets are groups
    and buckets of their own."""
    rows = df.withColumn("_bkt", bucket)
    # one row per group and bucket
    before = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(F.col(group).alias("_g"), F.col("_bkt").alias("_b"))
              .agg(F.count(F.lit(1)).alias("_n"))
              .select("_g", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    inside = Window.partitionBy(group, "_bkt").orderBy(*order)
    return (rows.withColumn("_place", F.row_number().over(inside) - 1)
            .join(starts, F.col(group).eqNullSafe(F.col("_g")) & F.col("_bkt").eqNullSafe(F.col("_b")))
            .withColumn(out, (F.col("_before") + F.col("_place")).cast("bigint"))
            .drop("_g", "_b", "_bkt", "_place", "_before"))


def ranged(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None,
           part: str = "_part") -> DataFrame:
    """``df`` written once under the checkpoint folder, dealt into ranges of
    ``order`` by sampled quantiles, with the number of its range as ``part``
    (rising with ``order``; as many ranges as ``partitions``, by default as
    shuffles have). Rows equal in all of ``order`` share a range, so it should
    end with an id. Written because ranges sampled anew need not be the same."""
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return materialize(dealt.withColumn(part, F.spark_partition_id()), fresh_scratch(df.sparkSession, "ranged"))


def range_row_number(dealt: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                     out: str = "rn", part: str = "_part") -> DataFrame:
    """``dealt``, a result of ``ranged`` by ``order`` (with or without the
    columns of ``group`` in front), with ``out`` = 0-based position of each row
    in its group by ``order``. A window holds a group's rows of one range; the
    counts summed up in order are one row per group and range. Null groups are
    groups of their own; without ``group`` all rows are one."""
    keys = [F.col(g) for g in group]
    before = (Window.partitionBy(*[f"_g{i}" for i in range(len(keys))]).orderBy("_p")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = (dealt.groupBy(F.col(part).alias("_p"), *[k.alias(f"_g{i}") for i, k in enumerate(keys)])
              .agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(part, *keys).orderBy(*order)
    same = F.col(part) == F.col("_p")
    for i, k in enumerate(keys):
        same = same & k.eqNullSafe(F.col(f"_g{i}"))
    return (dealt.withColumn("_place", F.row_number().over(inside) - 1).join(starts, same)
            .withColumn(out, (F.col("_before") + F.col("_place")).cast("bigint"))
            .drop("_p", "_place", "_before", *[f"_g{i}" for i in range(len(keys))]))


def trailing_frame(numbered: DataFrame, group: str, rn: str, k: int,
                   aggs: dict[str, Column], block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Evaluate ``aggs`` (name -> aggregate column) over the ``k`` rows
    before each row of its group (``rowsBetween(-k, -1)`` by ``rn``)."""
    if block_rows <= k:
        raise ValueError("block_rows must exceed k")
    blk = F.floor(F.col(rn) / F.lit(block_rows)).cast("bigint")
    own = numbered.withColumn("_blk", blk).withColumn("_halo", F.lit(False))
    halo = (numbered.where((F.col(rn) % block_rows) >= block_rows - k)
            .withColumn("_blk", blk + 1).withColumn("_halo", F.lit(True)))
    w = Window.partitionBy(group, "_blk").orderBy(rn).rowsBetween(-k, -1)
    framed = own.unionByName(halo)
    for name, agg in aggs.items():
        framed = framed.withColumn(name, agg.over(w))
    return framed.where(~F.col("_halo")).drop("_blk", "_halo")
