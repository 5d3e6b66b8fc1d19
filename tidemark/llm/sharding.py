"""Sharding by proportional stratified interleaving.

Rows of a source are ranked in a seeded shuffle; row k of n gets the
fractional rank (k - 1/2) / n; all rows are sorted by it and cut into equal
runs. Any run then holds every source in proportion, within one row or so.

Both rankings are distributed: rows fall into buckets of the sort key, the
buckets' counts are summed up in order, and a row's rank is its bucket's
start plus its place in the bucket. No source, however large, is sorted in
one task. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, table, text_or_empty

BUCKET_ROWS = 5_000  # mean rows of a bucket of the sort key


def _ranked(rows: DataFrame, part: str | None, bucket: str, order: list, out: str, name: str) -> DataFrame:
    """Adds 0-based ``out``: the rank by (bucket, order) within ``part``.

    The window over all buckets sums one row a bucket; the window inside a
    bucket sorts about ``BUCKET_ROWS`` rows."""
    keys = [part, bucket] if part else [bucket]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    if part:
        before = Window.partitionBy(part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                                 ), name)
    inside = Window.partitionBy(*keys).orderBy(*order)
    cond = [rows[k].eqNullSafe(starts[k]) for k in keys]
    for c in cond[1:]:
        cond[0] = cond[0] & c
    return (rows.withColumn("_place", F.row_number().over(inside))
            .join(starts, cond[0]).select(rows["*"], (F.col("_start") + F.col("_place") - 1).alias(out)))


def shard(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", seed: int = 17, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(``_id``, ``_size``, ``_crc``, ``_shard``, ``_slot``) of each row.

    Shards' counts differ by one at most (law ``rows``). Null text is empty; a
    null source is a source of its own; null ids and repeated rows are rows
    like any other (alike rows are interchangeable). An empty table gives an
    empty result. Other columns are left alone.
    """
    text = text_or_empty(F.col(f"`{text_col}`"))
    rows = saved(docs.select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{source_col}`").alias("_src"),
        (F.octet_length(text) + 1).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{source_col}`"), text).alias("_h")),
        "shard-rows")
    sizes = saved(rows.groupBy("_src").agg(F.count(F.lit(1)).alias("_n")), "shard-sources")
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    # the shuffle's order is that of the hash; its leading part is the bucket
    unit = (F.col("_h") / F.lit(2.0 ** 64)) + F.lit(0.5)
    bucketed = rows.join(sizes, rows["_src"].eqNullSafe(sizes["_src"])).select(
        rows["*"], "_n", F.floor(unit * F.ceil(F.col("_n") / F.lit(bucket_rows))).alias("_b"))
    tie = ["_h", "_id", "_size", "_crc"]
    ranked = _ranked(bucketed, "_src", "_b", tie, "_k", "shard-starts")
    spread = saved(ranked.withColumn("_f", (F.col("_k") + 0.5) / F.col("_n")), "shard-ranks")
    n_buckets = -(-total // bucket_rows) or 1
    placed = _ranked(spread.withColumn("_b2", F.floor(F.col("_f") * F.lit(n_buckets))), None, "_b2",
                     ["_f", "_src", *tie], "_pos", "shard-places")
    # shard s holds positions from ceil(s * total / n) on
    s = F.expr(f"cast(_pos * {n_shards}L div {max(total, 1)}L as int)")
    first = F.expr(f"(_shard * {max(total, 1)}L + {n_shards - 1}L) div {n_shards}L")
    return (placed.withColumn("_shard", s)
            .select("_id", "_size", "_crc", "_shard", (F.col("_pos") - first).cast("long").alias("_slot")))


def op8_interleaved_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, counts at most one apart."""
    return shard(table(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
