"""Set-based upserts of a batch into a target table.

No key ever travels to the driver: key matching is a semi/anti join that AQE
plans as a broadcast when the measured key set is small and as a sort-merge
join (with skewed partitions split) when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _order_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def match_keys(df: DataFrame, keys: DataFrame, key: str | Sequence[str],
               how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is (``left_semi``) or is not (``left_anti``) in ``keys``.

    Equality never matches a null key, as SQL ``IN`` does not.
    """
    ks = _keys(key)
    if how not in ("left_semi", "left_anti"):
        raise ValueError("how must be left_semi or left_anti")
    return df.join(keys.select(*ks), on=ks, how=how)


def distinct_keys(batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Non-null keys of the batch, once each (partial aggregation map-side,
    so a hot key collapses before the shuffle)."""
    ks = _keys(key)
    cond = None
    for k in ks:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return batch.select(*ks).where(cond).distinct()


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append without merge (no key configured)."""
    return target.unionByName(batch, allowMissingColumns=True)


def upsert_delete_insert(target: DataFrame, batch: DataFrame,
                         key: str | Sequence[str]) -> DataFrame:
    """Delete target rows whose key occurs in the batch, then add the whole batch.

    Duplicate keys inside the batch all survive; null keys never match, so a
    target row with a null key stays.
    """
    kept = match_keys(target, distinct_keys(batch, key), key, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def dedup_last_wins(batch: DataFrame, key: str | Sequence[str],
                    order_cols: Sequence[Column | str]) -> DataFrame:
    """One row per non-null key: the row that sorts first by ``order_cols``
    descending (nulls last). Rows with a null key are all kept.

    One pass: ``row_number() = 1`` lets Catalyst keep one row per key and map
    task before the shuffle, so a key holding a third of the batch is spread.
    Rows without a key get a number of their own in its place. Rows that tie
    on the whole order are told apart by a hash of all their columns, so a
    rerun keeps the same one. An order is required.
    """
    ks = _keys(key)
    if not order_cols:
        raise ValueError("last-wins needs an order: name the columns that tell which row is last")
    no_key = F.lit(False)
    for k in ks:
        no_key = no_key | F.col(k).isNull()
    plain = [f.name for f in batch.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = batch.withColumn("_tm_lone", F.when(no_key, F.monotonically_increasing_id()))
    order = [_order_col(c).desc_nulls_last() for c in order_cols]
    w = Window.partitionBy(*ks, "_tm_lone").orderBy(*order, F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    return (rows.withColumn("_tm_nth", F.row_number().over(w)).where("_tm_nth = 1")
            .drop("_tm_lone", "_tm_nth"))


def upsert_last_wins(target: DataFrame, batch: DataFrame, key: str | Sequence[str],
                     order_cols: Sequence[Column | str]) -> DataFrame:
    """Merge where the batch row wins: per key the last batch row replaces the
    target row, keys not in the batch keep their target row, new keys are
    inserted. Null-keyed rows on either side never conflict and are kept.
    """
    latest = dedup_last_wins(batch, key, order_cols)
    # deduplication keeps the key set, so keys come straight from the batch
    kept = match_keys(target, distinct_keys(batch, key), key, "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True)


def load_stats(target: DataFrame, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Counts of one delete-insert load, as one row: rows before, batch rows,
    target rows replaced, rows after."""
    ks = _keys(key)
    marked = distinct_keys(batch, ks).withColumn("_hit", F.lit(1))
    # keys are distinct, so the left join never multiplies target rows
    t = target.select(*ks).join(marked, ks, "left").select(
        F.lit(1).alias("_t"), F.coalesce(F.col("_hit"), F.lit(0)).alias("_r"), F.lit(0).alias("_b"))
    b = batch.select(F.lit(0).alias("_t"), F.lit(0).alias("_r"), F.lit(1).alias("_b"))
    # one aggregate over both sides instead of joining one-row frames
    return (t.unionByName(b)
            .agg(F.sum("_t").cast("bigint").alias("rows_before"),
                 F.sum("_b").cast("bigint").alias("rows_batch"),
                 F.sum("_r").cast("bigint").alias("rows_replaced"))
            .select(F.coalesce("rows_before", F.lit(0).cast("bigint")).alias("rows_before"),
                    F.coalesce("rows_batch", F.lit(0).cast("bigint")).alias("rows_batch"),
                    F.coalesce("rows_replaced", F.lit(0).cast("bigint")).alias("rows_replaced"))
            .withColumn("rows_after",
                        F.col("rows_before") - F.col("rows_replaced") + F.col("rows_batch")))
