"""Files laid out so that a scan can skip most of them.

A Parquet footer holds the least and greatest value and the row count of each
row group. Rows clustered by a column make those ranges narrow, so a pushed
filter reads the row groups it needs; Bloom filters do the same for single
keys; and bounds and counts come from the footers alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.upsert import _keys, distinct_keys, match_keys
from tidemark.plans.buckets import _setting
from tidemark.sources.readers import _since_lit, watermark_filter

PUSHED_KEYS = 1000  # keys of a batch that go into the scan's filter one by one
_V1 = "spark.sql.sources.useV1SourceList"
_AGGREGATES = "spark.sql.parquet.aggregatePushdown"


def _number(col: str) -> str:
    """Name of the column that holds a timestamp without zone as a number."""
    return f"_{col}_us"


def _micros(at: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at)


def since_mark(df: DataFrame, mark: str, since) -> DataFrame:
    """``watermark_filter`` over a table of ``write_clustered``, without the
    number column it may have. The mark itself is included."""
    if _number(mark) not in df.columns:
        return watermark_filter(df, mark, since)
    least = _micros(_since_lit(since).cast("timestamp_ntz"))
    return watermark_filter(df.where(F.col(_number(mark)) >= least), mark, since).drop(_number(mark))


def write_clustered(df: DataFrame, path: str, by: str | Sequence[str], files: int | None = None,
                    bloom: str | None = None, bloom_keys: int = 1_000_000, mode: str = "errorifexists") -> None:
    """Writes ``df`` in ranges of ``by``, sorted within each file: a filter on
    the first column of ``by`` reads the row groups of its range only. With
    ``bloom`` each row group also gets a Bloom filter of that column, sized for
    ``bloom_keys`` distinct values. Ranges are cut by sampling, so a value
    holding a third of all rows makes one large file; give further columns
    (the key) in ``by`` to split it. Nulls come first.

    Spark compares no footer statistics of timestamps without zone, so a first
    column of that type is also written as microseconds, ``_<column>_us``;
    read with ``since_mark``, which filters on that number and drops it."""
    by = _keys(by)
    if df.schema[by[0]].dataType == T.TimestampNTZType():
        df = df.withColumn(_number(by[0]), _micros(F.col(by[0])))
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    w = ranged.sortWithinPartitions(*by).write.mode(mode)
    if bloom:
        w = (w.option(f"parquet.bloom.filter.enabled#{bloom}", "true")
             .option(f"parquet.bloom.filter.expected.ndv#{bloom}", str(bloom_keys)))
    # Spark's default form of a timestamp (INT96) has no footer statistics
    with _setting(df.sparkSession, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"):
        w.parquet(path)


def footer_scan(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table at ``path`` through the reader that answers ``min``,
    ``max`` and ``count`` from footers (integers, floats, dates and booleans,
    without a filter on data columns; all else is scanned as usual)."""
    spark.conf.set(_AGGREGATES, "true")  # read when a query is planned; this reader alone heeds it
    v1 = ",".join(f for f in spark.conf.get(_V1).split(",") if f.strip() != "parquet")
    with _setting(spark, _V1, v1):
        return spark.read.parquet(path)


def footer_bounds(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(lo, hi, n_rows) of a key as one row, without reading the rows. An empty
    table gives nulls and 0; null keys count as rows."""
    out = footer_scan(spark, path).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n"))
    # a table without any row group hands on no count at all
    return out.select("lo", "hi", F.greatest("n", F.lit(0).cast("long")).alias("n_rows"))


def match_keys_pruned(df: DataFrame, batch: DataFrame, key: str, how: str = "left_semi",
                      most: int = PUSHED_KEYS) -> DataFrame:
    """``match_keys`` against the batch's keys (a single column), reading only
    the row groups that may hold one of them.

    One aggregate over the batch gives its bounds, and its keys if they are
    ``most`` at the most: the bounds become a pushed range, which footer
    statistics serve, the keys a pushed list, which Bloom filters serve too.
    Null keys match nothing. ``left_anti`` must read every row: no filter is
    pushed then. A batch without keys matches nothing.
    """
    keys = distinct_keys(batch, key)
    if how != "left_semi":
        return match_keys(df, keys, key, how)
    lo, hi = keys.agg(F.min(key), F.max(key)).first()
    few = [r[0] for r in keys.limit(most + 1).collect()]
    if lo is None:
        return df.where(F.lit(False))
    if len(few) <= most:
        # a list longer than this setting would be pushed as its bounds only
        name = "spark.sql.parquet.pushdown.inFilterThreshold"
        df.sparkSession.conf.set(name, str(max(most, int(df.sparkSession.conf.get(name)))))
        return df.where(F.col(key).isin(few))
    return match_keys(df.where(F.col(key).between(F.lit(lo), F.lit(hi))), keys, key)
