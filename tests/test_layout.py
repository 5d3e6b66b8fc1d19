"""Scans that skip: clustered files, Bloom filters, footers."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import upsert as U
from tidemark.plans import layout as L
from tidemark.sources.readers import watermark_filter


def scanned(df):
    """Rows that a query's Parquet scan handed on, without adaptive plans."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = df.select("*")
        plan = out._jdf.queryExecution().executedPlan()
        rows = sorted(map(tuple, out.collect()))
        plan = out._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    leaves = plan.collectLeaves()
    n = sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())
            if "FileScan" in leaves.apply(i).toString() or "Scan parquet" in leaves.apply(i).nodeName())
    return rows, n


@pytest.fixture()
def marked(spark):
    at = F.expr("timestamp_seconds(1000000000 + pmod(xxhash64(id), 100000)) as at")
    return spark.range(20_000).repartition(8).select("id", at)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_a_mark_reads_its_range_of_files(spark, marked, tmp, kind):
    marked = marked.withColumn("at", F.col("at").cast(kind))
    L.write_clustered(marked, tmp + "/by", ["at", "id"], files=20)
    marked.write.parquet(tmp + "/as-is")
    since = dt.datetime.fromtimestamp(1000000000 + 97_000, dt.timezone.utc).replace(tzinfo=None)
    want, all_rows = scanned(watermark_filter(spark.read.parquet(tmp + "/as-is"), "at", since))
    got, some = scanned(L.since_mark(spark.read.parquet(tmp + "/by"), "at", since))
    assert got == want and 300 < len(got) < 1000
    assert all_rows == 20_000 and some <= 2 * 20_000 / 20 + len(got)


@pytest.mark.parametrize("bloom", [None, "id"])
def test_keys_read_few_row_groups(spark, marked, tmp, bloom):
    L.write_clustered(marked, tmp + "/t", "id" if bloom is None else "at", files=20, bloom=bloom, bloom_keys=2000)
    table = spark.read.parquet(tmp + "/t")
    batch = spark.range(500, 503).union(spark.range(500, 501)).union(spark.sql("select cast(null as long)"))
    got, n = scanned(L.match_keys_pruned(table, batch, "id"))
    assert got == sorted(map(tuple, U.match_keys(table, batch, "id").collect())) and len(got) == 3
    assert n <= 4 * 1000 + 1000
    bounds, n = scanned(L.match_keys_pruned(table, batch, "id", most=2))
    assert bounds == got and (n <= 2000 if bloom is None else True)


def test_pruned_matches_equal_plain_ones(spark, marked, tmp):
    L.write_clustered(marked, tmp + "/t", "id", files=5)
    table = spark.read.parquet(tmp + "/t")
    for batch in (spark.range(0), spark.range(19_990, 20_020), spark.range(0, 20_000, 7),
                  spark.sql("select cast(null as long) as id")):
        for how in ("left_semi", "left_anti"):
            a = L.match_keys_pruned(table, batch, "id", how)
            b = U.match_keys(table, batch, "id", how)
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_bounds_come_from_footers(spark, marked, tmp):
    data = marked.union(spark.sql("select cast(null as long), cast(null as timestamp)"))
    L.write_clustered(data, tmp + "/t", "id", files=4)
    out = L.footer_bounds(spark, tmp + "/t", "id")
    assert "PushedAggregation: [MIN(id), MAX(id), COUNT(*)]" in out._jdf.queryExecution().executedPlan().toString()
    assert tuple(out.first()) == (0, 19_999, 20_001)
    under = L.footer_scan(spark, tmp + "/t").where("id >= 100").agg(F.min("id"), F.count(F.lit(1)))
    assert tuple(under.first()) == (100, 19_900)
    assert "PushedAggregation: []" in under._jdf.queryExecution().executedPlan().toString()
    spark.range(0).write.parquet(tmp + "/none")
    assert tuple(L.footer_bounds(spark, tmp + "/none", "id").first()) == (None, None, 0)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
