"""Driver contract and oracle agreement on the smallest scale."""
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tests.oracle_compare import canon, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                          "o_orderdate", "o_orderpriority"]


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.queries()) and set(E.QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    scols, srows = canon(df.columns, df.collect())
    cur = con.execute(E.oracle_sql()[name])
    dcols, drows = canon([d[0] for d in cur.description], cur.fetchall())
    assert scols == dcols
    assert srows == drows


def test_time_queries_do_not_depend_on_the_session_zone(spark, con):
    import tidemark.plans.queries as Q
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for name in ("run_durations", "volume_history", "platform_stats", "resolve_watermark",
                     "run_state", "anomaly_feed"):
            df = Q.QUERIES[name](spark, SF)  # without the entry's UTC setting
            cur = con.execute(E.oracle_sql()[name])
            assert canon(df.columns, df.collect()) == canon([d[0] for d in cur.description],
                                                            cur.fetchall()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
