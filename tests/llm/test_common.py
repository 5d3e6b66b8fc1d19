"""Shared helpers and the contracts of the registered queries."""

import random

import pandas as pd
import pytest

from tidemark.llm import common
from tidemark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_components_match_union_find(spark):
    r = random.Random(4)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def root(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {q["node"]: q["label"] for q in common.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {a: root(a) for a in parent}


def test_blocks_meet_every_pair(spark):
    rows = spark.createDataFrame([(1, i) for i in range(70)] + [(2, 5), (2, 6), (3, 9)], "_key long, _id long")
    got = common.in_blocks(rows, "_key", "_id", 8, "t").collect()
    groups = {}
    for r in got:
        groups.setdefault((r["_key"], r["bi"], r["bj"]), []).append((r["_id"], r["own"]))
    seen = {}
    for (k, bi, bj), m in groups.items():
        for a, oa in m:
            for b, ob in m:
                if a < b and (bi == bj or oa != ob):
                    seen[k, a, b] = seen.get((k, a, b), 0) + 1
    assert seen == {**{(1, a, b): 1 for a in range(70) for b in range(a + 1, 70)}, (2, 5, 6): 1}


def test_sorted_groups_are_whole():
    r = random.Random(1)
    frame = pd.DataFrame({"k": sorted(r.randrange(30) for _ in range(200)), "v": range(200)})
    for step in (1, 3, 7, 50, 500):
        got = list(common.sorted_groups((frame.iloc[i:i + step] for i in range(0, 200, step)), ["k"]))
        assert pd.concat(got)["v"].tolist() == list(range(200))
        assert sum(g["k"].nunique() for g in got) == frame["k"].nunique()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    out = QUERIES[name](spark, SF)
    kinds = dict(out.dtypes)
    assert out.count() >= 0
    assert kinds.get("doc_id", kinds.get("page_id", kinds.get("vec_id", kinds.get("rank")))) == "bigint"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_sql(spark, name):
    pytest.importorskip("duckdb")
    from tests.oracle_compare import canon, duck
    df = QUERIES[name](spark, SF)
    cols, rows = canon(df.columns, df.collect())
    cur = duck(SF).execute(ORACLE_SQL[name])
    assert (cols, rows) == canon([d[0] for d in cur.description], cur.fetchall())


def test_pipeline_keeps_columns_and_runs(spark):
    import corpus_pipeline as p
    docs = common.table(spark, SF, "documents")
    want = docs.dtypes
    for name, stage in p.STAGES[:-1]:
        docs = common.saved(stage(spark, docs, SF), "test-pipeline")
        assert docs.dtypes == want, name
    n = p.STAGES[-1][1](spark, docs, SF).count()
    assert n and p.run(spark, SF).count() > 0


def test_equal_sets_of_ids_are_compared_once(spark):
    import itertools
    import random
    rnd = random.Random(5)
    rows = [(k, i) for k in range(40) for i in rnd.sample(range(9), rnd.choice([1, 2, 2, 3]))]
    rows += [(100 + k, i) for k in range(3) for i in range(50, 80)]
    df = spark.createDataFrame(rows, "_key long, _id long")

    def met(once):
        groups = {}
        for r in common.in_blocks(df, "_key", "_id", 8, "t", once=once).collect():
            groups.setdefault((r["_key"], r["bi"], r["bj"]), set()).add(r["_id"])
        return groups, {p for g in groups.values() for p in itertools.combinations(sorted(g), 2)}

    (every, pairs), (few, same) = met(False), met(True)
    assert pairs == same and len(few) < len(every)
    sets = {}
    for k, i in rows:
        sets.setdefault(k, set()).add(i)
    want = {min(k for k in sets if sets[k] == s) for s in sets.values() if len(s) > 1}
    assert {k for k, _, _ in few} == want
