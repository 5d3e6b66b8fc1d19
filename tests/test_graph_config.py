from tidemark.operators import config as C
from tidemark.operators import graph as G


def pipes(spark, ids):
    return spark.createDataFrame([(i, f"p{i}") for i in ids], "id long, name string")


def deps(spark, edges):
    return spark.createDataFrame(edges, "pipeline_id long, depends_on_id long")


def test_levels_chain_roots_isolated_cycle(spark):
    p = pipes(spark, range(1, 10))
    # chain 1 <- 2 <- 3; second root 4 with 5 depending on 4 and 3; 6 isolated;
    # cycle 7 <-> 8 and 9 below it
    d = deps(spark, [(2, 1), (3, 2), (5, 4), (5, 3), (7, 8), (8, 7), (9, 8)])
    lv = {r["pipeline_id"]: (r["level"], r["in_cycle"]) for r in G.dependency_levels(p, d).collect()}
    assert lv[1] == (0, False) and lv[2] == (1, False) and lv[3] == (2, False)
    assert lv[4] == (0, False) and lv[5] == (3, False) and lv[6] == (0, False)
    assert lv[7] == (None, True) and lv[8] == (None, True) and lv[9] == (None, True)
    iso = sorted(r["id"] for r in G.isolated_pipelines(p, d).collect())
    assert iso == [6]
    lists = {r["pipeline_id"]: r["depends_on"] for r in G.dependency_lists(d).collect()}
    assert lists[5] == [3, 4]
    edges = G.dependency_edges(deps(spark, [(2, 1), (2, 42)]), p).collect()
    assert [(r["pipeline_name"], r["depends_on_name"]) for r in edges] == [("p2", "p1")]


def conns(spark):
    return spark.createDataFrame([
        (1, "src", "postgresql", "db1", None, "u", "pw", True),
        (2, "wh", "snowflake", "analytics", "raw", "u", "pw", False)],
        "id long, name string, db_type string, db_name string, snowflake_schema string, "
        "db_user string, db_password string, is_active boolean")


def test_connection_listing_and_roles(spark):
    c = C.connection_roles(conns(spark))
    assert "db_password" not in c.columns and "db_user" not in c.columns
    assert {r["name"]: r["role"] for r in c.collect()} == {"src": "source", "wh": "destination"}
    assert C.source_connections(conns(spark)).count() == 1


def test_target_names_and_defaults(spark):
    p = spark.createDataFrame([
        (1, 2, None, "", "orders", "", None),
        (2, 9, "mydb", "Sales", "items", None, "key")],
        "id long, destination_connection_id long, target_database string, "
        "target_schema_name string, target_table string, watermark_column string, "
        "merge_key_column string")
    out = {r["id"]: r for r in C.target_names(C.with_defaults(p), conns(spark)).collect()}
    assert out[1]["target_fqn"] == "ANALYTICS.RAW.ORDERS"
    assert out[2]["target_fqn"] == "MYDB.SALES.ITEMS"
    assert out[1]["watermark_column"] == "updated_at" and out[1]["merge_key_column"] == "id"
    assert out[2]["merge_key_column"] == "key"


def test_export_and_resolve(spark):
    import datetime as dt
    p = spark.createDataFrame([(1, "a", 1, 2, "t", None, None, None, None, "t", 200, 50),
                               (2, "b", 1, 5, "t", None, None, None, None, "t", 200, 50)],
                              "id long, name string, connection_id long, destination_connection_id long, "
                              "source_table string, watermark_column string, merge_key_column string, "
                              "target_database string, target_schema_name string, target_table string, "
                              "volume_alert_upper_pct int, volume_alert_lower_pct int")
    t = dt.datetime(2024, 1, 1)
    sched = spark.createDataFrame([(1, 1, "5 * * * *", t), (2, 1, "9 * * * *", t + dt.timedelta(1))],
                                  "id long, pipeline_id long, cron_expression string, created_at timestamp_ntz")
    ex = {r["pipeline_id"]: r for r in C.export_pipelines(p, conns(spark), sched).collect()}
    assert ex[1]["cron_expression"] == "9 * * * *" and ex[2]["cron_expression"] == "0 2 * * *"
    assert ex[1]["destination_connection_name"] == "wh" and ex[2]["destination_connection_name"] is None
    other = spark.createDataFrame([(101, "src")], "id long, name string")
    res = {r["pipeline_id"]: r for r in C.resolve_connections(C.export_pipelines(p, conns(spark), sched), other).collect()}
    assert res[1]["status"] == "missing_destination" and res[2]["status"] == "ok"
    assert res[2]["connection_id"] == 101
    js = C.export_json(C.export_pipelines(p, conns(spark), sched)).first()["config_json"]
    assert '"depends_on_names":[]' in js and '"watermark_column":null' in js


def test_forest_fast_path_matches_layering(spark):
    import random
    from tidemark.operators import graph as G
    rnd = random.Random(3)
    n = 300
    edges = [(i, rnd.randrange(1, i)) for i in range(2, n + 1) if rnd.random() < 0.8]
    # a cycle with a tail: 1001 <-> 1002, 1003 below it
    edges += [(1001, 1002), (1002, 1001), (1003, 1002)]
    p = pipes(spark, list(range(1, n + 1)) + [1001, 1002, 1003, 1004])
    d = deps(spark, edges)
    fast = {r["pipeline_id"]: (r["level"], r["in_cycle"]) for r in G.dependency_levels(p, d).collect()}
    # the same graph plus one harmless second prerequisite forces the layered path
    slow_d = deps(spark, edges + [(1004, 1), (1004, 2)])
    slow = {r["pipeline_id"]: (r["level"], r["in_cycle"])
            for r in G.dependency_levels(p, slow_d).collect()}
    for k in fast:
        if k != 1004:
            assert fast[k] == slow[k], k
    assert fast[1001] == (None, True) and fast[1003] == (None, True) and fast[1004] == (0, False)
    # brute force depth
    parent = {a: b for a, b in edges if a <= n}
    def depth(v):
        k = 0
        while v in parent:
            v, k = parent[v], k + 1
        return k
    assert all(fast[v] == (depth(v), False) for v in range(1, n + 1))


def test_listings_follow_the_reference_order(spark):
    import datetime as dt
    c = spark.createDataFrame(
        [(1, "a", "postgresql", dt.datetime(2024, 1, 1), True),
         (2, "b", "snowflake", dt.datetime(2024, 3, 1), True),
         (3, "c", "postgresql", None, False)],
        "id long, name string, db_type string, created_at timestamp_ntz, is_active boolean")
    assert [r["id"] for r in C.list_connections(c).collect()] == [3, 2, 1]  # nulls first, then newest


def test_levels_of_a_deep_graph_with_several_prerequisites(spark):
    n = 70
    p = pipes(spark, range(1, n + 3))
    d = deps(spark, [(k, k - 1) for k in range(2, n + 1)] + [(n + 1, 1), (n + 1, 2)])
    lv = {r["pipeline_id"]: (r["level"], r["in_cycle"]) for r in G.dependency_levels(p, d).collect()}
    assert lv == {**{k: (k - 1, False) for k in range(1, n + 1)}, n + 1: (2, False), n + 2: (0, False)}


def test_levels_match_longest_paths_on_random_graphs(spark, monkeypatch):
    """Chains, layers, diamonds and cycles against a plain fixpoint; long
    chains beside branches take about log2 of their length rounds."""
    import random
    from tidemark.operators import graph
    r = random.Random(6)
    for case in range(4):
        n = 60
        edges = {(r.randrange(1, n), r.randrange(n)) for _ in range(70)} if case == 3 else set()
        if case < 3:
            edges = {(i, i - 1) for i in range(1, 50)} | {(i, r.randrange(i)) for i in range(2, n) if r.random() < 0.3 * case}
            edges |= {(55, 54), (55, 10), (58, 59), (59, 58), (57, 58)} if case else {(55, 3), (55, 9)}
        edges |= {(5, 99), (98, 5)}  # ends that are no pipelines
        want, known = {}, True
        while known:
            known = {i: max([want[p] + 1 for k, p in edges if k == i and p < n], default=0) for i in range(n)
                     if i not in want and all(p in want for k, p in edges if k == i and p < n)}
            want.update(known)
        nodes = spark.createDataFrame([(i,) for i in range(n)], "id long")
        got = graph.dependency_levels(nodes, spark.createDataFrame(sorted(edges), "pipeline_id long, depends_on_id long"))
        rows = {q["pipeline_id"]: (q["level"], q["in_cycle"]) for q in got.collect()}
        assert rows == {i: (want.get(i), i not in want) for i in range(n)}
    written = []
    real = graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, path, **k: written.append(path) or real(df, path, **k))
    chain = [(i, i - 1) for i in range(1, 200)] + [(150, 20), (90, 3)]
    got = graph.dependency_levels(spark.range(200), spark.createDataFrame(chain, "pipeline_id long, depends_on_id long"))
    assert got.agg({"level": "max"}).first()[0] == 199 and len(written) <= 14
