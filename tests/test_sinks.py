import os

import pytest

from tidemark.plans import sinks
from tidemark.sources.connection import Connection


def test_upsert_statements_are_set_based():
    stmts = sinks.upsert_statements("DB.S.T", "DB.S.T_STAGE", "ID", ["ID", "NAME"])
    assert stmts[0] == ("DELETE FROM DB.S.T WHERE ID IN "
                        "(SELECT ID FROM DB.S.T_STAGE WHERE ID IS NOT NULL)")
    assert stmts[1] == "INSERT INTO DB.S.T (ID, NAME) SELECT ID, NAME FROM DB.S.T_STAGE"
    with pytest.raises(ValueError):
        sinks.upsert_statements("a", "b", "k", ["k"], mode="merge")


def test_warehouse_writer_options(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    wh = Connection("snowflake", host="acct", user="u", password="p", schema="raw")
    opts = {}
    real = df.write.__class__.options

    def spy(self, **o):
        opts.update(o)
        return real(self, **o)
    df.write.__class__.options = spy
    try:
        sinks.warehouse_writer(df, wh, "analytics", None, "orders", key="id")
    finally:
        df.write.__class__.options = real
    assert opts["dbtable"] == "ORDERS_STAGE" and opts["sfSchema"] == "RAW" and "preactions" not in opts
    assert opts["postactions"].startswith('BEGIN; DELETE FROM ANALYTICS.RAW.ORDERS WHERE "id" IN')
    with pytest.raises(ValueError):
        sinks.warehouse_writer(df, Connection("postgresql"), "d", None, "t")


def test_warehouse_plan_of_first_drift_and_append_loads():
    wh = Connection("snowflake", host="acct")
    cols = {"ID": "INTEGER", "NAME": "TEXT"}
    first = sinks.warehouse_plan(wh, "db", None, "t", cols, "ID", None)
    assert first["preactions"] == 'CREATE TABLE IF NOT EXISTS DB.PUBLIC.T ("ID" INTEGER, "NAME" TEXT)'
    drift = sinks.warehouse_plan(wh, "db", "s", "t", cols, "ID", ["id"])
    assert drift["preactions"] == 'ALTER TABLE DB.S.T ADD COLUMN "NAME" TEXT' and drift["dbtable"] == "T_STAGE"
    assert drift["postactions"].endswith('INSERT INTO DB.S.T ("ID", "NAME") SELECT "ID", "NAME" FROM DB.S.T_STAGE; COMMIT')
    append = sinks.warehouse_plan(wh, "db", "s", "t", cols, None, ["ID", "NAME"], "4:7")
    assert "WHERE NOT EXISTS (SELECT 1 FROM DB.S.T_RUNS WHERE run_tag = '4:7')" in append["postactions"]


def test_run_load_into_the_warehouse(spark, tmp, monkeypatch):
    import datetime as dt
    from tidemark.plans.load import LoadSpec, run_load
    from tidemark.sources.readers import ParquetSource
    at = dt.datetime(2024, 1, 1)
    (spark.createDataFrame([(1, "a", at), (1, "b", at + dt.timedelta(hours=1))], "id int, name string, updated_at timestamp_ntz")
     .write.parquet(os.path.join(tmp, "items.parquet")))
    sent = []

    class Writer:
        def __init__(self, df, have, types, key):
            self.got = (sorted(map(tuple, df.select("ID", "NAME").collect())), have, types, key)
        def save(self):
            sent.append(self.got)
    monkeypatch.setattr(sinks, "warehouse_writer",
                        lambda df, conn, db, schema, table, key, types, have, run_tag: Writer(df, have, types, key))
    monkeypatch.setattr(sinks, "warehouse_columns", lambda *a: have)
    spec = LoadSpec(pipeline_id=1, source=ParquetSource(tmp), source_table="items", mode="full", upsert="last_wins",
                    target_connection=Connection("snowflake", host="acct", db_name="db"))
    have = []
    run_load(spark, spec, at, run_id=1)
    assert sent[-1] == ([(1, "b")], None, {"ID": "INTEGER", "NAME": "TEXT", "UPDATED_AT": "TIMESTAMP"}, "ID")
    have = [("ID", "NUMBER(38,0)", 1), ("OLD", "TEXT", 2), ("UPDATED_AT", "TIMESTAMP_NTZ", 3)]
    r = run_load(spark, spec, at, run_id=2, drift_log_path=os.path.join(tmp, "drift"))
    assert sorted((d["column_name"], d["change_type"]) for d in r.drift) == [("NAME", "column_added"), ("OLD", "column_dropped")]
    assert sent[-1][1] == ["ID", "OLD", "UPDATED_AT"] and spark.read.parquet(os.path.join(tmp, "drift")).count() == 2


def test_log_drift_appends(spark, tmp):
    path = os.path.join(tmp, "drift")
    ev = spark.createDataFrame([("t", "A", "column_added")], "table_name string, column_name string, change_type string")
    sinks.log_drift(ev, path)
    sinks.log_drift(ev, path)
    assert spark.read.parquet(path).count() == 2


def test_ddl_spelling_per_database():
    assert Connection("postgresql").ddl_type("TIMESTAMP_TZ") == "TIMESTAMPTZ"
    assert Connection("oracle").ddl_type("VARCHAR(500)") == "VARCHAR2(500)"
    assert Connection("sqlserver").ddl_type("BOOLEAN") == "BIT"
    assert Connection("snowflake").ddl_type("NUMERIC(18,4)") == "NUMERIC(18,4)"
    opt = sinks.column_types_option(Connection("derby"), {"NAME": "TEXT", "N": "INTEGER"})
    assert opt == "`NAME` VARCHAR(32672), `N` INTEGER"


def drift(column, change, status="pending_review"):
    return {"table_name": "T", "column_name": column, "change_type": change, "old_definition": "INTEGER",
            "new_definition": "NUMERIC(18,4)", "status": status}


def test_a_target_that_cannot_take_the_batch_ends_the_load(spark):
    from pyspark.sql import types as T
    from tidemark.plans.load import refuse_losses
    staged = spark.createDataFrame([], "ID int, X decimal(18,4), N int, S string")
    target = T.StructType([T.StructField("ID", T.IntegerType()), T.StructField("x", T.IntegerType()),
                           T.StructField("N", T.LongType()), T.StructField("S", T.StringType())])
    refuse_losses([], staged, target)
    refuse_losses([drift("Y", "column_added", "auto_resolved"), drift("Z", "column_dropped")], staged, target)
    refuse_losses([drift("N", "type_changed")], staged, target)  # the column is wider
    for bad in (drift("Y", "column_added", "error: no privilege"), drift("X", "type_changed"), drift("x", "type_changed")):
        with pytest.raises(ValueError):
            refuse_losses([bad], staged, target)
    with pytest.raises(ValueError):  # a type that is not known holds nothing for sure
        refuse_losses([drift("X", "type_changed")], staged, T.StructType([]))


def test_database_load_stops_before_any_row(spark, tmp, monkeypatch):
    """A failed ADD COLUMN and a type change both end the load with the drift
    in the log and no statement on rows."""
    import datetime as dt
    from pyspark.sql import types as T
    from tidemark.plans import load as L
    from tidemark.sources.readers import ParquetSource
    applied, ddl = [], []

    def execute(_, conn, statements):
        ddl.extend(statements)
        if any("ADD COLUMN" in s for s in statements):
            raise RuntimeError("permission denied")
    monkeypatch.setattr(sinks, "execute_jdbc", execute)
    monkeypatch.setattr(sinks, "jdbc_upsert", lambda *a, **k: applied.append(a))
    for n, (have, why) in enumerate([("ID int, NAME string", "permission"), ("ID int, NAME string, AMOUNT int", "types")]):
        schema = spark.createDataFrame([], have).schema
        monkeypatch.setattr(sinks, "jdbc_table_schema", lambda *a, s=schema: s)
        root = os.path.join(tmp, str(n))
        (spark.createDataFrame([(1, "a", 12.75)], "id int, name string, amount double")
         .write.parquet(os.path.join(root, "items.parquet")))
        spec = L.LoadSpec(pipeline_id=1, source=ParquetSource(root), source_table="items", mode="full", merge_key="id",
                          target_connection=Connection("postgresql", host="h", db_name="d"))
        with pytest.raises(ValueError):
            L.run_load(spark, spec, dt.datetime(2024, 1, 1), run_id=n, drift_log_path=os.path.join(root, "drift"))
        assert spark.read.parquet(os.path.join(root, "drift")).count() == 1 and not applied
    monkeypatch.setattr(sinks, "jdbc_table_schema", lambda *a: spark.createDataFrame([], "ID int, NAME string, AMOUNT double").schema)
    L.run_load(spark, spec, dt.datetime(2024, 1, 1), run_id=9)
    assert len(applied) == 1 and applied[0][0].columns == ["ID", "NAME", "AMOUNT"]


def test_keyed_replay_on_the_warehouse_changes_nothing():
    wh = Connection("snowflake", host="acct")
    got = sinks.warehouse_plan(wh, "db", "s", "t", {"ID": "INTEGER"}, "ID", ["ID"], "4:7")
    fresh = "NOT EXISTS (SELECT 1 FROM DB.S.T_RUNS WHERE run_tag = '4:7')"
    begin, delete, insert, note, commit = got["postactions"].split("; ")
    assert delete.endswith(f"IS NOT NULL) AND {fresh}") and insert.endswith(f"WHERE {fresh}") and note.endswith(fresh)
    assert "CREATE TABLE IF NOT EXISTS DB.S.T_RUNS" in got["preactions"]


def test_type_change_on_database_and_warehouse(spark, monkeypatch):
    import datetime as dt
    from tidemark.plans.load import resolve_drift
    log = spark.createDataFrame([(1, 1, dt.datetime(2024, 1, 1), "AMOUNT", "type_changed", "TEXT", "INTEGER", "pending_review")],
                                "id long, pipeline_id long, detected_at timestamp_ntz, column_name string, "
                                "change_type string, old_definition string, new_definition string, status string")
    done = []
    monkeypatch.setattr(sinks, "execute_jdbc", lambda s, c, st: done.append(("db", st)))
    monkeypatch.setattr(sinks, "execute_warehouse", lambda s, c, st: done.append(("wh", st)))
    for conn in (Connection("postgresql", host="h"), Connection("snowflake", host="a", db_name="d")):
        monkeypatch.setattr(sinks, "read_column", lambda s, *a: s.createDataFrame([("1",), ("x",)], "AMOUNT string"))
        with pytest.raises(ValueError):
            resolve_drift(spark, log, 1, "apply_type_change", 9, dt.datetime(2024, 1, 2), target_connection=conn, target_table="T")
        monkeypatch.setattr(sinks, "read_column", lambda s, *a: s.createDataFrame([("1",), (None,)], "AMOUNT string"))
        resolve_drift(spark, log, 1, "apply_type_change", 9, dt.datetime(2024, 1, 2), target_connection=conn, target_table="T")
    assert [k for k, _ in done] == ["db", "wh"] and 'ALTER COLUMN "AMOUNT"' in done[1][1][0]


def test_types_that_warehouse_columns_hold():
    from pyspark.sql import types as T
    from tidemark.functions.types import held_type
    assert held_type("NUMBER(10,2)") == T.DecimalType(10, 2) and held_type("INTEGER") == T.DecimalType(38, 0)
    assert held_type("NUMBER") == T.DecimalType(38, 0) and held_type("VARCHAR(500)") == T.StringType()
    assert held_type("double precision") == T.DoubleType() and held_type("GEOGRAPHY") is None
