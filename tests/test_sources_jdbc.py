"""JDBC settings, predicates and statements; no database is started."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import sinks
from tidemark.sources import readers as RD
from tidemark.sources.connection import Connection

T0 = dt.datetime(2024, 1, 1)
MY = Connection("mysql", host="h", db_name="d")  # its quoting and functions are Spark SQL's too


def test_connection_urls_and_warehouse_options():
    pg = Connection("postgresql", host="h", db_name="d", user="u", password="p")
    assert pg.jdbc_url() == "jdbc:postgresql://h:5432/d"
    assert pg.jdbc_options()["fetchsize"] == "10000"
    assert pg.jdbc_options()["preferTimestampNTZ"] == "true"
    assert Connection("sqlserver", host="h", db_name="d").jdbc_url().endswith(";databaseName=d")
    assert "password=" not in repr(pg) and "'p'" not in repr(pg)
    wh = Connection("snowflake", host="acct", warehouse="WH", role="R")
    o = wh.warehouse_options("analytics", None, "orders")
    assert o["sfURL"] == "acct.snowflakecomputing.com" and o["sfSchema"] == "PUBLIC"
    assert o["sfDatabase"] == "ANALYTICS" and o["dbtable"] == "ORDERS" and o["sfWarehouse"] == "WH"
    with pytest.raises(ValueError):
        Connection("snowflake").jdbc_url()


def test_catalog_queries_per_database():
    assert "table_schema = 'public'" in RD.catalog_query(Connection("postgresql"))
    assert "table_schema = 'dbo'" in RD.catalog_query(Connection("sqlserver"))
    assert "table_schema = 'shop'" in RD.catalog_query(Connection("mysql", db_name="shop"))
    assert "owner = 'APP'" in RD.catalog_query(Connection("oracle", user="app"))
    assert "table_schema = 'x''y'" in RD.catalog_query(Connection("postgresql"), "x'y")


def covered(df, predicates):
    """Rows that each predicate takes; every row must be taken once."""
    sizes = [df.where(p).count() for p in predicates]
    assert sum(sizes) == df.count()
    return sizes


def test_ranges_cover_every_row_once(spark):
    df = spark.createDataFrame([(i, T0 + dt.timedelta(hours=i)) for i in range(500, 1000)] + [(None, None)], "id int, at timestamp_ntz")
    sizes = covered(df, RD.split_predicates(MY, "id", T.IntegerType(), "range", {"lo": 500, "hi": 999}, 8))
    assert len(sizes) == 8 and max(sizes) <= 64  # an increment of new keys is spread over its own range
    at = {"lo": T0 + dt.timedelta(hours=500), "hi": T0 + dt.timedelta(hours=999)}
    assert max(covered(df, RD.split_predicates(MY, "at", T.TimestampNTZType(), "range", at, 5))) <= 102


def test_remainders_and_hashes_cover_every_row_once(spark):
    ids = list(range(1, 901)) + [10_007 * i for i in range(1, 101)] + [-5, None]
    df = spark.createDataFrame([(i, None if i is None else f"key-{i}") for i in ids], "id int, name string")
    mod = covered(df, RD.split_predicates(MY, "id", T.IntegerType(), "mod", {"lo": -5, "hi": 10 ** 6}, 8))
    assert max(mod) <= 130 and mod[-1] == 1
    text = covered(df, RD.split_predicates(MY, "name", T.StringType(), "range", {"lo": "a", "hi": "z"}, 8))
    assert max(text) <= 200 and text[-1] == 1


def test_splits_follow_the_size_of_the_increment():
    assert RD.split_count(0) == RD.split_count(9_999) == 1 and RD.split_count(50_000) == 5
    assert RD.split_count(5_000_000) == 8 and RD.split_count(10 ** 9) == 1000
    assert RD.split_predicates(MY, "id", T.IntegerType(), "range", {"lo": None, "hi": None}, 8) is None
    assert RD.split_predicates(Connection("other"), "name", T.StringType(), "range", {"lo": "a", "hi": "b"}, 8) is None


def test_dialects():
    ms, ora, pg = (Connection(x, host="h", db_name="d", user="app") for x in ("sqlserver", "oracle", "postgresql"))
    assert RD.mod_predicates(ms, "id", 2)[0] == 'ABS("id" % 2) = 0' and "MOD" in RD.mod_predicates(ora, "id", 2)[0]
    assert ms.add_column("T", "C", "TEXT") == 'ALTER TABLE T ADD "C" NVARCHAR(MAX)'
    assert ora.add_column("T", "C", "TEXT") == 'ALTER TABLE T ADD ("C" CLOB)'
    assert pg.add_column("T", "C", "FLOAT") == 'ALTER TABLE T ADD COLUMN "C" DOUBLE PRECISION'
    assert pg.change_type("T", "C", "INTEGER") == 'ALTER TABLE T ALTER COLUMN "C" TYPE INTEGER USING "C"::INTEGER'
    assert ora.change_type("T", "C", "DATE") == 'ALTER TABLE T MODIFY ("C" DATE)'
    assert MY.change_type("T", "C", "DATE") == "ALTER TABLE T MODIFY COLUMN `C` DATE"
    assert ms.change_type("T", "C", "DATE") == 'ALTER TABLE T ALTER COLUMN "C" DATE'


def test_a_table_is_missing_only_when_the_catalog_says_so(monkeypatch):
    asked = []

    class Reader:
        def __init__(self, answer):
            self.answer = answer
        format = options = lambda self, *a, **k: self
        def option(self, _, query):
            asked.append(query)
            return self
        def load(self):
            if isinstance(self.answer, Exception):
                raise self.answer
            return self
        def first(self):
            return self.answer

    class Spark:
        pass
    spark = Spark()
    spark.read = Reader((0,))
    assert sinks.jdbc_table_schema(spark, MY, "s.t") is None
    assert asked == ["SELECT COUNT(*) AS n FROM information_schema.tables WHERE UPPER(table_name) = 'T' AND UPPER(table_schema) = 'S'"]
    spark.read = Reader(RuntimeError("connection refused"))
    with pytest.raises(RuntimeError):  # not taken for a missing table
        sinks.jdbc_table_schema(spark, MY, "t")
    assert "all_tables" in sinks.exists_query(Connection("oracle", user="app"), "t")


def test_run_is_noted_in_the_transaction_of_its_rows():
    got = sinks.apply_statements(MY, "T", "T_STAGE", "id", ["id", "v"], "4:7")
    assert len(got) == 3 and got[0].startswith("DELETE FROM T") and got[2] == "INSERT INTO T_RUNS (run_tag) VALUES ('4:7')"
    assert sinks.apply_statements(MY, "T", "T_STAGE", None, ["id"]) == ["INSERT INTO T (`id`) SELECT `id` FROM T_STAGE"]


def test_heal_status_text():
    from tidemark.operators.schema import heal_status
    assert heal_status(None) == "auto_resolved"
    assert heal_status("x" * 300) == "error: " + "x" * 200


@pytest.mark.parametrize("kind, names", [
    ("mysql", ("int", "datetime", "double", "varchar", "tinyint")), ("sqlserver", ("int", "datetime2", "float", "nvarchar", "bit")),
    ("oracle", ("number", "timestamp(6)", "binary_double", "varchar2", "char")),
    ("postgresql", ("integer", "timestamp without time zone", "double precision", "character varying", "boolean"))])
def test_native_names_map_as_the_types_they_are_read_as(spark, monkeypatch, kind, names):
    from tidemark.functions.types import target_type_for
    from tidemark.plans import load as L
    df = spark.createDataFrame([], "a int, b timestamp_ntz, c double, d string, e boolean")
    listed = [{"column_name": c.upper(), "data_type": t} for c, t in zip(df.columns, names)]
    monkeypatch.setattr(L, "declared_columns", lambda *a: listed)
    spec = L.LoadSpec(pipeline_id=1, source=Connection(kind, host="h", db_name="d"), source_table="s.t", target_path="/t", mode="full")
    got = [target_type_for(t) for _, t in L._declared_defs(spark, spec, df)]
    text = "VARCHAR(500)" if names[3] in ("varchar", "character varying") else "TEXT"
    assert got == ["INTEGER", "TIMESTAMP", "FLOAT", text, "BOOLEAN"]


def test_literals_per_database():
    import datetime as dt
    from tidemark.sources.readers import _sql_literal, split_predicates
    from pyspark.sql import types as T
    d, t = dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5)
    assert _sql_literal(d, "sqlserver") == "CAST('2024-01-02' AS date)" and _sql_literal(d, "mysql") == "DATE '2024-01-02'"
    assert _sql_literal(t, "sqlserver") == "CAST('2024-01-02T03:04:05.000000' AS datetime2)"
    got = split_predicates(Connection("sqlserver", host="h"), "K", T.DateType(), "range",
                           {"lo": d, "hi": dt.date(2024, 2, 2), "n": 9}, 3)
    assert len(got) == 3 and all("CAST('2024-" in p and "DATE '" not in p for p in got)


def test_a_table_of_another_schema_is_not_ours():
    from tidemark.plans.sinks import exists_query
    assert "UPPER(table_schema) = 'SHOP'" in exists_query(Connection("mysql", db_name="shop"), "t")
    assert "UPPER(table_schema) = 'DBO'" in exists_query(Connection("sqlserver"), "t")
    assert "UPPER(table_schema) = 'X'" in exists_query(Connection("postgresql"), "x.t")
