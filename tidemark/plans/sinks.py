"""Writers for targets other than the versioned Parquet table.

* Warehouse (K2, K11): the warehouse's Spark connector
  (``format("snowflake")``) bulk-loads through its own stage; an upsert is
  a staged append followed by one set-based statement run by the connector
  (``postactions``) — never a literal key list.
* JDBC (K2, K3, K4): Spark's JDBC sink only appends or overwrites, so
  ``jdbc_upsert`` writes the batch to a staging table in parallel and then
  runs the set-based statements of ``upsert_statements`` on the database in
  one transaction (one round trip, no rows through the driver).
* Parquet append (K5) and drift-log append (K9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.sources.connection import WAREHOUSE_FORMAT, Connection


def append_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def log_drift(events: DataFrame, path: str) -> None:
    """Append drift events to the drift log (K9)."""
    append_parquet(events, path)


def upsert_statements(target: str, staging: str, key: str, columns: Sequence[str],
                      mode: str = "delete_insert", quote=lambda c: c) -> list[str]:
    """Set-based SQL that applies a staged batch to a target table.

    delete_insert: delete target rows whose key is staged, insert all staged.
    last_wins: the staging table is already deduplicated per key
    (``dedup_last_wins``), so the same two statements give last-wins.
    Null keys never match in ``IN``, as in the reference.
    """
    if mode not in ("delete_insert", "last_wins"):
        raise ValueError("mode must be delete_insert or last_wins")
    k = quote(key)
    cols = ", ".join(quote(c) for c in columns)
    return [
        f"DELETE FROM {target} WHERE {k} IN (SELECT {k} FROM {staging} WHERE {k} IS NOT NULL)",
        f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {staging}",
    ]


def column_types_option(conn: Connection, types: dict[str, str]) -> str:
    """``createTableColumnTypes`` value: each column with its mapped type in
    the database's DDL spelling."""
    return ", ".join(f"`{c}` {conn.ddl_type(t)}" for c, t in types.items())


def exists_query(conn: Connection, table: str) -> str:
    """Asks the database's own catalog whether it has a table."""
    schema, _, name = table.replace('"', "").rpartition(".")
    name = name.replace("'", "''").upper()
    where = f"UPPER(table_name) = '{name}'"
    if conn.db_type == "oracle":
        owner = schema or conn.schema or conn.user
        return (f"SELECT COUNT(*) AS n FROM all_tables WHERE {where}"
                + (f" AND owner = '{owner.upper()}'" if owner else ""))
    # unnamed, the schema is the one that the database itself would look in
    schema = schema or conn.schema or {"mysql": conn.db_name, "sqlserver": "dbo", "postgresql": "public"}.get(conn.db_type)
    return (f"SELECT COUNT(*) AS n FROM information_schema.tables WHERE {where}"
            + (f" AND UPPER(table_schema) = '{schema.upper()}'" if schema else ""))


def jdbc_table_schema(spark, conn: Connection, table: str):
    """The table's schema (no rows read), or None when the database's catalog
    says that it does not exist. Any other failure is raised: a table that
    cannot be reached just now is not a missing one."""
    def ask(query):
        return spark.read.format("jdbc").options(**conn.jdbc_options()).option("query", query).load()
    if not ask(exists_query(conn, table)).first()[0]:
        return None
    return ask(f"SELECT * FROM {table} WHERE 1 = 0").schema


def write_jdbc_staging(df: DataFrame, conn: Connection, staging_table: str,
                       batchsize: int = 10000, num_partitions: int | None = None,
                       column_types: dict[str, str] | None = None) -> None:
    """Replace the staging table with the batch (parallel inserts). It is
    recreated each time, with the target's column types when given."""
    opts = conn.jdbc_options()
    opts.update({"dbtable": staging_table, "batchsize": str(batchsize), "truncate": "false"})
    if column_types:
        opts["createTableColumnTypes"] = column_types_option(
            conn, {c: t for c, t in column_types.items() if c in df.columns})
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").options(**opts).mode("overwrite").save()


def warehouse_columns_query(schema: str, table: str) -> str:
    return ("SELECT column_name, data_type, ordinal_position, numeric_precision, numeric_scale "
            f"FROM information_schema.columns WHERE table_schema = '{schema.upper()}' "
            f"AND table_name = '{table.upper()}'")


def warehouse_columns(spark, conn: Connection, database: str, schema: str | None,
                      table: str) -> list[tuple[str, str, int]]:
    """(name, type, position) of a warehouse table's columns; none if it is
    missing. As many rows as the table has columns."""
    opts = conn.warehouse_options(database, schema, table)
    opts.pop("dbtable")
    rows = (spark.read.format(WAREHOUSE_FORMAT).options(**opts)
            .option("query", warehouse_columns_query(opts["sfSchema"], table)).load().collect())
    return [(r[0], f"{r[1]}({r[3]},{r[4]})" if r[3] is not None else r[1], int(r[2])) for r in rows]


def warehouse_plan(conn: Connection, database: str, schema: str | None, table: str, columns: dict[str, str],
                   key: str | None = None, have: Sequence[str] | None = None, run_tag: str | None = None,
                   staging_table: str | None = None) -> dict[str, str]:
    """Connector options of one load: the batch goes to a staging table, and
    one set of statements runs around it. ``have`` are the target's columns
    (None: it is missing). Before: create the target with the mapped types, or
    add the columns it lacks. After: replace the rows of the staged keys, or
    append without a key; with ``run_tag``, only if that was not applied
    before, so a replay changes nothing, rows without a key included."""
    opts = conn.warehouse_options(database, schema, table)
    fq = f"{opts['sfDatabase']}.{opts['sfSchema']}"
    target = f"{fq}.{opts['dbtable']}"
    stage = (staging_table or f"{table}_STAGE").upper()
    ddl = {c: f"{conn.quote(c)} {t}" for c, t in columns.items()}
    if have is None:
        before = [f"CREATE TABLE IF NOT EXISTS {target} ({', '.join(ddl.values())})"]
    else:
        known = {c.upper() for c in have}
        before = [f"ALTER TABLE {target} ADD COLUMN {ddl[c]}" for c in columns if c.upper() not in known]
    if key:
        after = upsert_statements(target, f"{fq}.{stage}", key, list(columns), quote=conn.quote)
    else:
        cols = ", ".join(conn.quote(c) for c in columns)
        after = [f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {fq}.{stage}"]
    if run_tag is not None:
        runs, tag = f"{target}_RUNS", run_tag.replace("'", "''")
        before.append(f"CREATE TABLE IF NOT EXISTS {runs} (run_tag VARCHAR(200))")
        fresh = f"NOT EXISTS (SELECT 1 FROM {runs} WHERE run_tag = '{tag}')"
        after = [f"{s} {'AND' if s.startswith('DELETE') else 'WHERE'} {fresh}" for s in after]
        after.append(f"INSERT INTO {runs} (run_tag) SELECT '{tag}' WHERE {fresh}")
    opts["dbtable"] = stage
    if before:
        opts["preactions"] = "; ".join(before)
    opts["postactions"] = "; ".join(["BEGIN", *after, "COMMIT"])
    return opts


def warehouse_writer(df: DataFrame, conn: Connection, database: str, schema: str | None,
                     table: str, key: str | None = None, staging_table: str | None = None,
                     types: dict[str, str] | None = None, have: Sequence[str] | None = (),
                     run_tag: str | None = None):
    """A configured ``DataFrameWriter`` for the warehouse connector: see
    ``warehouse_plan``. The connector jar must be on the classpath; ``.save()``
    is left to the caller. With the default ``have`` no DDL is run."""
    if conn.db_type != WAREHOUSE_FORMAT:
        raise ValueError("not a warehouse connection")
    columns = {c: (types or {}).get(c, "TEXT") for c in df.columns}
    opts = warehouse_plan(conn, database, schema, table, columns, key,
                          list(columns) if have == () else have, run_tag, staging_table)
    return df.write.format(WAREHOUSE_FORMAT).options(**opts).mode("overwrite")


def read_column(spark, conn: Connection, table: str, column: str) -> DataFrame:
    """One column of a target table, for what a type change would do to it."""
    query = f"SELECT {conn.quote(column)} FROM {table}"
    if conn.is_warehouse:
        opts = conn.warehouse_options(conn.db_name, None, table.rpartition(".")[2])
        opts.pop("dbtable")
        return spark.read.format(WAREHOUSE_FORMAT).options(**opts).option("query", query).load()
    return spark.read.format("jdbc").options(**conn.jdbc_options()).option("query", query).load()


def execute_warehouse(spark, conn: Connection, statements: Sequence[str]) -> None:
    """Run statements on the warehouse through its connector, which runs them
    before an empty batch is written to a table of its own."""
    opts = conn.warehouse_options(conn.db_name, None, "TIDEMARK_STATEMENTS")
    opts["preactions"] = "; ".join(statements)
    (spark.createDataFrame([], "done boolean").write.format(WAREHOUSE_FORMAT).options(**opts).mode("overwrite").save())


def execute_jdbc(spark, conn: Connection, statements: Sequence[str]) -> list[int]:
    """Run statements in one transaction on the database (rolled back on
    error); returns the update counts. Only SQL text crosses the driver."""
    jvm = spark._jvm  # classic sessions: DML through the JVM's JDBC driver
    opts = conn.jdbc_options()
    props = jvm.java.util.Properties()
    for k in ("user", "password"):
        if k in opts:
            props.setProperty(k, opts[k])
    if "driver" in opts:
        jvm.java.lang.Class.forName(opts["driver"])
    c = jvm.java.sql.DriverManager.getConnection(opts["url"], props)
    try:
        c.setAutoCommit(False)
        st = c.createStatement()
        counts = [int(st.executeUpdate(sql)) for sql in statements]
        c.commit()
        return counts
    except Exception:
        c.rollback()
        raise
    finally:
        c.close()


def jdbc_upsert(df: DataFrame, conn: Connection, table: str, key: str | None,
                staging_table: str | None = None, mode: str = "delete_insert",
                order_cols: Sequence[str] = (), num_partitions: int | None = None,
                column_types: dict[str, str] | None = None, run_tag: str | None = None) -> dict:
    """Upsert a batch into a JDBC table.

    With ``run_tag`` the applied runs are kept in a table of their own: the
    tag is inserted in the same transaction as the rows, under a primary key,
    so a run that is replayed changes nothing.

    The batch goes to a staging table (parallel inserts); then one
    transaction deletes the target rows whose key is staged and inserts the
    staged rows. ``last_wins`` deduplicates the batch first, so the same two
    statements give last-wins. A missing target is created from the batch's
    schema; without a key the batch is appended.
    """
    spark = df.sparkSession
    opts = conn.jdbc_options()
    if run_tag is not None and applied(spark, conn, table, run_tag):
        return {"created": False, "deleted": 0, "inserted": 0}
    exists = jdbc_table_schema(spark, conn, table) is not None
    if key and mode == "last_wins":
        from tidemark.operators.upsert import dedup_last_wins
        df = dedup_last_wins(df, key, list(order_cols))
    if not exists:  # created empty: the rows come by the same transaction
        w = df.limit(0).write.format("jdbc").options(**opts).option("dbtable", table)
        if column_types:
            w = w.option("createTableColumnTypes", column_types_option(
                conn, {c: t for c, t in column_types.items() if c in df.columns}))
        w.mode("append").save()
    stage = staging_table or f"{table}_STAGE"
    write_jdbc_staging(df, conn, stage, num_partitions=num_partitions, column_types=column_types)
    stmts = apply_statements(conn, table, stage, key, df.columns, run_tag)
    counts = execute_jdbc(spark, conn, stmts)
    return {"created": not exists, "deleted": counts[0] if key else 0,
            "inserted": counts[1] if key else counts[0]}


def apply_statements(conn: Connection, table: str, stage: str, key: str | None, columns: Sequence[str],
                     run_tag: str | None = None) -> list[str]:
    """One transaction: the staged rows replace those of their keys (or are
    appended without a key) and the run is noted."""
    cols = ", ".join(conn.quote(c) for c in columns)
    out = (upsert_statements(table, stage, key, columns, "delete_insert", conn.quote) if key
           else [f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {stage}"])
    if run_tag is not None:
        tag = run_tag.replace("'", "''")
        out.append(f"INSERT INTO {table}_RUNS (run_tag) VALUES ('{tag}')")
    return out


def applied(spark, conn: Connection, table: str, run_tag: str) -> bool:
    """Whether the run was applied before; makes the table of runs if needed."""
    runs = f"{table}_RUNS"
    if jdbc_table_schema(spark, conn, runs) is None:
        execute_jdbc(spark, conn, [f"CREATE TABLE {runs} (run_tag VARCHAR(200) NOT NULL PRIMARY KEY)"])
        return False
    tag = run_tag.replace("'", "''")
    return bool(spark.read.format("jdbc").options(**conn.jdbc_options())
                .option("query", f"SELECT COUNT(*) AS n FROM {runs} WHERE run_tag = '{tag}'").load().first()[0])
