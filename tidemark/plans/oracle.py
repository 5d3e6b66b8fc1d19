"""DuckDB SQL for every registered query, over the same driver tables.

The derived views of ``tidemark.plans.views`` are repeated here as CTEs so
each statement is self-contained.
"""

from __future__ import annotations

from tidemark.functions.types import TYPE_MAP
from tidemark.operators.schema import WATERMARK_NAMES, WATERMARK_TYPES
from tidemark.plans.views import TABLES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(expr: str, mapping: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def _map_type(expr: str) -> str:
    return _case(expr, TYPE_MAP, "'TEXT'")


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

RUNS = """runs AS (
  SELECT event_id AS run_id, user_id % 10 AS pipeline_id, ts AS started_at,
         CASE WHEN event_type = 'error' THEN 'failed'
              WHEN event_type = 'view' THEN 'running' ELSE 'complete' END AS status,
         CASE WHEN event_type = 'view' THEN NULL
              ELSE ts + to_seconds(CAST(event_id % 600 AS BIGINT)) END AS ended_at,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(floor(value * 10) AS BIGINT) END AS rows_loaded
  FROM events)"""

PIPELINES = """pipelines AS (
  SELECT c_custkey AS id, c_name AS name, c_nationkey AS connection_id,
         c_custkey % 30 AS destination_connection_id, c_mktsegment AS source_table,
         CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '' ELSE 'updated_at' END
           AS watermark_column,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'id' END AS merge_key_column,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'analytics' END AS target_database,
         CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE '' END AS target_schema_name,
         lower(c_mktsegment) AS target_table,
         CAST(150 + c_custkey % 3 * 50 AS INTEGER) AS volume_alert_upper_pct,
         CAST(50 - c_custkey % 4 * 10 AS INTEGER) AS volume_alert_lower_pct,
         TIMESTAMP '2023-01-01 00:00:00' + to_seconds(c_custkey * 60) AS created_at,
         c_custkey % 7 <> 0 AS is_active
  FROM customer)"""


def _connections(name: str, where: str = "", id_shift: int = 0) -> str:
    shift = f" + {id_shift}" if id_shift else ""
    return f"""{name} AS (
  SELECT n_nationkey{shift} AS id, n_name AS name,
         CASE WHEN n_regionkey = 0 THEN 'snowflake' ELSE 'postgresql' END AS db_type,
         lower(n_name) AS host, CASE WHEN n_regionkey = 0 THEN 443 ELSE 5432 END AS port,
         lower(n_name) AS db_name, 'loader' AS db_user,
         'pw-' || CAST(n_nationkey AS VARCHAR) AS db_password,
         CASE WHEN n_regionkey = 0 THEN 'LOAD_WH' END AS snowflake_warehouse,
         CASE WHEN n_regionkey = 0 THEN 'LOADER' END AS snowflake_role,
         CASE WHEN n_regionkey = 0 AND n_nationkey % 2 = 0 THEN 'staging' END AS snowflake_schema,
         TIMESTAMP '2023-01-01 00:00:00' + to_seconds(n_nationkey * 86400) AS created_at,
         n_nationkey % 6 <> 5 AS is_active
  FROM nation {where})"""


CONNECTIONS = _connections("connections")
TARGET_CONNECTIONS = _connections("tconn", "WHERE n_regionkey <> 2", 100)

SCHEDULES = """schedules AS (
  SELECT c_custkey AS id, c_custkey AS pipeline_id,
         '0 2 * * *' AS cron_expression,
         TIMESTAMP '2023-06-01 00:00:00' + to_seconds(c_custkey * 60) AS created_at
  FROM customer WHERE c_custkey % 2 = 0),
latest_sched AS (
  SELECT pipeline_id, cron_expression FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY pipeline_id ORDER BY created_at DESC, id DESC) AS rn
    FROM schedules) WHERE rn = 1)"""

DEPS = """deps AS (
  SELECT c_custkey AS pipeline_id, c_custkey // 2 AS depends_on_id
  FROM customer WHERE c_custkey >= 2 AND c_custkey % 3 <> 0)"""


def _va(thresholds: bool) -> str:
    join = ("LEFT JOIN pipelines tp ON tp.id = s.pipeline_id" if thresholds else "")
    up = "COALESCE(tp.volume_alert_upper_pct, 200)" if thresholds else "200"
    lo = "COALESCE(tp.volume_alert_lower_pct, 50)" if thresholds else "50"
    return f"""va AS (
  SELECT run_id, pipeline_id, started_at, rows_loaded, history_runs, avg_prev, pct,
         COALESCE(history_runs > 0 AND avg_prev > 0 AND (pct < lo OR pct > up), false)
           AS volume_anomaly_flag
  FROM (
    SELECT s.*, {up} AS up, {lo} AS lo,
           CASE WHEN history_runs > 0 AND avg_prev > 0
                THEN rows_loaded / avg_prev * 100.0 END AS pct
    FROM (
      SELECT run_id, pipeline_id, started_at, rows_loaded,
             COUNT(*) OVER w AS history_runs,
             AVG(COALESCE(rows_loaded, 0)) OVER w AS avg_prev
      FROM runs WHERE status = 'complete'
      WINDOW w AS (PARTITION BY pipeline_id ORDER BY started_at, run_id
                   ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) s
    {join}))"""


RF = """rf AS (
  SELECT r.*, COALESCE(va.volume_anomaly_flag, false) AS volume_anomaly_flag
  FROM runs r LEFT JOIN va ON va.run_id = r.run_id)"""

DRIFT = """de AS (
  SELECT id, pipeline_id, detected_at, column_name, change_type,
         CASE WHEN change_type = 'type_changed' THEN 'VARCHAR(16777216)'
              WHEN change_type = 'column_dropped' THEN 'NUMBER(38,0)' END AS old_definition,
         CASE WHEN change_type = 'type_changed' THEN 'NUMERIC(18,4)'
              WHEN change_type = 'column_added' THEN 'TEXT' END AS new_definition,
         CASE WHEN change_type = 'column_added' AND id % 97 = 0 THEN 'error: column already exists'
              WHEN change_type = 'column_added' THEN 'auto_resolved'
              ELSE 'pending_review' END AS status
  FROM (
    SELECT event_id AS id, user_id AS pipeline_id, ts AS detected_at,
           'COL_' || CAST(event_id % 13 AS VARCHAR) AS column_name,
           CASE WHEN event_type IN ('click', 'view') THEN 'column_added'
                WHEN event_type IN ('error', 'signup') THEN 'type_changed'
                ELSE 'column_dropped' END AS change_type
    FROM events)),
dres AS (
  SELECT event_id AS drift_id, ts + to_seconds(3600) AS resolved_at, user_id AS resolved_by
  FROM events WHERE event_type IN ('error', 'signup', 'purchase') AND event_id % 3 = 0),
ds AS (
  SELECT d.id, d.pipeline_id, d.detected_at, d.column_name, d.change_type,
         d.old_definition, d.new_definition,
         CASE WHEN l.resolved_at IS NOT NULL THEN 'resolved' ELSE d.status END AS status,
         l.resolved_at, l.resolved_by
  FROM de d LEFT JOIN (
    SELECT drift_id, MAX(resolved_at) AS resolved_at,
           arg_max(resolved_by, resolved_at) AS resolved_by
    FROM dres GROUP BY drift_id) l ON l.drift_id = d.id)"""

_DUCK_TO_SOURCE = {
    "BIGINT": "bigint", "INTEGER": "integer", "SMALLINT": "smallint", "TINYINT": "smallint",
    "VARCHAR": "text", "DOUBLE": "double precision", "FLOAT": "real", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp without time zone",
    "TIMESTAMP WITH TIME ZONE": "timestamp with time zone", "BLOB": "bytea",
}

SCHEMA_COLS = f"""sc AS (
  SELECT DISTINCT table_name, column_name, CAST(ordinal_position AS INTEGER) AS ordinal_position,
         CASE WHEN data_type LIKE '%[]' THEN 'ARRAY'
              WHEN data_type LIKE 'DECIMAL%' THEN 'numeric'
              WHEN data_type LIKE 'STRUCT%' OR data_type LIKE 'MAP%' THEN 'jsonb'
              ELSE {_case('data_type', _DUCK_TO_SOURCE, "'text'")} END AS data_type
  FROM information_schema.columns
  WHERE table_name IN {_in(TABLES)} AND table_name NOT LIKE 'pg_%'),
sw AS (
  SELECT *, (lower(column_name) IN {_in(WATERMARK_NAMES)}
             OR (lower(data_type) IN {_in(WATERMARK_TYPES)}
                 AND lower(column_name) LIKE '%update%')) AS is_suggested_watermark
  FROM sc)"""

# A column catalog per customer, and its target. Types, their spellings and the
# names that suggest a mark are written out here, apart from the code's lists.
_NAMES = "['id','name','updated_at','modified_date','last_update_ts','amount','status','created_at','email']"
CATALOG = f"""sc AS (
  SELECT * FROM (
    SELECT CASE WHEN c_custkey % 11 = 0 THEN 'pg_' ELSE 'tab_' END || CAST(c_custkey AS VARCHAR) AS table_name,
           {_NAMES}[(c_custkey + i) % 9 + 1] AS column_name, CAST(i AS INTEGER) AS ordinal_position,
           ['integer','bigint','text','numeric','timestamp without time zone','date','boolean',
            'double precision'][(c_custkey * 7 + i * 3) % 8 + 1] AS data_type
    FROM (SELECT c_custkey, unnest(range(1, c_custkey % 6 + 4)) AS i FROM customer))
  WHERE table_name LIKE 'tab%'),
sw AS (
  SELECT *, column_name IN ('updated_at', 'modified_date') OR
            (column_name = 'last_update_ts' AND data_type IN ('timestamp without time zone', 'date'))
            AS is_suggested_watermark FROM sc)"""
CATALOG_TARGET = f"""tgt AS (
  SELECT 'tab_' || CAST(c_custkey AS VARCHAR) AS table_name,
         upper({_NAMES}[(c_custkey + i * 2) % 9 + 1]) AS column_name,
         ['NUMBER(38,0)','VARCHAR(16777216)','NUMBER(18,4)','NUMBER(10,2)','TIMESTAMP_NTZ(9)','DATE','BOOLEAN',
          'FLOAT'][(c_custkey + i * 5) % 8 + 1] AS data_type
  FROM (SELECT c_custkey, unnest(range(1, c_custkey % 4 + 5)) AS i FROM customer WHERE c_custkey % 13 <> 0))"""
_MAPPED = """CASE data_type WHEN 'integer' THEN 'INTEGER' WHEN 'bigint' THEN 'BIGINT' WHEN 'text' THEN 'TEXT'
  WHEN 'numeric' THEN 'NUMERIC(18,4)' WHEN 'timestamp without time zone' THEN 'TIMESTAMP' WHEN 'date' THEN 'DATE'
  WHEN 'boolean' THEN 'BOOLEAN' WHEN 'double precision' THEN 'FLOAT' END"""
_SAME_TYPE = """(new_definition, old_definition) IN (('INTEGER', 'NUMBER(38,0)'), ('BIGINT', 'NUMBER(38,0)'),
  ('TEXT', 'VARCHAR(16777216)'), ('NUMERIC(18,4)', 'NUMBER(18,4)'), ('TIMESTAMP', 'TIMESTAMP_NTZ(9)'),
  ('DATE', 'DATE'), ('BOOLEAN', 'BOOLEAN'), ('FLOAT', 'FLOAT'))"""

LOAD_TARGET = "load_target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00')"
LOAD_BATCH = """load_batch AS (
  SELECT o_orderkey, o_custkey, 'Z' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01 00:00:00')"""

_LINE_ORDER = ("l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, "
               "l_extendedprice DESC")


def _dedup(where: str = "") -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS rn
    FROM lineitem {where}) WHERE rn = 1 OR l_orderkey IS NULL"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_LATEST = """SELECT c.pipeline_id, c.total_runs, l.run_id AS last_run_id, l.status AS last_status,
         l.started_at AS last_run_at, l.rows_loaded AS last_rows_loaded
  FROM (SELECT pipeline_id, COUNT(*) AS total_runs FROM runs GROUP BY pipeline_id) c
  JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY pipeline_id
                                     ORDER BY started_at DESC, run_id DESC) AS rn
        FROM runs) l ON l.pipeline_id = c.pipeline_id AND l.rn = 1"""

_EXPORT = """SELECT p.id AS pipeline_id, p.name, c.name AS source_connection_name,
         dc.name AS destination_connection_name, p.source_table, p.watermark_column,
         p.merge_key_column, p.target_database, p.target_schema_name, p.target_table,
         COALESCE(s.cron_expression, '0 2 * * *') AS cron_expression,
         p.volume_alert_upper_pct, p.volume_alert_lower_pct
  FROM pipelines p
  LEFT JOIN connections c ON c.id = p.connection_id
  LEFT JOIN connections dc ON dc.id = p.destination_connection_id
  LEFT JOIN latest_sched s ON s.pipeline_id = p.id"""

_EXPORT_JSON = "SELECT pipeline_id, CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in (
    "name source_connection_name destination_connection_name source_table watermark_column merge_key_column "
    "target_database target_schema_name target_table cron_expression volume_alert_upper_pct "
    "volume_alert_lower_pct").split()) + ", 'depends_on_names': CAST([] AS VARCHAR[])}) AS VARCHAR) AS config_json FROM ex"

_VH = f"""vh AS (
  SELECT pipeline_id, CAST(started_at AS DATE) AS run_date,
         CAST(SUM(rows_loaded) AS BIGINT) AS rows_loaded, COUNT(*) AS run_count,
         MAX(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS had_failure,
         MAX(CASE WHEN volume_anomaly_flag THEN 1 ELSE 0 END) AS had_anomaly
  FROM rf WHERE started_at >= {AS_OF} - INTERVAL 30 DAY
  GROUP BY pipeline_id, CAST(started_at AS DATE))"""

_RUN_STATE = """SELECT run_id, MIN(patched_at) AS started_at, COUNT(*) AS n_patches,
       arg_max(status, seq) FILTER (WHERE status IS NOT NULL) AS status,
       arg_max(rows_loaded, seq) FILTER (WHERE rows_loaded IS NOT NULL) AS rows_loaded,
       substring(arg_max(error_message, seq) FILTER (WHERE error_message IS NOT NULL), 1, 2000)
         AS error_message,
       arg_max(phase_completed, seq) FILTER (WHERE phase_completed IS NOT NULL) AS phase_completed,
       arg_max(patched_at, seq) FILTER (WHERE status IN ('complete', 'failed', 'success'))
         AS ended_at
FROM (
  SELECT user_id AS run_id, event_id AS seq, ts AS patched_at,
         CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'purchase' THEN 'complete'
              WHEN event_type = 'view' THEN 'running' END AS status,
         CASE WHEN event_type = 'purchase' THEN CAST(floor(value * 10) AS BIGINT) END AS rows_loaded,
         CASE WHEN event_type = 'error' THEN repeat(props || ' ', 250) END AS error_message,
         CASE WHEN event_type = 'click' THEN 1 WHEN event_type = 'signup' THEN 2
              WHEN event_type = 'purchase' THEN 3 END AS phase_completed
  FROM events)
GROUP BY run_id"""

def _detect_drift() -> str:
    return _with(CATALOG, CATALOG_TARGET, f"""s AS (
  SELECT table_name, upper(column_name) AS column_name, {_MAPPED} AS new_definition
  FROM sc WHERE table_name IN (SELECT table_name FROM tgt)),
t AS (SELECT table_name, column_name, data_type AS old_definition FROM tgt),
j AS (
  SELECT COALESCE(s.table_name, t.table_name) AS table_name,
         COALESCE(s.column_name, t.column_name) AS column_name, t.old_definition, s.new_definition
  FROM s FULL OUTER JOIN t ON s.table_name = t.table_name AND s.column_name = t.column_name),
k AS (
  SELECT *, CASE WHEN old_definition IS NULL THEN 'column_added'
                 WHEN new_definition IS NULL THEN 'column_dropped'
                 WHEN NOT {_SAME_TYPE} THEN 'type_changed' END AS change_type FROM j)""") + """
SELECT table_name, column_name, change_type,
       CASE WHEN change_type <> 'column_added' THEN old_definition END AS old_definition,
       CASE WHEN change_type <> 'column_dropped' THEN new_definition END AS new_definition,
       CASE WHEN change_type = 'column_added' THEN 'auto_resolved' ELSE 'pending_review' END AS status
FROM k WHERE change_type IS NOT NULL"""


def _cast_loss() -> str:
    whole = "o_totalprice >= -2147483648 AND o_totalprice < 2147483648"
    parts = [("o_custkey", "INTEGER", "o_custkey NOT BETWEEN -2147483648 AND 2147483647", "false"),
             ("o_totalprice", "INTEGER", f"NOT ({whole})", f"{whole} AND trunc(o_totalprice) <> o_totalprice"),
             ("o_orderdate", "DATE", "false", "CAST(o_orderdate AS DATE) <> o_orderdate"),
             ("o_orderpriority", "INTEGER", "NOT regexp_matches(trim(o_orderpriority), '^[+-]?[0-9]+$')",
              "regexp_matches(trim(o_orderpriority), '^([+]|0[0-9]| )')")]
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS new_type, COUNT({c}) AS n_values,
       COUNT(*) FILTER (WHERE {f}) AS n_failed, COUNT(*) FILTER (WHERE {d}) AS n_changed FROM orders"""
        for c, t, f, d in parts)


def _cast_report() -> str:
    parts = []
    defs = [("doc_id", "bigint", "BIGINT", None), ("text", "character varying", "VARCHAR(500)", True),
            ("lang", "character varying", "VARCHAR(500)", True), ("source", "text", "TEXT", None),
            ("n_chars", "integer", "INTEGER", "INTEGER")]
    for col, st, tt, how in defs:
        if how is True:
            failed = "0"
            long = f"COUNT(*) FILTER (WHERE length({col}) > 500)"
        elif how is None:
            failed, long = "0", "0"
        else:
            failed = f"COUNT(*) FILTER (WHERE {col} IS NOT NULL AND TRY_CAST({col} AS {how}) IS NULL)"
            long = "0"
        parts.append(f"""SELECT '{col}' AS column_name, '{st}' AS source_type, '{tt}' AS target_type,
       COUNT({col}) AS n_values, CAST({failed} AS BIGINT) AS n_failed,
       CAST({long} AS BIGINT) AS n_too_long FROM documents""")
    return "\nUNION ALL\n".join(parts)


def _type_change_check() -> str:
    changes = [("o_custkey", "INTEGER", "INTEGER"), ("o_totalprice", "NUMERIC(18,4)", "DECIMAL(18,4)"),
               ("o_orderdate", "DATE", "DATE"), ("o_orderpriority", "INTEGER", "INTEGER")]
    return "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS new_type, COUNT({c}) AS n_values,
       COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {d}) IS NULL) AS n_failed
FROM orders""" for c, t, d in changes)


_LINE_COLS = [("l_orderkey", None), ("l_partkey", None), ("l_suppkey", None),
              ("l_linenumber", None), ("l_quantity", None), ("l_extendedprice", "DECIMAL(18,4)"),
              ("l_discount", "DECIMAL(18,4)"), ("l_tax", "DECIMAL(18,4)"), ("l_returnflag", None),
              ("l_linestatus", None), ("l_shipdate", None)]

ORACLE_SQL: dict[str, str] = {
    "incremental_scan": "SELECT " + ", ".join(
        f'{c} AS "{c.upper()}"' for c in
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
        + " FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01 00:00:00'",

    "key_bounds": "SELECT MIN(o_orderkey) AS lo, MAX(o_orderkey) AS hi, COUNT(*) AS n_rows FROM orders",

    "resolve_watermark": _with(RUNS, PIPELINES) + f"""SELECT p.id AS pipeline_id,
       COALESCE(m.last_end, {AS_OF} - INTERVAL 30 DAY) AS watermark, m.last_end IS NULL AS is_default
FROM pipelines p LEFT JOIN (
  SELECT pipeline_id, MAX(ended_at) AS last_end FROM runs WHERE status = 'complete'
  GROUP BY pipeline_id) m ON m.pipeline_id = p.id""",

    "upsert_delete_insert": _with(LOAD_TARGET, LOAD_BATCH) + """SELECT * FROM load_target t
WHERE NOT EXISTS (SELECT 1 FROM load_batch b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM load_batch""",

    "upsert_last_wins": _with(
        f"lt AS ({_dedup(chr(10) + 'WHERE l_shipdate < TIMESTAMP ' + _q('1998-01-01 00:00:00'))})",
        f"lb AS ({_dedup(chr(10) + 'WHERE l_shipdate >= TIMESTAMP ' + _q('1997-01-01 00:00:00'))})")
        + """SELECT * FROM lt WHERE NOT EXISTS (SELECT 1 FROM lb WHERE lb.l_orderkey = lt.l_orderkey)
UNION ALL SELECT * FROM lb""",

    "dedup_last_wins": _dedup(),

    "match_keys": _with(LOAD_TARGET, LOAD_BATCH) + """SELECT * FROM load_target t
WHERE EXISTS (SELECT 1 FROM load_batch b WHERE b.o_orderkey = t.o_orderkey)""",

    "append_only": _with(LOAD_TARGET, LOAD_BATCH)
        + "SELECT * FROM load_target UNION ALL SELECT * FROM load_batch",

    "load_rows": _with(LOAD_TARGET, LOAD_BATCH, """c AS (
  SELECT (SELECT COUNT(*) FROM load_target) AS rows_before,
         (SELECT COUNT(*) FROM load_batch) AS rows_batch,
         (SELECT COUNT(*) FROM load_target t WHERE EXISTS (
            SELECT 1 FROM load_batch b WHERE b.o_orderkey = t.o_orderkey)) AS rows_replaced)""")
        + "SELECT rows_before, rows_batch, rows_replaced, rows_before - rows_replaced + rows_batch AS rows_after FROM c",

    "cast_to_target": "SELECT " + ", ".join(
        (f'TRY_CAST({c} AS {t}) AS "{c.upper()}"' if t else f'{c} AS "{c.upper()}"')
        for c, t in _LINE_COLS) + " FROM lineitem",

    "cast_report": _cast_report(),

    "schema_columns": _with(SCHEMA_COLS) + f"""SELECT table_name, column_name, ordinal_position,
       data_type, {_map_type('data_type')} AS target_type FROM sc""",

    "suggest_watermark": _with(CATALOG) + "SELECT * FROM sw",

    "suggest_load_keys": _with(CATALOG) + """SELECT table_name,
       MIN(CASE WHEN column_name = 'id' THEN column_name END) AS merge_key_column,
       MIN(CASE WHEN is_suggested_watermark THEN column_name END) AS watermark_column
FROM sw GROUP BY table_name""",

    "schema_tree": _with(CATALOG) + """SELECT table_name, CAST(COUNT(*) AS INTEGER) AS n_columns,
       string_agg(column_name || ':' || data_type, ',' ORDER BY column_name) AS columns
FROM sc GROUP BY table_name""",

    "schema_summary": _with(CATALOG) + """SELECT table_name, COUNT(*) AS n_columns,
       bool_or(is_suggested_watermark) AS has_watermark
FROM sw GROUP BY table_name""",

    "detect_drift": _detect_drift(),

    "heal_and_align": _with(LOAD_TARGET, LOAD_BATCH) + """SELECT o_orderkey, o_custkey, o_orderstatus,
       o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
FROM load_target t WHERE NOT EXISTS (SELECT 1 FROM load_batch b WHERE b.o_orderkey = t.o_orderkey)
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice, o_orderdate,
       o_orderpriority FROM load_batch""",

    "type_change_check": _type_change_check(),

    "pending_drift": _with(PIPELINES, DRIFT) + """SELECT ds.*, p.name AS pipeline_name
FROM ds JOIN pipelines p ON p.id = ds.pipeline_id WHERE ds.status = 'pending_review'""",

    "drift_log": _with(DRIFT) + "SELECT * FROM ds WHERE status = 'resolved' ORDER BY detected_at DESC NULLS FIRST, id DESC NULLS FIRST",

    "run_state": _RUN_STATE,

    "latest_runs": _with(RUNS) + _LATEST,

    "recent_runs": _with(RUNS, PIPELINES) + """SELECT r.run_id, r.pipeline_id, r.status, r.started_at,
       r.ended_at, r.rows_loaded, p.name AS pipeline_name
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY pipeline_id
                                   ORDER BY started_at DESC NULLS FIRST, run_id DESC NULLS FIRST)
        AS rn FROM runs) r
JOIN pipelines p ON p.id = r.pipeline_id WHERE r.rn <= 100
ORDER BY r.started_at DESC NULLS FIRST, r.run_id DESC NULLS FIRST""",

    "volume_anomaly": _with(RUNS, PIPELINES, _va(True)) + "SELECT * FROM va",

    "volume_history": _with(RUNS, PIPELINES, _va(True), RF, _VH) + "SELECT * FROM vh",

    "volume_scale": _with(RUNS, PIPELINES, _va(True), RF, _VH) + """SELECT *,
       COALESCE(rows_loaded, 0) / peak_rows AS share_of_peak, strftime(run_date, '%m-%d') AS day_label
FROM (SELECT *, CAST(GREATEST(MAX(COALESCE(rows_loaded, 0)) OVER (PARTITION BY pipeline_id), 1)
                     AS BIGINT) AS peak_rows FROM vh)""",

    "platform_stats": _with(RUNS, PIPELINES, CONNECTIONS, _va(True), RF, DRIFT) + f"""SELECT
  (SELECT COUNT(*) FROM pipelines WHERE is_active) AS total_pipelines,
  (SELECT COUNT(*) FROM connections WHERE is_active) AS total_connections,
  (SELECT COUNT(*) FROM rf WHERE started_at >= {AS_OF} - INTERVAL 24 HOUR) AS runs_today,
  (SELECT COUNT(*) FROM rf WHERE started_at >= {AS_OF} - INTERVAL 24 HOUR AND status = 'failed')
    AS failed_today,
  (SELECT COUNT(*) FROM rf WHERE volume_anomaly_flag AND started_at >= {AS_OF} - INTERVAL 7 DAY)
    AS anomalies_7d,
  (SELECT COUNT(*) FROM ds WHERE status = 'pending_review') AS drift_pending""",

    "run_status_totals": _with(RUNS, PIPELINES, _va(True), RF) + """SELECT pipeline_id, COUNT(*) AS total,
       COUNT(*) FILTER (WHERE status = 'complete') AS complete,
       COUNT(*) FILTER (WHERE status = 'failed') AS failed,
       COUNT(*) FILTER (WHERE status = 'running') AS running,
       COUNT(*) FILTER (WHERE volume_anomaly_flag) AS anomalies
FROM rf GROUP BY pipeline_id""",

    "anomaly_feed": _with(RUNS, PIPELINES, _va(True), RF) + """SELECT * FROM rf
WHERE volume_anomaly_flag OR status = 'failed'
ORDER BY started_at DESC NULLS FIRST, run_id DESC NULLS FIRST LIMIT 6""",

    "run_page": _with(RUNS) + """SELECT * FROM runs WHERE status = 'failed'
ORDER BY started_at DESC NULLS FIRST, run_id DESC NULLS FIRST LIMIT 10 OFFSET 20""",

    "run_durations": _with(RUNS) + """SELECT run_id, pipeline_id, status, started_at, ended_at,
       d AS duration_s,
       CASE WHEN d IS NOT NULL THEN CAST(d AS VARCHAR) || 's'
            WHEN status = 'running' THEN 'running…' ELSE '—' END AS duration_label
FROM (SELECT *, NULLIF(CAST(round((epoch_us(ended_at) - epoch_us(started_at)) / 1000000.0)
                            AS BIGINT), 0) AS d FROM runs)""",

    "pipeline_overview": _with(RUNS, PIPELINES, CONNECTIONS, SCHEDULES, DEPS) + f"""SELECT p.id, p.name,
       c.name AS connection_name, c.db_type, dc.name AS destination_name,
       dc.db_type AS destination_db_type, s.cron_expression,
       COALESCE(lr.total_runs, 0) AS total_runs, lr.last_status, lr.last_run_at,
       lr.last_rows_loaded, COALESCE(dl.depends_on, '') AS depends_on
FROM pipelines p
LEFT JOIN connections c ON c.id = p.connection_id
LEFT JOIN connections dc ON dc.id = p.destination_connection_id
LEFT JOIN latest_sched s ON s.pipeline_id = p.id
LEFT JOIN ({_LATEST}) lr ON lr.pipeline_id = p.id
LEFT JOIN (SELECT pipeline_id,
                  string_agg(CAST(depends_on_id AS VARCHAR), ',' ORDER BY depends_on_id) AS depends_on
           FROM deps GROUP BY pipeline_id) dl ON dl.pipeline_id = p.id
WHERE p.is_active""",

    "dependency_edges": _with(PIPELINES, DEPS) + """SELECT d.pipeline_id, a.name AS pipeline_name,
       d.depends_on_id, b.name AS depends_on_name
FROM deps d JOIN pipelines a ON a.id = d.pipeline_id JOIN pipelines b ON b.id = d.depends_on_id""",

    "dependency_levels": "WITH RECURSIVE " + ",\n".join([PIPELINES, DEPS, """e AS (
  SELECT DISTINCT pipeline_id, depends_on_id FROM deps
  WHERE pipeline_id IN (SELECT id FROM pipelines) AND depends_on_id IN (SELECT id FROM pipelines)),
lv(pipeline_id, level) AS (
  SELECT p.id, 0 FROM pipelines p WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.pipeline_id = p.id)
  UNION ALL
  SELECT e.pipeline_id, lv.level + 1 FROM lv JOIN e ON e.depends_on_id = lv.pipeline_id)"""])
        + """
SELECT p.id AS pipeline_id, m.level, m.level IS NULL AS in_cycle
FROM pipelines p LEFT JOIN (SELECT pipeline_id, CAST(MAX(level) AS INTEGER) AS level
                            FROM lv GROUP BY pipeline_id) m ON m.pipeline_id = p.id""",

    "isolated_pipelines": _with(PIPELINES, DEPS) + """SELECT id, name FROM pipelines p
WHERE NOT EXISTS (SELECT 1 FROM deps d WHERE d.pipeline_id = p.id)
  AND NOT EXISTS (SELECT 1 FROM deps d WHERE d.depends_on_id = p.id)""",

    "export_pipelines": _with(PIPELINES, CONNECTIONS, SCHEDULES) + _EXPORT,

    "resolve_connections": _with(PIPELINES, CONNECTIONS, SCHEDULES, TARGET_CONNECTIONS,
                                 f"ex AS ({_EXPORT})") + """SELECT ex.pipeline_id, ex.name,
       ex.source_connection_name, s.id AS connection_id,
       ex.destination_connection_name, d.id AS destination_connection_id,
       CASE WHEN ex.source_connection_name IS NOT NULL AND s.id IS NULL THEN 'missing_source'
            WHEN ex.destination_connection_name IS NOT NULL AND d.id IS NULL THEN 'missing_destination'
            ELSE 'ok' END AS status
FROM ex LEFT JOIN tconn s ON s.name = ex.source_connection_name
LEFT JOIN tconn d ON d.name = ex.destination_connection_name""",

    "connection_roles": _with(CONNECTIONS) + """SELECT id, name, db_type, host, port, db_name,
       snowflake_warehouse, snowflake_role, snowflake_schema, created_at, is_active,
       CASE WHEN db_type = 'snowflake' THEN 'destination' ELSE 'source' END AS role
FROM connections""",

    "target_names": _with(PIPELINES, CONNECTIONS) + """SELECT *, concat_ws('.', target_db, target_schema, target_tbl) AS target_fqn
FROM (
  SELECT p.id,
         COALESCE(NULLIF(p.watermark_column, ''), 'updated_at') AS watermark_column,
         COALESCE(NULLIF(p.merge_key_column, ''), 'id') AS merge_key_column,
         upper(COALESCE(NULLIF(p.target_database, ''), NULLIF(c.db_name, ''))) AS target_db,
         upper(COALESCE(NULLIF(p.target_schema_name, ''), NULLIF(c.snowflake_schema, ''), 'PUBLIC'))
           AS target_schema,
         upper(p.target_table) AS target_tbl
  FROM pipelines p LEFT JOIN connections c ON c.id = p.destination_connection_id)""",

    "recent_pipelines": _with(PIPELINES) + """SELECT id, name, created_at FROM pipelines
WHERE is_active ORDER BY created_at DESC NULLS FIRST, id DESC NULLS FIRST LIMIT 6""",

    "stream_upsert": _dedup(),

    "run_load": _with(LOAD_TARGET, LOAD_BATCH, """m AS (
  SELECT * FROM load_target t
  WHERE NOT EXISTS (SELECT 1 FROM load_batch b WHERE b.o_orderkey = t.o_orderkey)
  UNION ALL SELECT * FROM load_batch)""") + "SELECT " + ", ".join(
        f'{c} AS "{c.upper()}"' for c in
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
        + " FROM m",

    "dependency_lists": _with(DEPS) + """SELECT pipeline_id, CAST(COUNT(*) AS INTEGER) AS n_prerequisites,
       string_agg(CAST(depends_on_id AS VARCHAR), ',' ORDER BY depends_on_id) AS depends_on
FROM deps GROUP BY pipeline_id""",

    "drift_counts": _with(DRIFT) + """SELECT change_type, status, COUNT(*) AS n FROM ds
GROUP BY change_type, status""",

    "missing_connections": _with(PIPELINES, CONNECTIONS, SCHEDULES, TARGET_CONNECTIONS,
                                 f"ex AS ({_EXPORT})") + """SELECT DISTINCT name FROM (
  SELECT source_connection_name AS name FROM ex
  UNION ALL SELECT destination_connection_name FROM ex) n
WHERE name IS NOT NULL AND name NOT IN (SELECT name FROM tconn)""",

    "run_page_count": _with(RUNS) + """SELECT CAST(ceil(COUNT(*) / 10) AS BIGINT) AS total_pages
FROM runs WHERE status = 'failed'""",

    "volume_totals": _with(RUNS, PIPELINES, _va(True), RF) + f"""SELECT CAST(started_at AS DATE) AS run_date,
       CAST(SUM(rows_loaded) AS BIGINT) AS rows_loaded, COUNT(*) AS run_count,
       MAX(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS had_failure,
       MAX(CASE WHEN volume_anomaly_flag THEN 1 ELSE 0 END) AS had_anomaly
FROM rf WHERE started_at >= {AS_OF} - INTERVAL 30 DAY
GROUP BY CAST(started_at AS DATE)""",

    "run_totals": _with(RUNS, PIPELINES, _va(True), RF) + """SELECT COUNT(*) AS total,
       COUNT(*) FILTER (WHERE status = 'complete') AS complete,
       COUNT(*) FILTER (WHERE status = 'failed') AS failed,
       COUNT(*) FILTER (WHERE status = 'running') AS running,
       COUNT(*) FILTER (WHERE volume_anomaly_flag) AS anomalies
FROM rf""",

    "cached_schema": _with(SCHEMA_COLS) + """SELECT table_name, column_name, ordinal_position,
       data_type, is_suggested_watermark, CAST(1 AS BIGINT) AS connection_id FROM sw""",

    "drift_cast_loss": _cast_loss(),

    "dependency_levels_dag": """WITH RECURSIVE e AS (
  SELECT c_custkey AS a, c_custkey - 1 AS b FROM customer WHERE c_custkey <= 66 AND c_custkey > 1
  UNION SELECT c_custkey, c_custkey // 2 FROM customer WHERE c_custkey // 2 > 0
  UNION SELECT c_custkey, c_custkey // 3 FROM customer WHERE c_custkey // 3 > 0),
g AS (SELECT a, b FROM e WHERE a IN (SELECT c_custkey FROM customer) AND b IN (SELECT c_custkey FROM customer)),
lv(id, level) AS (
  SELECT c_custkey, 0 FROM customer WHERE c_custkey NOT IN (SELECT a FROM g)
  UNION SELECT g.a, lv.level + 1 FROM lv JOIN g ON g.b = lv.id)
SELECT c_custkey AS pipeline_id, m.level, m.level IS NULL AS in_cycle FROM customer
LEFT JOIN (SELECT id, CAST(MAX(level) AS INTEGER) AS level FROM lv GROUP BY id) m ON m.id = c_custkey""",

    "volume_anomaly_unassigned": _with(RUNS.replace("user_id % 10 AS pipeline_id",
                                                    "CASE WHEN event_id % 17 <> 0 THEN user_id % 10 END AS pipeline_id"),
                                       PIPELINES, _va(True)) + "SELECT * FROM va",

    "target_columns": """SELECT 'orders' AS table_name, v.c AS column_name, CAST(v.i AS INTEGER) AS ordinal_position,
       v.t AS data_type FROM (VALUES ('O_ORDERKEY', 1, 'BIGINT'), ('O_CUSTKEY', 2, 'BIGINT'),
  ('O_ORDERSTATUS', 3, 'TEXT'), ('O_TOTALPRICE', 4, 'FLOAT'), ('O_ORDERDATE', 5, 'TIMESTAMP'),
  ('O_ORDERPRIORITY', 6, 'TEXT')) v(c, i, t)""",

    "empty_load": _with(LOAD_TARGET) + """SELECT CAST(1 AS BIGINT) AS run_id, CAST(1 AS BIGINT) AS pipeline_id,
       'complete' AS status, (SELECT COUNT(*) FROM load_target) AS rows_loaded, 3 AS phase_completed,
       CAST(NULL AS VARCHAR) AS cast_issues
UNION ALL SELECT 2, 1, 'complete', 0, 3, NULL""",

    "drift_append": _with(DRIFT) + "SELECT * FROM de",

    "recent_for_pipeline": _with(RUNS) + """SELECT * FROM runs WHERE pipeline_id = 3
ORDER BY started_at DESC NULLS FIRST, run_id DESC NULLS FIRST LIMIT 30""",

    "export_json": _with(PIPELINES, CONNECTIONS, SCHEDULES, f"ex AS ({_EXPORT})") + _EXPORT_JSON,
}

# Queries that reach the same rows by another layout of the files, or by a kept summary.
ORACLE_SQL |= {
    "bucketed_upsert": ORACLE_SQL["upsert_delete_insert"],
    "bucketed_last_wins": ORACLE_SQL["upsert_last_wins"],
    "key_bounds_footers": ORACLE_SQL["key_bounds"],
    "incremental_scan_clustered": ORACLE_SQL["incremental_scan"],
    "match_keys_skipping": ORACLE_SQL["match_keys"],
    "run_totals_kept": ORACLE_SQL["run_totals"],
    "run_status_totals_kept": ORACLE_SQL["run_status_totals"],
    "volume_history_kept": ORACLE_SQL["volume_history"],
}


def _page_bounds(scope: str, by: str) -> str:
    own = [c if c in by else f"CAST(NULL AS {t}) AS {c}" for c, t in (("pipeline_id", "BIGINT"), ("status", "VARCHAR"))]
    within = f"PARTITION BY {by} " if by else ""
    return f"""SELECT '{scope}' AS scope, {", ".join(own)}, page, COUNT(*) AS n_runs, MAX(epoch_us(started_at)) AS newest_us,
       MIN(epoch_us(started_at)) AS oldest_us
FROM (SELECT *, (ROW_NUMBER() OVER ({within}ORDER BY started_at DESC, run_id DESC) - 1) // 10 AS page FROM runs)
GROUP BY {by + ", " if by else ""}page"""


# Pages by an index, drift by fingerprints, runs of a hot day, stateful streams.
ORACLE_SQL |= {
    "run_state_stream": ORACLE_SQL["run_state"],
    "volume_anomaly_stream": ORACLE_SQL["volume_anomaly"],
    "run_page_indexed": ORACLE_SQL["run_page"],
    "run_page_bounds": _with(RUNS) + "\nUNION ALL ".join(
        _page_bounds(*s) for s in (("all", ""), ("status", "status"), ("pipeline", "pipeline_id"),
                                   ("both", "pipeline_id, status"))),
    "detect_drift_changed": ORACLE_SQL["detect_drift"],
    "drifted_tables": _with(CATALOG, CATALOG_TARGET, f"ev AS ({_detect_drift()})") + """
SELECT t.table_name, (SELECT COUNT(*) FROM sc WHERE sc.table_name = t.table_name) AS n_source,
       COUNT(*) AS n_target, t.table_name IN (SELECT table_name FROM ev) AS drifted
FROM tgt t GROUP BY t.table_name""",
    "volume_anomaly_hot_day": _with(
        RUNS.replace("ts AS started_at", "CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-15 12:00:00' "
                     "ELSE ts END AS started_at"), PIPELINES, _va(True)) + "SELECT * FROM va",
}
