"""Schemas as data: discovery, suggestions, drift detection and healing.

Column lists are DataFrames of (table_name, column_name, ordinal_position,
data_type), so drift for thousands of tables is one join, not a loop.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import HEAL_ERROR_LIMIT
from tidemark.functions.types import (
    base_type, canonical_base, lossless_cast, map_type, source_type_name, spark_type_for, widest,
)

# --- fixed values: the reference's watermark suggestion rule ----------------
WATERMARK_NAMES = ("updated_at", "modified_at", "last_modified", "update_date",
                   "changed_at", "modified_date")
WATERMARK_TYPES = ("timestamp", "timestamp without time zone",
                   "timestamp with time zone", "date")
WATERMARK_NAME_HINT = "update"
MERGE_KEY_NAME = "id"
SYSTEM_TABLE_PATTERN = "pg_%"
# --- end of fixed values -----------------------------------------------------

COLUMNS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("ordinal_position", T.IntegerType()),
    T.StructField("data_type", T.StringType()),
])


# ------------------------------------------------------------ discovery

def columns_of(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """information_schema-style column list of Spark tables (from their
    schemas; no data is read)."""
    rows = [(name, f.name, i + 1, source_type_name(f.dataType))
            for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def user_tables(columns: DataFrame) -> DataFrame:
    """Drop system tables: ``table_name NOT LIKE 'pg_%'`` (``_`` is a wildcard)."""
    return columns.where(~F.col("table_name").like(SYSTEM_TABLE_PATTERN))


def table_columns(columns: DataFrame, table: str) -> DataFrame:
    """One table's columns in ordinal order."""
    return columns.where(F.col("table_name") == table).orderBy("ordinal_position")


def describe_target(df: DataFrame, table: str) -> DataFrame:
    """Target columns as a warehouse DESCRIBE reports them: upper names,
    mapped warehouse type names."""
    spark = df.sparkSession
    rows = [(table, f.name.upper(), i + 1, _warehouse_name(f.dataType))
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def _warehouse_name(dt: T.DataType) -> str:
    if isinstance(dt, T.IntegerType):
        return "INTEGER"
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, T.DecimalType):
        return f"NUMERIC({dt.precision},{dt.scale})"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.TimestampNTZType):
        return "TIMESTAMP"
    if isinstance(dt, T.TimestampType):
        return "TIMESTAMP_TZ"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return "FLOAT"
    return "TEXT"


# ---------------------------------------------------------- suggestions

def suggest_watermark(columns: DataFrame) -> DataFrame:
    """Adds ``is_suggested_watermark``: a well-known name, or a date/time
    type whose name mentions "update"."""
    name = F.lower(F.col("column_name"))
    typ = F.lower(F.col("data_type"))
    flag = name.isin(*WATERMARK_NAMES) | (typ.isin(*WATERMARK_TYPES)
                                          & name.contains(WATERMARK_NAME_HINT))
    return columns.withColumn("is_suggested_watermark", flag)


def suggest_load_keys(columns: DataFrame) -> DataFrame:
    """Per table: the merge key (a column named ``id``) and the first
    suggested watermark in the cached order (by column name)."""
    cols = suggest_watermark(columns) if "is_suggested_watermark" not in columns.columns else columns
    return (cols.groupBy("table_name")
            .agg(F.min(F.when(F.col("column_name") == MERGE_KEY_NAME, F.col("column_name")))
                 .alias("merge_key_column"),
                 F.min(F.when(F.col("is_suggested_watermark"), F.col("column_name")))
                 .alias("watermark_column")))


# ------------------------------------------------------- tree / summary

def schema_tree(columns: DataFrame) -> DataFrame:
    """One row per table with its columns as a sorted array of structs."""
    cols = suggest_watermark(columns) if "is_suggested_watermark" not in columns.columns else columns
    entry = F.struct(F.col("column_name").alias("name"), F.col("data_type").alias("type"),
                     F.col("is_suggested_watermark"))
    return (cols.groupBy("table_name")
            .agg(F.array_sort(F.collect_list(entry)).alias("columns")))


def schema_summary(columns: DataFrame) -> DataFrame:
    """Column count per table and whether any column suggests a watermark."""
    cols = suggest_watermark(columns) if "is_suggested_watermark" not in columns.columns else columns
    return (cols.groupBy("table_name")
            .agg(F.count(F.lit(1)).alias("n_columns"),
                 F.bool_or("is_suggested_watermark").alias("has_watermark")))


# ---------------------------------------------------------------- drift

DRIFT_COLUMNS = ["table_name", "column_name", "change_type", "old_definition",
                 "new_definition", "status"]
DRIFT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in DRIFT_COLUMNS])


def detect_drift(source_cols: DataFrame, target_cols: DataFrame,
                 fold_synonyms: bool = True) -> DataFrame:
    """Compare source columns (source type names) with target columns
    (warehouse type names), matched by table and upper-cased name.

    column_added   new in the source: status ``auto_resolved`` (healed)
    type_changed   types differ: ``pending_review``
    column_dropped gone from the source: ``pending_review``

    A table absent from the target yields no events (first load). With
    ``fold_synonyms`` spellings of one type (TEXT/VARCHAR, INTEGER/NUMBER(38,0))
    compare equal, and numbers differ by precision and scale; without it base
    names are compared as they are.
    """
    base = canonical_base if fold_synonyms else base_type
    present = target_cols.select("table_name").distinct()
    src = (source_cols.join(present, "table_name", "left_semi")
           .select("table_name", F.upper("column_name").alias("column_name"),
                   map_type("data_type").alias("new_definition")))
    tgt = target_cols.select("table_name", F.upper("column_name").alias("column_name"),
                             F.upper("data_type").alias("old_definition"))
    both = src.join(tgt, ["table_name", "column_name"], "full_outer")
    change = (F.when(F.col("old_definition").isNull(), F.lit("column_added"))
              .when(F.col("new_definition").isNull(), F.lit("column_dropped"))
              .when(base(F.col("old_definition")) != base(F.col("new_definition")),
                    F.lit("type_changed")))
    return (both.withColumn("change_type", change)
            .where(F.col("change_type").isNotNull())
            .withColumn("old_definition",
                        F.when(F.col("change_type") != "column_added", F.col("old_definition")))
            .withColumn("new_definition",
                        F.when(F.col("change_type") != "column_dropped", F.col("new_definition")))
            .withColumn("status", F.when(F.col("change_type") == "column_added",
                                         F.lit("auto_resolved"))
                        .otherwise(F.lit("pending_review")))
            .select(*DRIFT_COLUMNS))


def table_fingerprints(columns: DataFrame, definition: Column) -> DataFrame:
    """One row per table: number of columns and an order-free fingerprint of
    their upper-cased names and types (``definition``), 128 bits of exclusive
    or. ``plain`` is false where names repeat or a name or type is null:
    fingerprints of such tables say nothing."""
    named = columns.select("table_name", F.upper("column_name").alias("_c"), definition.alias("_d"))
    bits = [F.bit_xor(F.xxhash64(F.lit(seed), F.col("_c"), F.col("_d"))) for seed in (1, 2)]
    whole = F.count_if(F.col("_c").isNull() | F.col("_d").isNull()) == 0
    # a table's names are as many as its columns
    return (named.groupBy("table_name")
            .agg(F.count(F.lit(1)).alias("n_columns"), F.struct(*[b.alias(f"b{i}") for i, b in enumerate(bits)])
                 .alias("fingerprint"),
                 (whole & (F.size(F.collect_set("_c")) == F.count(F.lit(1)))).alias("plain")))


def drifted_tables(source_cols: DataFrame, target_cols: DataFrame, fold_synonyms: bool = True) -> DataFrame:
    """Per table that the target has: numbers of columns on both sides and
    whether its columns must be compared (``drifted``). Tables without a name
    are left out, as they match nothing."""
    base = canonical_base if fold_synonyms else base_type
    src, tgt = (table_fingerprints(df, base(kind)) for df, kind in (
        (source_cols, map_type("data_type")), (target_cols, F.upper("data_type"))))
    s, t = F.col("s.fingerprint"), F.col("t.fingerprint")
    same = (s == t) & (F.col("s.n_columns") == F.col("t.n_columns")) & F.col("s.plain") & F.col("t.plain")
    return (tgt.alias("t").where(F.col("t.table_name").isNotNull()).join(src.alias("s"), "table_name", "left")
            .select("table_name", F.coalesce("s.n_columns", F.lit(0)).alias("n_source"),
                    F.col("t.n_columns").alias("n_target"), (~F.coalesce(same, F.lit(False))).alias("drifted")))


def detect_drift_changed(source_cols: DataFrame, target_cols: DataFrame, fold_synonyms: bool = True) -> DataFrame:
    """``detect_drift``, comparing the columns of those tables only whose
    fingerprints differ: each catalog is reduced to a row per table before it
    is shuffled, and the join of columns follows the change."""
    changed = drifted_tables(source_cols, target_cols, fold_synonyms).where("drifted").select("table_name")
    return detect_drift(source_cols.join(changed, "table_name", "left_semi"),
                        target_cols.join(changed, "table_name", "left_semi"), fold_synonyms)


def heal_status(error: str | None) -> str:
    """Status of an add-column heal: resolved, or the error cut to 200."""
    return "auto_resolved" if error is None else "error: " + error[:HEAL_ERROR_LIMIT]


def new_drift_events(detected: DataFrame, state: DataFrame,
                     keys=("pipeline_id", "column_name", "change_type")) -> DataFrame:
    """Detected events not already pending for the same column and change."""
    pending = state.where(F.col("status") == "pending_review").select(*keys).distinct()
    return detected.join(pending, list(keys), "left_anti")


# -------------------------------------------------------- heal / align

def heal_target(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target with every batch column it lacks added as null (ADD COLUMN)."""
    have = set(target.columns)
    added = [F.lit(None).cast(f.dataType).alias(f.name)
             for f in batch.schema.fields if f.name not in have]
    return target.select("*", *added)


def align_batch(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Batch in the target's column order: columns the batch lacks become
    null, columns it adds stay at the end. A column of another type is cast
    to the target's where that type holds every value of the batch's; else it
    keeps its own type, and readers of the target widen the column. No value
    is changed or lost."""
    have = {f.name: f.dataType for f in batch.schema.fields}
    cols = []
    for f in target.schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] != f.dataType and widest(have[f.name], f.dataType) == f.dataType:
            cols.append(lossless_cast(F.col(f.name), have[f.name], f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    tnames = set(target.columns)
    cols += [F.col(n) for n in batch.columns if n not in tnames]
    return batch.select(*cols)


def cast_loss(df: DataFrame, changes: Mapping[str, str]) -> DataFrame:
    """For each (column -> warehouse type): values present, values the type
    cannot hold (``n_failed``) and values it would change, such as cut-off
    decimals (``n_changed``). One scan."""
    aggs = []
    for c, t in changes.items():
        have, want = df.schema[c].dataType, spark_type_for(t)
        to = F.col(c).try_cast(want)
        back = to.cast(have) if not isinstance(have, T.StringType) else to.cast("string")
        aggs += [F.count_if(F.col(c).isNotNull()).alias(f"{c}__n"),
                 F.count_if(F.col(c).isNotNull() & to.isNull()).alias(f"{c}__f"),
                 F.count_if(to.isNotNull() & (back != F.col(c))).alias(f"{c}__d")]
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("new_type"),
                     F.col(f"{c}__n").alias("n_values"), F.col(f"{c}__f").alias("n_failed"),
                     F.col(f"{c}__d").alias("n_changed")) for c, t in changes.items()]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def heal_and_align(target: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    healed = heal_target(target, batch)
    return healed, align_batch(batch, healed)


# ---------------------------------------------------------- type change

def apply_type_change(target: DataFrame, column: str, new_type: str) -> DataFrame:
    """Target rewritten with ``column`` cast to the warehouse type ``new_type``.
    Values that do not fit become null; count them first with
    ``type_change_check``."""
    want = spark_type_for(new_type)
    return target.withColumn(column, F.col(column).try_cast(want))


def type_change_check(target: DataFrame, changes: Mapping[str, str]) -> DataFrame:
    """For each requested (column -> warehouse type): values present and
    values that would fail the cast. One scan."""
    aggs = []
    for c, t in changes.items():
        want = spark_type_for(t)
        present = F.col(c).isNotNull()
        aggs += [F.count_if(present).alias(f"{c}__n"),
                 F.count_if(present & F.col(c).try_cast(want).isNull()).alias(f"{c}__f")]
    wide = target.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("new_type"),
                     F.col(f"{c}__n").alias("n_values"), F.col(f"{c}__f").alias("n_failed"))
            for c, t in changes.items()]
    return wide.select(F.inline(F.array(*rows)))


# ------------------------------------------------------ drift log

def drift_state(log: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Current drift events: an event with a resolution is ``resolved`` (with
    the latest resolution's time and user); others keep their status."""
    latest = (resolutions.groupBy("drift_id")
              .agg(F.max_by(F.struct("resolved_at", "resolved_by"),
                            F.struct("resolved_at", "resolved_by")).alias("r"))
              .select(F.col("drift_id").alias("id"), F.col("r.resolved_at").alias("resolved_at"),
                      F.col("r.resolved_by").alias("resolved_by")))
    base_cols = [c for c in log.columns if c not in ("resolved_at", "resolved_by")]
    return (log.select(*base_cols).join(latest, "id", "left")
            .withColumn("status", F.when(F.col("resolved_at").isNotNull(), F.lit("resolved"))
                        .otherwise(F.col("status"))))


def drift_log(state: DataFrame, pipeline_id=None, status: str | None = None) -> DataFrame:
    """Drift events, optionally of one pipeline and one status, newest first."""
    if pipeline_id is not None:
        state = state.where(F.col("pipeline_id") == F.lit(pipeline_id))
    if status:
        state = state.where(F.col("status") == F.lit(status))
    return state.orderBy(F.col("detected_at").desc_nulls_first(), F.col("id").desc_nulls_first())


def pending_drift(state: DataFrame, pipelines: DataFrame) -> DataFrame:
    """Unresolved events of all pipelines, with the pipeline's name."""
    names = pipelines.select(F.col("id").alias("pipeline_id"), F.col("name").alias("pipeline_name"))
    return (state.where(F.col("status") == "pending_review")
            .join(names, "pipeline_id", "inner")
            .orderBy(F.col("detected_at").desc_nulls_first(), F.col("id").desc_nulls_first()))


def drift_counts(events: DataFrame) -> DataFrame:
    """Number of drift events per change type and status."""
    return events.groupBy("change_type", "status").agg(F.count(F.lit(1)).alias("n"))


RESOLVE_ACTIONS = ("dismiss", "apply_type_change")
RESOLUTION_SCHEMA = T.StructType([
    T.StructField("drift_id", T.LongType()),
    T.StructField("resolved_at", T.TimestampNTZType()),
    T.StructField("resolved_by", T.LongType()),
    T.StructField("action", T.StringType()),
])


def resolution_event(spark: SparkSession, drift_id: int, action: str, resolved_by, as_of) -> DataFrame:
    """The append-only record of one resolution (D5); ``drift_state`` folds it."""
    if action not in RESOLVE_ACTIONS:
        raise ValueError(f"unknown action {action!r}")
    return spark.createDataFrame([(int(drift_id), as_of, resolved_by, action)], RESOLUTION_SCHEMA)
