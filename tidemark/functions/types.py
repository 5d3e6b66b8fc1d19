"""Source type names, their warehouse types and the casts between them.

Type names are compared as data (columns), so a schema of any width is
handled by one expression rather than a Python loop over rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: must equal the reference's mapping ------------------------
# Source type name (as information_schema reports it) -> warehouse type.
# Any name not listed maps to TEXT.
TYPE_MAP: dict[str, str] = {
    "integer": "INTEGER",
    "bigint": "BIGINT",
    "serial": "INTEGER",
    "varchar": "VARCHAR(500)",
    "character varying": "VARCHAR(500)",
    "text": "TEXT",
    "boolean": "BOOLEAN",
    "numeric": "NUMERIC(18,4)",
    "decimal": "NUMERIC(18,4)",
    "timestamp without time zone": "TIMESTAMP",
    "timestamp with time zone": "TIMESTAMP_TZ",
    "date": "DATE",
    "double precision": "FLOAT",
}
DEFAULT_TARGET_TYPE = "TEXT"
VARCHAR_LIMIT = 500
# --- end of fixed values -----------------------------------------------------

# Warehouse type -> Spark type of the loaded column.
_SPARK_TYPES: dict[str, T.DataType] = {
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "VARCHAR(500)": T.StringType(),
    "TEXT": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "NUMERIC(18,4)": T.DecimalType(18, 4),
    "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMP_TZ": T.TimestampType(),
    "DATE": T.DateType(),
    "FLOAT": T.DoubleType(),
}

# Spellings of one warehouse type (public Snowflake type synonyms): a warehouse
# that reports NUMBER(38,0) for INTEGER or VARCHAR for TEXT is not drift. A
# number's precision and scale are part of its type; a text's length is not.
CANONICAL_BASE: dict[str, str] = {
    "INTEGER": "NUMBER(38,0)", "INT": "NUMBER(38,0)", "BIGINT": "NUMBER(38,0)", "SMALLINT": "NUMBER(38,0)",
    "TINYINT": "NUMBER(38,0)", "BYTEINT": "NUMBER(38,0)",
    "TEXT": "VARCHAR", "STRING": "VARCHAR", "CHAR": "VARCHAR", "CHARACTER": "VARCHAR",
    "VARCHAR": "VARCHAR",
    "FLOAT": "FLOAT", "FLOAT4": "FLOAT", "FLOAT8": "FLOAT", "DOUBLE": "FLOAT",
    "DOUBLE PRECISION": "FLOAT", "REAL": "FLOAT",
    "TIMESTAMP": "TIMESTAMP_NTZ", "DATETIME": "TIMESTAMP_NTZ", "TIMESTAMP_NTZ": "TIMESTAMP_NTZ",
    "TIMESTAMP_TZ": "TIMESTAMP_TZ", "TIMESTAMP_LTZ": "TIMESTAMP_LTZ",
    "BOOLEAN": "BOOLEAN", "DATE": "DATE",
}
NUMBER_NAMES = ("NUMBER", "NUMERIC", "DECIMAL")


def _lit_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def map_type(source_type: Column | str) -> Column:
    """Warehouse type for a source type name; TEXT when unmapped."""
    c = F.col(source_type) if isinstance(source_type, str) else source_type
    return F.coalesce(_lit_map(TYPE_MAP)[c], F.lit(DEFAULT_TARGET_TYPE))


def base_type(type_name: Column | str) -> Column:
    """Text before the first '(', trimmed and upper-cased: VARCHAR(500) -> VARCHAR."""
    c = F.col(type_name) if isinstance(type_name, str) else type_name
    return F.upper(F.trim(F.split(c, r"\(").getItem(0)))


def canonical_base(type_name: Column | str) -> Column:
    """One name for all spellings of a type: synonyms folded, numbers with
    their precision and scale (38 and 0 where none are given); unknown names
    as they are."""
    c = F.col(type_name) if isinstance(type_name, str) else type_name
    b = base_type(c)
    inner = r"\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)"
    precision, scale = F.regexp_extract(c, inner, 1), F.regexp_extract(c, inner, 2)
    number = F.concat(F.lit("NUMBER("), F.when(precision == "", "38").otherwise(precision), F.lit(","),
                      F.when(scale == "", "0").otherwise(scale), F.lit(")"))
    return F.when(b.isin(*NUMBER_NAMES), number).otherwise(F.coalesce(_lit_map(CANONICAL_BASE)[b], b))


_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds every value of both; text if no other does."""
    if a == b:
        return a
    if type(a) in _DIGITS and type(b) in _DIGITS:
        return a if _DIGITS[type(a)] >= _DIGITS[type(b)] else b
    exact = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS.get(type(t)), 0)
             for t in (a, b)]
    if all(e[0] is not None for e in exact):
        whole, scale = max(e[0] for e in exact), max(e[1] for e in exact)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if T.DoubleType() in (a, b):  # a double holds every integer of up to 15 digits
        other = b if a == T.DoubleType() else a
        if isinstance(other, T.FloatType) or _DIGITS.get(type(other), 99) <= 10:
            return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def lossless_cast(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast to a type from ``widest``."""
    if isinstance(want, T.StringType) and _is_nested(have):
        return F.to_json(c)
    return c.cast(want)


def source_type_name(dt: T.DataType) -> str:
    """information_schema-style name for a Spark type (for Spark/Parquet sources)."""
    if isinstance(dt, T.IntegerType):
        return "integer"
    if isinstance(dt, T.LongType):
        return "bigint"
    if isinstance(dt, T.ShortType):
        return "smallint"
    if isinstance(dt, T.ByteType):
        return "smallint"
    if isinstance(dt, T.StringType):
        return "text"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, T.DecimalType):
        return "numeric"
    if isinstance(dt, T.TimestampNTZType):
        return "timestamp without time zone"
    if isinstance(dt, T.TimestampType):
        return "timestamp with time zone"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, T.DoubleType):
        return "double precision"
    if isinstance(dt, T.FloatType):
        return "real"
    if isinstance(dt, T.BinaryType):
        return "bytea"
    if isinstance(dt, T.ArrayType):
        return "ARRAY"
    if isinstance(dt, (T.MapType, T.StructType)):
        return "jsonb"
    return "text"


def spark_type_for(target_type: str) -> T.DataType:
    """Spark type of a column loaded as ``target_type``."""
    return _SPARK_TYPES.get(target_type.upper(), T.StringType())


_HELD = {"VARCHAR": T.StringType(), "FLOAT": T.DoubleType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
         "TIMESTAMP_TZ": T.TimestampType(), "TIMESTAMP_LTZ": T.TimestampType(), "BOOLEAN": T.BooleanType(),
         "DATE": T.DateType()}


def held_type(type_name: str) -> T.DataType | None:
    """Spark type of the values that a warehouse column of a reported type
    holds; None for a type that is not known."""
    name, _, inner = type_name.upper().partition("(")
    name = name.strip()
    if name in NUMBER_NAMES:
        digits = [int(x) for x in inner.rstrip(") ").split(",") if x.strip().isdigit()]
        return T.DecimalType(digits[0] if digits else 38, digits[1] if len(digits) > 1 else 0)
    canonical = CANONICAL_BASE.get(name, name)
    return T.DecimalType(38, 0) if canonical == "NUMBER(38,0)" else _HELD.get(canonical)


def target_type_for(source_type: str) -> str:
    return TYPE_MAP.get(source_type, DEFAULT_TARGET_TYPE)


def _is_nested(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ArrayType, T.MapType, T.StructType))


def cast_column(df: DataFrame, name: str, target_type: str) -> Column:
    """Cast one column to the Spark type of ``target_type``.

    Values that do not fit (decimal overflow, unparsable text) become null
    rather than failing the job; ``cast_report`` counts them beforehand.
    Nested values become JSON text. Over-long VARCHAR values are kept whole.
    """
    src = df.schema[name].dataType
    want = spark_type_for(target_type)
    c = F.col(name)
    if isinstance(want, T.StringType):
        out = F.to_json(c) if _is_nested(src) else c.cast("string")
    elif src == want:
        out = c
    else:
        out = c.try_cast(want)
    return out.alias(name)


def cast_to_target(df: DataFrame, col_defs: Iterable[tuple[str, str]]) -> DataFrame:
    """Project ``df`` to the defined columns, in order, cast to mapped types."""
    return df.select(*[cast_column(df, n, target_type_for(t)) for n, t in col_defs])


def cast_metrics(df: DataFrame, col_defs: Iterable[tuple[str, str]]) -> list[Column]:
    """Aggregates counting, per column, values the target type cannot hold
    (``<col>__f``) and over-long VARCHAR values (``<col>__l``); usable in
    ``agg`` or in an ``Observation`` riding along another pass."""
    out = []
    for n, t in col_defs:
        target = target_type_for(t)
        present = F.col(n).isNotNull()
        out.append(F.count_if(present & cast_column(df, n, target).isNull()).alias(f"{n}__f"))
        if target.startswith("VARCHAR"):
            out.append(F.count_if(F.char_length(F.col(n).cast("string")) > VARCHAR_LIMIT)
                       .alias(f"{n}__l"))
    return out


def cast_report(df: DataFrame, col_defs: Iterable[tuple[str, str]]) -> DataFrame:
    """Per column: values present, values the target type cannot hold, and
    VARCHAR values longer than the limit. One scan, one partial aggregate.
    """
    defs = list(col_defs)
    aggs = []
    for n, t in defs:
        target = target_type_for(t)
        casted = cast_column(df, n, target)
        present = F.col(n).isNotNull()
        aggs.append(F.count_if(present).alias(f"{n}__n"))
        aggs.append(F.count_if(present & casted.isNull()).alias(f"{n}__f"))
        if target.startswith("VARCHAR"):
            aggs.append(F.count_if(F.char_length(F.col(n).cast("string")) > VARCHAR_LIMIT)
                        .alias(f"{n}__l"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias(f"{n}__l"))
    wide = df.agg(*aggs)
    rows = [
        F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("source_type"),
                 F.lit(target_type_for(t)).alias("target_type"),
                 F.col(f"{n}__n").alias("n_values"), F.col(f"{n}__f").alias("n_failed"),
                 F.col(f"{n}__l").alias("n_too_long"))
        for n, t in defs
    ]
    return wide.select(F.inline(F.array(*rows)))
