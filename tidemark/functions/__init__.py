from tidemark.functions.types import (
    TYPE_MAP, base_type, canonical_base, cast_metrics, cast_report, cast_to_target, map_type,
    source_type_name, spark_type_for, target_type_for,
)
from tidemark.functions.exprs import (
    duration_seconds, first_nonblank, month_day, nonblank, target_name, ts_lit,
)

__all__ = [
    "TYPE_MAP", "base_type", "canonical_base", "cast_metrics", "cast_report", "cast_to_target",
    "map_type", "source_type_name", "spark_type_for", "target_type_for",
    "duration_seconds", "first_nonblank", "month_day", "nonblank", "target_name", "ts_lit",
]
