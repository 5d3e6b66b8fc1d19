from tidemark.sources.connection import Connection
from tidemark.sources.readers import (
    ParquetSource, discover_schema, key_bounds, key_bounds_df, read_incremental,
    read_partitioned, read_table, target_columns, watermark_filter,
)

__all__ = [
    "Connection", "ParquetSource", "discover_schema", "key_bounds", "key_bounds_df",
    "read_incremental", "read_partitioned", "read_table", "target_columns", "watermark_filter",
]
