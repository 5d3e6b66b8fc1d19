"""Cached source schemas (S8) and their per-connection replacement (K8).

The cache is a Parquet table partitioned by ``connection_id``. Replacing
one connection's columns is a dynamic partition overwrite: only that
connection's folder is rewritten, the others are untouched. A cached read
prunes to one partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.schema import suggest_watermark
from tidemark.session import path_exists

CACHE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("ordinal_position", T.IntegerType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("is_suggested_watermark", T.BooleanType()),
    T.StructField("connection_id", T.LongType()),
])


class SchemaCache:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self, connection_id: int) -> DataFrame:
        """One connection's cached columns, by table then column name."""
        df = None
        if path_exists(self.spark, self.path) is not False:
            try:
                df = self.spark.read.schema(CACHE_SCHEMA).parquet(self.path)
            except AnalysisException:
                df = None
        if df is None:
            df = self.spark.createDataFrame([], CACHE_SCHEMA)
        return (df.where(F.col("connection_id") == F.lit(connection_id).cast("bigint"))
                .orderBy("table_name", "column_name"))

    def replace(self, columns: DataFrame, connection_id: int) -> None:
        """Replace the connection's cached columns with ``columns``
        (table_name, column_name, ordinal_position, data_type); the
        watermark suggestion is computed on the way in."""
        rows = (suggest_watermark(columns)
                .withColumn("connection_id", F.lit(connection_id).cast("bigint"))
                .select(*[F.col(f.name).cast(f.dataType) for f in CACHE_SCHEMA.fields]))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("connection_id").parquet(self.path))


def cached_schema(cache: SchemaCache, connection_id: int,
                  discover: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """Cached columns of a connection; discovered and stored when the cache
    is empty or ``refresh`` is asked for."""
    if not refresh:
        cached = cache.read(connection_id)
        if cached.limit(1).count() > 0:
            return cached
    cache.replace(discover(), connection_id)
    return cache.read(connection_id)
