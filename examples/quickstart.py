"""A pipeline's life on tidemark: discover, cache, load twice, monitor.

    python examples/quickstart.py [/root/testdata/sf0.001] [work_dir]

The source is a folder of Parquet tables; a JDBC source is a
``Connection(db_type="postgresql", host=..., ...)`` in the same place.
"""

import datetime as dt
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark import get_session  # noqa: E402
from tidemark.operators import runs as R, schema as S  # noqa: E402
from tidemark.plans.load import LoadSpec, run_load  # noqa: E402
from tidemark.plans.schema_cache import SchemaCache, cached_schema  # noqa: E402
from tidemark.plans.tables import VersionedTable  # noqa: E402
from tidemark.sources.readers import ParquetSource, discover_schema  # noqa: E402


def main(sf_dir: str, work: str) -> None:
    spark = get_session("local[4]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    src = ParquetSource(sf_dir)
    tables = {t: spark.read.parquet(src.path(t)) for t in ("orders", "customer", "lineitem")}

    # schema discovery, cached per connection, with watermark suggestions
    cache = SchemaCache(spark, os.path.join(work, "schema_cache"))
    cols = cached_schema(cache, 1, lambda: discover_schema(spark, src, tables=tables))
    S.schema_summary(cols).show()

    # two scheduled loads of one pipeline: full, then incremental from the mark
    spec = LoadSpec(pipeline_id=1, source=src, source_table="orders",
                    target_path=os.path.join(work, "target"), watermark_column="o_orderdate",
                    merge_key="o_orderkey", mode="full")
    log = os.path.join(work, "run_log")
    r1 = run_load(spark, spec, dt.datetime(1999, 7, 1), run_id=1, run_log=log)
    # later runs stamp their events with the wall clock
    history = R.run_state(spark.read.parquet(log))
    spec2 = LoadSpec(**{**spec.__dict__, "mode": "incremental"})
    r2 = run_load(spark, spec2, dt.datetime(2024, 1, 31), run_id=2, runs=history, run_log=log,
                  clock=dt.datetime.now)
    print("run 1:", r1.rows_loaded, "rows; run 2:", r2.rows_loaded, "rows since", r2.watermark,
          "anomaly:", r2.volume_anomaly)

    # monitoring from the run events
    runs = R.run_state(spark.read.parquet(log)).withColumn("pipeline_id", F.lit(1).cast("bigint"))
    R.run_durations(runs).show(truncate=False)
    print("target rows:", VersionedTable(spark, spec.target_path).read().count())


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    main(sf, sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="tidemark-quickstart-"))
