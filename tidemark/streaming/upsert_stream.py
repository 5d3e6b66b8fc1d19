"""Incremental upsert as a Structured Streaming query.

The file source's checkpoint replaces the high-water mark: each trigger
picks up only files not yet processed. ``foreachBatch`` applies a
last-wins upsert and commits the result as the next target version; the
commit carries the stream's and the micro-batch's id, so a batch replayed
after a failure is found and skipped.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.upsert import dedup_last_wins
from tidemark.plans.buckets import BucketedTarget
from tidemark.plans.tables import VersionedTable
from tidemark.session import checkpoint_dir, is_dir

BUCKETS = 16  # folders of the query's target


def upsert_batch(spark: SparkSession, target_root: str, key: str | Sequence[str],
                 order_cols: Sequence[str], compact_max_layers: int = 16,
                 compact_ratio: float = 0.1, checkpoint_location: str | None = None):
    """The ``foreachBatch`` function: idempotent per stream and batch id.

    Batch ids restart with every checkpoint, so a batch is known by the id
    that the stream's checkpoint carries as well as by its number.

    Each micro-batch is deduplicated (last wins) and written as one layer
    of the target, so its cost follows the micro-batch, not the table."""

    stream: list[str] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        vt = VersionedTable(spark, target_root)
        if not stream:
            stream.append(stream_id(spark, checkpoint_location))
        tag = f"stream:{stream[0]}:batch:{int(batch_id)}"
        if vt.has_tag(tag):
            return  # replayed micro-batch, already applied
        latest = vt.latest_version()
        layer = dedup_last_wins(batch, key, order_cols)
        if latest is None:
            vt.write(layer, 0, check=False, tag=tag)
            return
        vt.write_layer(layer, latest + 1, key, check=False, tag=tag)
        if vt.should_compact(compact_max_layers, compact_ratio):
            vt.compact()

    return apply


def bucketed_batch(target: BucketedTarget, order_cols: Sequence[str], checkpoint_location: str):
    """The ``foreachBatch`` function for a target in folders by key hash: a
    micro-batch is a run of the target, known by the stream's id and its
    number, and rewrites the folders of its keys only."""

    stream: list[str] = []

    def apply(batch: DataFrame, batch_id: int) -> None:
        # the stream's own session plans the writes
        into = BucketedTarget(batch.sparkSession, target.name, target.key, target.buckets)
        if not stream:
            stream.append(stream_id(into.spark, checkpoint_location))
        into.upsert(batch, f"stream:{stream[0]}:batch:{int(batch_id)}", order_cols)

    return apply


def stream_id(spark: SparkSession, checkpoint_location: str | None) -> str:
    """The id Spark wrote into the checkpoint when the stream first started."""
    if checkpoint_location is None:
        raise ValueError("upsert_batch needs the stream's checkpoint_location")
    text = "".join(r[0] for r in spark.read.text(os.path.join(checkpoint_location, "metadata")).collect())
    return json.loads(text)["id"]


def stream_upsert(spark: SparkSession, source_path: str, schema: T.StructType,
                  target_root: str | BucketedTarget, key: str | Sequence[str], order_cols: Sequence[str],
                  checkpoint_location: str | None = None, available_now: bool = True,
                  processing_time: str | None = None, glob_filter: str | None = None,
                  max_files_per_trigger: int | None = None, compact_max_layers: int = 16,
                  compact_ratio: float = 0.1):
    """Start the stream into a versioned target at ``target_root``, or into a
    ``BucketedTarget`` by its own key. With ``available_now`` it processes what is there
    and stops (a scheduled run); otherwise it triggers every
    ``processing_time``. Returns the StreamingQuery."""
    bucketed = isinstance(target_root, BucketedTarget)
    name = target_root.name if bucketed else os.path.basename(target_root.rstrip("/"))
    ckpt = checkpoint_location or os.path.join(checkpoint_dir(spark), "streams", name)
    reader = spark.readStream.schema(schema)
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    reader = reader.parquet(source_path)
    apply = (bucketed_batch(target_root, order_cols, ckpt) if bucketed else
             upsert_batch(spark, target_root, key, order_cols, compact_max_layers, compact_ratio, ckpt))
    writer = (reader.writeStream.foreachBatch(apply)
              .option("checkpointLocation", ckpt))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time or "1 minute"))
    return writer.start()


def stream_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the whole lineitem table into an empty target, keyed by
    order, last line wins; return the resulting table."""
    from tidemark.plans.views import DUP_KEY, DUP_ORDER
    path = os.path.join(sf_dir, "lineitem.parquet")
    schema = spark.read.parquet(path).schema
    root = os.path.join(checkpoint_dir(spark), "stream_upsert", uuid.uuid4().hex)
    # a table folder is streamed as it is; a single file through its folder
    # with a name filter (a file source watches folders)
    source, glob = (path, None) if is_dir(spark, path) else (sf_dir, "lineitem.parquet")
    target = BucketedTarget.create(spark.createDataFrame([], schema), f"stream_{uuid.uuid4().hex}", DUP_KEY, BUCKETS,
                                   os.path.join(root, "target"))
    q = stream_upsert(spark, source, schema, target, DUP_KEY, DUP_ORDER,
                      checkpoint_location=os.path.join(root, "checkpoint"), glob_filter=glob)
    q.awaitTermination()
    return target.read()
