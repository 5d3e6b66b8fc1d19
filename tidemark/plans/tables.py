"""A Parquet target with atomic commits and merge-on-read upserts.

Spark cannot overwrite a Parquet table that the same plan reads, and plain
Parquet has no MERGE. A target is therefore a series of versions under
``<root>/v=<n>``, each made visible only by a row appended to the commit
log ``<root>/_commits`` after its files are written. Readers see committed
versions only (the log is kept in epochs, one per base, and a reader
reads only the newest); a write that dies (or an executor lost mid-write, which
Spark retries) leaves at most an uncommitted folder that the next attempt
overwrites.

A version is either

* a **base**: the whole table (the first load, or a compaction), or
* a **layer**: one load's batch plus the key it upserts on.

A load writes only its batch (a layer), so its cost follows the batch,
not the target. Reading resolves the layers written since the last base:

* a base row survives unless a later keyed layer holds its key;
* a layer row survives unless a later keyed layer holds its key.

With ``last`` = the highest layer holding each key (an aggregate over the
layers only, small next to the base) and the base numbered below every
layer, that is one left join plus a filter over base and layers together,
however many layers there are. ``last`` is broadcast when the commit log's
row counts prove it small; otherwise AQE plans the join from measured
sizes. Null keys
never match, so null-keyed rows always survive. ``compact`` folds the
layers into a new base; ``should_compact`` asks for it once the layers
hold a tenth of the base's rows or number more than 16. Unkeyed layers
are plain appends.

Everything goes through Spark's own readers and writers, so the root can be
any shared file system the cluster uses. One writer per table at a time.
"""

from __future__ import annotations

import datetime as _dt
import os
import zlib
from collections.abc import Sequence

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import lossless_cast, widest
from tidemark.session import list_subdirs, path_exists

COMMITS = "_commits"
BASE, LAYER = "base", "layer"
COMMIT_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("committed_at", T.TimestampNTZType()),
    T.StructField("kind", T.StringType()),
    T.StructField("key_cols", T.StringType()),
    T.StructField("tag", T.StringType()),
])
TAGS = "_tags"
TAG_BUCKETS = 64
TAG_SCHEMA = T.StructType([T.StructField("tag", T.StringType())])
SEQ = "_tm_seq"
LAST = "_tm_last"


def _tag_bucket(tag: str) -> int:
    return zlib.crc32(tag.encode()) % TAG_BUCKETS


def _keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def widen_all(parts: list[DataFrame | None]) -> list[DataFrame | None]:
    """The parts with each column cast to the type that holds all parts' values."""
    types: dict[str, T.DataType] = {}
    for p in parts:
        for f in (p.schema.fields if p is not None else []):
            types[f.name] = widest(types[f.name], f.dataType) if f.name in types else f.dataType
    return [p if p is None else p.select(*[
        F.col(f"`{f.name}`") if f.dataType == types[f.name]
        else lossless_cast(F.col(f"`{f.name}`"), f.dataType, types[f.name]).alias(f.name)
        for f in p.schema.fields]) for p in parts]


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ commit log
    # The log is split into epochs, ``_commits/epoch=<n>``: a base starts a new
    # epoch (n = its version), layers join the latest one. A reader lists the
    # epoch folders once and reads only the newest, which holds at most one
    # base and the layers written since (bounded by the compaction policy),
    # so the log a reader touches does not grow with the table's history.

    def _log_root(self) -> str:
        return os.path.join(self.root, COMMITS)

    def _epochs(self) -> list[int]:
        names = list_subdirs(self.spark, self._log_root())
        if names is None:  # cannot list (Spark Connect): discover from the files
            try:
                df = self.spark.read.parquet(self._log_root())
                return sorted(int(r[0]) for r in df.select("epoch").distinct().collect())
            except AnalysisException:
                return []
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("epoch="))

    def _epoch_rows(self, epoch: int) -> list:
        path = os.path.join(self._log_root(), f"epoch={int(epoch)}")
        try:
            rows = self.spark.read.schema(COMMIT_SCHEMA).parquet(path).collect()
        except AnalysisException:
            return []
        return sorted(rows, key=lambda r: r["version"])

    def _active(self) -> list:
        """Commit rows of the newest epoch: its base (if any) and the layers
        written since, in version order."""
        epochs = self._epochs()
        return self._epoch_rows(epochs[-1]) if epochs else []

    def _commits(self) -> DataFrame | None:
        """The whole log (all epochs); for audits, not on the read path."""
        if not self._epochs():
            return None
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(
            *[os.path.join(self._log_root(), f"epoch={e}") for e in self._epochs()])

    def version_path(self, version: int) -> str:
        return os.path.join(self.root, f"v={int(version)}")

    def latest_version(self) -> int | None:
        rows = self._active()
        return int(rows[-1]["version"]) if rows else None

    def exists(self) -> bool:
        return self.latest_version() is not None

    def committed(self, version: int) -> bool:
        epochs = self._epochs()
        older = [e for e in epochs if e <= version]
        if not older:
            return False
        return any(r["version"] == version for r in self._epoch_rows(older[-1]))

    def has_tag(self, tag: str) -> bool:
        """Whether any commit carries ``tag`` (a run or micro-batch id), so a
        replayed load can be recognised and skipped, however late. The newest
        epoch's tags are in its commit rows; when a base opens a new epoch the
        older ones are first copied to a table of tags, partitioned by a hash,
        of which one partition is read."""
        if any(r["tag"] == tag for r in self._active()):
            return True
        path = os.path.join(self.root, TAGS, f"bucket={_tag_bucket(tag)}")
        if path_exists(self.spark, path) is False:
            return False
        try:
            return bool(self.spark.read.schema(TAG_SCHEMA).parquet(path).where(F.col("tag") == tag).take(1))
        except AnalysisException:
            return False

    def _keep_tags(self) -> None:
        rows = [(r["tag"], _tag_bucket(r["tag"])) for r in self._active() if r["tag"] is not None]
        if rows:
            (self.spark.createDataFrame(rows, T.StructType([*TAG_SCHEMA.fields, T.StructField("bucket", T.IntegerType())]))
             .coalesce(1).write.mode("append").partitionBy("bucket").parquet(os.path.join(self.root, TAGS)))

    def next_version(self) -> int:
        v = self.latest_version()
        return 0 if v is None else v + 1

    def layers_since_base(self) -> int:
        return sum(1 for r in self._active() if r["kind"] == LAYER)

    def should_compact(self, max_layers: int = 16, ratio: float = 0.1) -> bool:
        """Compaction policy: the layers hold at least ``ratio`` of the base's
        rows (reads pay for every layered row), or there are more than
        ``max_layers`` layers. A rewrite is thus amortised over loads
        worth a tenth of the table, whatever its size."""
        active = self._active()
        layers = [r for r in active if r["kind"] == LAYER]
        if not layers:
            return False
        if len(layers) > max_layers:
            return True
        base = [r for r in active if r["kind"] == BASE]
        base_rows = base[0]["rows"] if base else 0
        layer_rows = [r["rows"] for r in layers]
        if base_rows is None or any(n is None for n in layer_rows):
            return False
        return sum(layer_rows) >= ratio * max(base_rows, 1)

    # ------------------------------------------------------------------ read
    def read(self, version: int | None = None) -> DataFrame:
        """The table as of the latest commit (or as one stored version when
        ``version`` is given)."""
        if version is not None:
            return self.spark.read.parquet(self.version_path(version))
        active = self._active()
        if not active:
            raise FileNotFoundError(f"no committed version under {self.root}")
        base = [r for r in active if r["kind"] == BASE]
        layers = [r for r in active if r["kind"] == LAYER]
        base_df = self.spark.read.parquet(self.version_path(base[0]["version"])) if base else None
        if not layers:
            return base_df
        return self._resolve(base_df, layers)

    def _resolve(self, base_df: DataFrame | None, layers: list) -> DataFrame:
        keysets = {r["key_cols"] for r in layers if r["key_cols"]}
        if len(keysets) > 1:
            raise ValueError(f"layers of {self.root} use different keys: {sorted(keysets)}")
        ks = keysets.pop().split(",") if keysets else []
        parts = [self.spark.read.parquet(self.version_path(r["version"])) for r in layers]
        base_df, *parts = widen_all([base_df, *parts])
        parts = [p.withColumn(SEQ, F.lit(int(r["version"])).cast("bigint")) for p, r in zip(parts, layers)]
        stacked = parts[0]
        for p in parts[1:]:
            stacked = stacked.unionByName(p, allowMissingColumns=True)
        if base_df is not None:
            cols = list(base_df.columns) + [c for c in stacked.columns
                                            if c not in base_df.columns and c != SEQ]
        else:
            cols = [c for c in stacked.columns if c != SEQ]
        if not ks:  # appends only
            out = stacked.drop(SEQ)
            return (base_df.unionByName(out, allowMissingColumns=True) if base_df is not None
                    else out).select(*cols)
        keyed = {int(r["version"]) for r in layers if r["key_cols"]}
        not_null = F.lit(True)
        for k in ks:
            not_null = not_null & F.col(k).isNotNull()
        last = (stacked.where(F.col(SEQ).isin(*keyed) & not_null)
                .groupBy(*ks).agg(F.max(SEQ).alias(LAST)))
        if base_df is not None:
            # the base sorts before every layer, so one join resolves all rows
            stacked = base_df.withColumn(SEQ, F.lit(-1).cast("bigint")).unionByName(
                stacked, allowMissingColumns=True)
        return (stacked.join(last, ks, "left")
                .where(F.col(LAST).isNull() | (F.col(LAST) <= F.col(SEQ)))
                .select(*cols))

    # ----------------------------------------------------------------- write
    def _commit(self, version: int, rows, committed_at, kind: str, key_cols,
                tag: str | None = None) -> None:
        if kind == BASE:
            epoch = int(version)
            self._keep_tags()
        else:
            epochs = self._epochs()
            epoch = epochs[-1] if epochs else int(version)
        entry = self.spark.createDataFrame(
            [(int(version), rows, committed_at, kind, key_cols, tag)], COMMIT_SCHEMA)
        (entry.coalesce(1).write.mode("append")
         .parquet(os.path.join(self._log_root(), f"epoch={epoch}")))

    def write(self, df: DataFrame, version: int, rows: int | None = None,
              committed_at: _dt.datetime | None = None, check: bool = True,
              tag: str | None = None) -> int:
        """Write ``df`` as the whole table (a base) at ``version``."""
        if check and self.committed(version):
            raise ValueError(f"version {version} of {self.root} is already committed")
        rows = self._write_counted(df, version, rows)
        self._commit(version, rows, committed_at, BASE, None, tag)
        return version

    def _write_counted(self, df: DataFrame, version: int, rows: int | None) -> int:
        """Write a version's files; the row count is observed in the same pass."""
        if rows is not None:
            df.write.mode("overwrite").parquet(self.version_path(version))
            return rows
        obs = Observation(f"rows-{os.path.basename(self.root)}-{int(version)}-{uuid.uuid4().hex[:8]}")
        (df.observe(obs, F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").parquet(self.version_path(version)))
        return int(obs.get.get("n", 0))

    def write_layer(self, batch: DataFrame, version: int, key: str | Sequence[str] | None,
                    rows: int | None = None, committed_at: _dt.datetime | None = None,
                    check: bool = True, tag: str | None = None) -> int:
        """Upsert ``batch`` as a layer: later reads drop earlier rows whose
        key it holds (``key=None``: a plain append)."""
        if check and self.committed(version):
            raise ValueError(f"version {version} of {self.root} is already committed")
        rows = self._write_counted(batch, version, rows)
        ks = _keys(key)
        self._commit(version, rows, committed_at, LAYER, ",".join(ks) if ks else None, tag)
        return version

    def write_files(self, df: DataFrame, version: int) -> int:
        """Write a version's files, uncommitted, and return their row count."""
        return self._write_counted(df, version, None)

    def commit_files(self, version: int, rows: int, key: str | Sequence[str] | None = None,
                     base: bool = False, committed_at: _dt.datetime | None = None,
                     tag: str | None = None) -> None:
        """Commit files of ``write_files`` as a base or a layer."""
        ks = _keys(key)
        self._commit(version, rows, committed_at, BASE if base else LAYER, ",".join(ks) if ks else None, tag)

    def obsolete_paths(self, keep_bases: int = 2) -> list[str]:
        """Version folders that no reader needs: everything before the
        ``keep_bases``-th newest base (older bases stay for time travel and
        for readers still on them). Nothing is deleted here; the list is for
        the operator's own retention tooling."""
        epochs = self._epochs()
        if len(epochs) < keep_bases:
            return []
        cutoff = epochs[-keep_bases]
        old = [e for e in epochs if e < cutoff]
        versions = sorted({int(r["version"]) for e in old for r in self._epoch_rows(e)})
        return [self.version_path(v) for v in versions]

    def compact(self, version: int | None = None, committed_at: _dt.datetime | None = None) -> int:
        """Fold the layers into a new base (the resolved table)."""
        v = self.next_version() if version is None else version
        return self.write(self.read(), v, None, committed_at, check=False)

    def ensure(self, schema: T.StructType, committed_at: _dt.datetime | None = None) -> None:
        """Create the table empty with ``schema`` if it has no version (K1)."""
        if not self.exists():
            self.write(self.spark.createDataFrame([], schema), 0, 0, committed_at)
