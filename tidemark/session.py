"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (so a
# side is broadcast only after Spark has measured it), coalesces small
# shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return the active session, creating one with the defaults above.

    On a cluster the launcher owns master and sizing; here we only fill in
    what is unset so a cluster's own configuration always wins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("_", "."), v)
    spark = builder.getOrCreate()
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is used as given. Only when it is unset and the
    session runs in local mode (tests) do we make a folder of our own; on a
    cluster an unset setting is an error, never a machine-local folder.
    Works on a classic session and on a Spark Connect session.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        sc = None
    configured = sc.getCheckpointDir() if sc is not None else None
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if master != "local" and not master.startswith("local["):
            # executors could not see a folder on the driver's disk
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)


def fresh_scratch(spark: SparkSession, prefix: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    import uuid
    return scratch_path(spark, f"{prefix}-{uuid.uuid4().hex}")


def materialize(df, path: str, count: bool = False):
    """Write ``df`` to ``path`` and read it back: the lineage is cut at a
    table in the shared folder, which survives lost executors and is
    computed once (an eager ``checkpoint()`` computes its input twice).
    With ``count`` the row count, observed during the write, is returned too.
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    spark = df.sparkSession
    if count:
        obs = Observation(f"materialize-{os.path.basename(path)}")
        df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path), int(obs.get.get("n", 0))
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists on the cluster's file system (any Hadoop
    file system: HDFS, object stores, local). None when it cannot be asked
    (Spark Connect); callers then try the read."""
    try:
        jvm = spark._jvm  # classic sessions only
        conf = spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(conf).exists(p))
    except Exception:
        return None


def list_subdirs(spark: SparkSession, path: str) -> list[str] | None:
    """Names of the folders directly under ``path`` (one listing call, not
    recursive); [] when ``path`` is missing, None when it cannot be asked
    (Spark Connect)."""
    try:
        jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            return []
        return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    except Exception:
        return None


def is_dir(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder (a table written by Spark) rather than a
    single file, on the cluster's file system."""
    try:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())
    except Exception:
        return os.path.isdir(path)
