"""Session construction and the shared work folder.

Streaming checkpoints, sink folders and saved models must live in storage
every executor (and a restarted driver) can reach.  On a cluster that is the
folder named by ``spark.checkpoint.dir``; we only create a folder of our own
when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_UNSET = "__unset__"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    master: str | None = None,
    app_name: str = "ratewave",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    state_store: str | None = None,
) -> SparkSession:
    """Return a session with the settings every ratewave job assumes.

    Only settings that change results (UTC session time zone) or that are
    safe at any scale (AQE, skew-join splitting) are forced here; sizing
    (memory, shuffle width) is left to the launcher unless given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if state_store == "rocksdb":
        # Window state off the JVM heap: large keyed state without GC pauses.
        conf["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin this session's time zone: event times and windows are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def utc_session(spark: SparkSession) -> SparkSession:
    """``spark`` itself if its time zone is UTC, else a session beside it that is set
    alike but for the zone, so that the caller's own session stays as it is."""
    if spark.conf.get("spark.sql.session.timeZone") == "UTC":
        return spark
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    use_utc(own)
    return own


def _one_process(master: str) -> bool:
    """Whether driver and executors are one process, so that a folder of this machine is shared."""
    return master == "local" or master.startswith("local[")


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", _UNSET)
    if configured == _UNSET:
        configured = spark.conf.get("spark.checkpoint.dir", _UNSET)
    if configured == _UNSET or not configured:
        if not _one_process(sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: streams, models and tables need a folder that "
                "the driver and all executors share"
            )
        configured = tempfile.mkdtemp(prefix="ratewave-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the cluster's shared checkpoint folder.

    ``unique=True`` appends a fresh id, for one-off runs (each test or
    registered query gets its own stream checkpoint and output).  Such paths
    lie in one folder per application, which can go when the application has
    ended; results that are read lazily need it until then.
    """
    root = _checkpoint_root(spark)
    pieces = [root, "ratewave", *parts]
    if unique:
        pieces = [root, "ratewave", spark.sparkContext.applicationId, *parts, uuid.uuid4().hex]
    path = "/".join(p.rstrip("/") for p in pieces)
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file systems, wherever it is; none is no error."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts lineage with a durable copy: later jobs (several model fits and
    evaluations) read the compact table instead of recomputing the joins
    behind it, and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "tables", name, unique=True)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
