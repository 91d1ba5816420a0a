"""Session construction and the shared folder used for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes (broadcast only
# when the measured side is under the threshold), splits skewed shuffle partitions and
# coalesces small ones.  Shuffle partitions are an upper bound that AQE coalesces.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # smaller files than the default snappy at similar speed: less storage and scan I/O
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "leadscope",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FOLDERS: "weakref.WeakKeyDictionary[SparkSession, str]" = weakref.WeakKeyDictionary()


def is_local_master(master: str | None) -> bool:
    return bool(master) and master.startswith("local")


def _master(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.master
    except Exception:  # Spark Connect: no context
        return spark.conf.get("spark.master", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` (or set on the context) is used as is.
    Only when neither is set *and* Spark runs in local mode – tests – a private folder is
    created (once per session).  On a cluster an unset folder is an error: executors would
    otherwise write intermediate tables to their own local disks.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context; the server-side setting is authoritative
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None
                  else spark.conf.get("spark.checkpoint.dir", None))
    if not configured:
        if not is_local_master(_master(spark)):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder every executor can reach")
        configured = _LOCAL_FOLDERS.get(spark)
        if configured is None:
            configured = tempfile.mkdtemp(prefix="leadscope-ckpt-")
            _LOCAL_FOLDERS[spark] = configured
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex)
    return "/".join([base, "leadscope", *tail]) if tail else base


def env_master(default: str = "local[8]") -> str:
    cpus = os.environ.get("BENCH_CPUS")
    return f"local[{cpus}]" if cpus else default
