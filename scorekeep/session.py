"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipelines rely on.  Cluster jobs pass their own shuffle
# partition count (sized so one partition is ~128-256 MB of shuffle data);
# AQE then coalesces small partitions and splits skewed ones at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when a later step then needs its
    # own shuffle (that shuffle carries partial aggregates only)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # broadcasts only on a proven size: the planner's estimate-based broadcast
    # is off; sides are hinted after a size probe (plans.broadcast), and AQE
    # may still broadcast a side once it has measured its real shuffle output.
    # That measure is compressed bytes, so its bound is kept small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # compiled whole-stage code is kept for reuse; the default (100 classes)
    # is exceeded by the pipelines' stages, and recompiling a wide
    # aggregation costs about a second per stage
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def build_session(app: str = "scorekeep", master: str | None = None,
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir`` (shared storage every
    executor can reach); that setting is used as it is.  Only when it is
    unset (local tests) is a fresh folder made here.
    """
    try:
        sc = spark.sparkContext
    except Exception:   # Spark Connect: no context here; the setting must be given
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not is_local_master(spark):
            # a driver-local folder is invisible to executors on other hosts
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage "
                               "(every executor must reach it)")
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Sources of more files than this are looked at anew each time: listing their states would cost more.
MOST_FILES = 200


def files_state(df) -> int | None:
    """A digest of the name, size and time of change of every file that df reads; None where it has no files,
    too many, or none that can be asked."""
    try:
        spark, files = df.sparkSession, sorted(df.inputFiles())
        if not files or len(files) > MOST_FILES:
            return None
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        states = []
        for name in files:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
            status = path.getFileSystem(conf).getFileStatus(path)
            states.append((name, status.getLen(), status.getModificationTime()))
        return hash(tuple(states))
    except Exception:   # a session without access to plan or files
        return None


def is_local_master(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


__all__ = ["build_session", "ensure_checkpoint_dir", "files_state", "scratch_path", "is_local_master"]
