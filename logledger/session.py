"""Session helpers: one builder for jobs and tests, and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import time
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Timestamps are compared across engines, so the
# session clock is pinned to UTC; AQE re-plans joins and coalesces small
# shuffle partitions at run time; skew join splits hot join keys.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "logledger",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return a session with :data:`DEFAULT_CONF` applied.

    ``master`` is only set when given (spark-submit supplies it on a cluster).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not shuffle_partitions and "spark.sql.shuffle.partitions" not in (extra or {}):
        size_shuffles(spark)
    ensure_checkpoint_dir(spark)
    return spark


PARTITIONS_PER_CORE = 4


def size_shuffles(spark: SparkSession) -> int:
    """Start every shuffle with at least 4 partitions per core of the cluster.

    Spark's default of 200 would make 500 GB partitions out of a 100 TB
    shuffle; AQE can only merge partitions, so the start must be fine-grained
    and AQE coalesces the small ones toward ``advisoryPartitionSizeInBytes``.
    A value set by the deployment is kept when it is larger.
    """
    cores = spark.sparkContext.defaultParallelism
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    n = max(current, PARTITIONS_PER_CORE * cores)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def pin_utc(spark: SparkSession) -> None:
    """Session time zone to UTC (runtime-settable; parquet timestamps are UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage;
    it is read, never overridden, and a missing setting is an error.  Only in
    local mode (tests, one machine) an unset value falls back to a folder
    under the system temp dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                               "for checkpoints and scratch output on a cluster")
        import tempfile
        d = tempfile.mkdtemp(prefix="logledger-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the application's own part of the shared checkpoint folder."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{spark.sparkContext.applicationId}"


FORGET_PAUSE = 0.5  # seconds


def forget_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove finished jobs' shuffle files, which it does once the driver's frames of them are collected.

    A job that has just ended is still held by events under way, so a
    collection at once frees the jobs before it only: there is a second one, a
    moment later."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(FORGET_PAUSE)


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a folder on any store that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    store, place = hadoop_path(spark, path)
    store.delete(place, True)


def remove_scratch(spark: SparkSession) -> None:
    """Deletes what :func:`scratch_path` named in this application; for its end, when all results have been read."""
    remove_folder(spark, _scratch_folder(spark))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
