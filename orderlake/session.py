"""SparkSession construction and shared-folder helpers.

On a cluster the session comes from the platform; ``apply_defaults`` only
fills in settings that are unset. ``spark.checkpoint.dir`` is read from the session;
a scratch folder is created only where it is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a job of this library relies on. They are defaults, never overrides
# of what the cluster already set (see ``apply_defaults``).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # What a task reads of a shuffle: sorts and hash tables over it take 13 times as much
    # memory, so the size of a task stays the same as the input grows.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Runtime bloom filters prune the large side of a join (e.g. stocks
    # against the lines of recent orders) before it is shuffled.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # spark.sql.autoBroadcastJoinThreshold keeps Spark's default: a join side
    # is broadcast only when its estimated size is under it, and AQE re-checks
    # on measured shuffle sizes; larger sides use sort-merge joins. Explicit
    # broadcast hints are used only on sides with a proven row bound.
    "spark.sql.parquet.filterPushdown": "true",
}

# Static settings used only when this process creates a local session.
LOCAL_ONLY_CONF = {"spark.ui.enabled": "false"}


def apply_defaults(spark: SparkSession) -> None:
    """Set each of ``DEFAULT_CONF`` only where the session has no value for
    it, so settings from the cluster or the caller always win."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def get_session(master: str | None = None, app_name: str = "orderlake",
                shuffle_partitions: int | None = None) -> SparkSession:
    """The active session (or a new local one when ``master`` is given),
    with the library defaults filled in where unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        for k, v in LOCAL_ONLY_CONF.items():
            builder = builder.config(k, v)
        builder = builder.config("spark.driver.memory", os.environ.get("ORDERLAKE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    apply_defaults(spark)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is a static setting: it is read, never written.
    Only when neither it nor a context checkpoint folder is set (local runs,
    tests) is a scratch folder created and registered with the context.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="orderlake-ckpt-")
    sc.setCheckpointDir(d)
    return d


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """Folder for a written intermediate table, under the shared checkpoint dir."""
    return f"{_scratch_root(spark)}/{name}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, when none of its results is read any more."""
    drop_folder(spark, _scratch_root(spark))


def drop_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a job within has shuffled is deleted when it ends. Else it stays on disk until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def folder_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and
    read it back: later stages start from durable, columnar data (no
    recomputation, no lineage replay when an executor is lost, and readers
    can prune columns)."""
    import uuid
    path = scratch_table_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
