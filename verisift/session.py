"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Whether a write's shuffle files go when it is done, instead of when the driver happens to collect garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "verisift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are designed for.

    On a cluster leave ``master`` unset so spark-submit decides. AQE sizes and
    splits the shuffle partitions at run time, so no partition count is fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine: on a
    cluster the executors would not see it, so there the setting is mandatory.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_CONF
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    chosen = tempfile.mkdtemp(prefix="verisift-")
    spark.conf.set(CHECKPOINT_CONF, chosen)
    return chosen


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder; never reused, so reruns cannot collide."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def write_scratch(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table and read it again; the shuffle files of the write go with it.

    What was written is read from its files, so nothing needs these shuffles again.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP_CONF, None)
    conf.set(CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP_CONF) if before is None else conf.set(CLEANUP_CONF, before)
    return df.sparkSession.read.parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``write_scratch`` to a fresh path."""
    return write_scratch(df, scratch_path(df.sparkSession, label))


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing will read again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point reliable checkpoints at the scratch folder unless the cluster already did."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(spark))
