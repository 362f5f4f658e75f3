"""Session settings for the jobs, and the shared folder they may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs want on a cluster: partitions are merged up to the advisory size at
# run time, as far as all cores stay busy, and split when skewed.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # What is small enough is broadcast by a hint, after its size was counted. A join that Spark turns
    # into a broadcast on its own leaves rows where few row groups put them, and with them the work behind it.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.session.timeZone": "UTC",
}

# Shuffles of a full load carry some 10 TB from 100,000 scan tasks: 2.5 GB per partition, sorted with
# spilling, so that a block from one task to another has 25 KB. Merged at run time where there is less. A local
# session goes without.
WIDE = {
    "spark.sql.files.maxPartitionBytes": "1g",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
}


def build_session(app: str) -> SparkSession:
    """The active session, or a new one with ``CLUSTER_CONF`` and without a web page; on a cluster
    also with ``WIDE``.

    What spark-submit was given stays as it is, the master included.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    spark = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").getOrCreate()
    given = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local")
    for key, value in (CLUSTER_CONF if local else CLUSTER_CONF | WIDE).items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without it; there a fresh folder is taken and set.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        # Spark puts a folder of its own name below the one it is given, so it is given it once.
        if getattr(context, "_fairwait_checkpoints", None) != configured:
            context.setCheckpointDir(configured)
            context._fairwait_checkpoints = configured
        return configured
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="fairwait-"))
    return context.getCheckpointDir()


def shared_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before, deleted when the session ends."""
    place = f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    files.deleteOnExit(path)
    return place
