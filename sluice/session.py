"""SparkSession defaults and the shared scratch location.

Scratch output (CSV round trips, staged tables, stream sinks and
checkpoints) always goes below the folder the cluster names in
``spark.checkpoint.dir``. A private folder is only created when that
setting is absent, which is the case in unit tests on one machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job relies on.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Broadcast only proven sizes: explicit hints after a row-count check, or
    # AQE's run-time conversion of a join whose measured side is small.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster (100 TB inputs): many shuffle partitions that AQE
# coalesces to ~256 MB each, so no task holds more than it can sort in memory;
# skewed partitions above 1 GB are split; input splits of 256 MB; broadcasts
# only of sizes that were checked or measured.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "256m",
    # No broadcast on planner estimates; only row-count-checked hints, or AQE
    # on shuffle output sizes measured at run time.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.broadcastTimeout": "900",
}


def get_spark(master: str | None = None, app: str = "sluice", shuffle_partitions: int | None = None,
              extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """A session with the library's defaults; ``cluster=True`` adds the
    large-cluster sizing of ``CLUSTER_CONF``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _conf_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - no SparkContext on a Spark Connect session
        return None


def _private_dir(spark: SparkSession) -> str:
    """A folder of this machine, for sessions whose tasks all run on it; anything else must name a shared one."""
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="sluice-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder. Only a local session may leave it unset and gets a private one."""
    conf_dir = _conf_checkpoint_dir(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the setting
        if not conf_dir:
            conf_dir = _private_dir(spark)
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(conf_dir or _private_dir(spark))
    return sc.getCheckpointDir()


def scratch_root(spark: SparkSession) -> str:
    conf_dir = _conf_checkpoint_dir(spark)
    if conf_dir:
        return conf_dir.rstrip("/")
    return ensure_checkpoint_dir(spark).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch root; whoever writes to it creates it.

    Everything lies below ``<root>/sluice/<application id>/``. That folder
    belongs to the application: results that are read lazily need it until
    they have been consumed, and it can be deleted as a whole when the
    application has ended.
    """
    try:
        owner = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect
        owner = "connect"
    return f"{scratch_root(spark)}/sluice/{owner}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "materialized"):
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and
    read it back.

    Used where several branches of one plan consume the same intermediate
    (the input is scanned once) and where later steps need rows that do not
    change between evaluations. Lineage is cut: a lost executor costs a
    re-read of committed files, not a recomputation. Parquet rather than an
    RDD checkpoint keeps the copy columnar and compressed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # no pass over the files to find the schema


def spread(df, tasks: int | None = None):
    """Spread rows over ``tasks`` before CPU-heavy per-row work.

    A local session reads a small table as one split; a round-robin
    repartition (deterministic on retry: Spark sorts before it) lets every
    core work. On a cluster the input splits are many and the plan is left
    as it is unless ``tasks`` is given.
    """
    if tasks is None:
        master = df.sparkSession.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            return df
        tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks)
