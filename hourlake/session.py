"""Spark session defaults and the lineage-cutting helper.

The library never creates a session behind the caller's back: operators take
DataFrames. ``build_session`` is for tests, the bench and command-line use.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library relies on.  They are plain Spark
# configuration, set once per session.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a sort-merge join into a broadcast join only after it has
    # measured the materialised side: this is the size check for derived
    # dimensions, with the sort-merge join as the way beyond it.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "hourlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
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
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder comes from the session (a shared file system
    path).  Only when nothing is configured -- local tests -- a scratch
    folder under the system temp dir is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="hourlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a plan is reused by several actions (model folds, multi-step
    loads) so that a lost executor recomputes from the checkpoint rather
    than from the raw scan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for versioned tables written by the library.

    Defaults to a ``hourlake`` folder beside the checkpoint folder so it
    lives on the same shared file system on a cluster.
    """
    base = spark.conf.get("hourlake.warehouse.dir", None)
    if base:
        return base
    return f"{ensure_checkpoint_dir(spark)}/hourlake-warehouse"


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a given input volume.

    Scan splits and post-shuffle partitions both target ``partition_bytes``
    (256 MB default: fits comfortably in an executor core's share of memory
    with room for sort buffers), so 100 TB gives ~400k scan tasks and the
    shuffle starts at input / partition size, which AQE coalesces
    toward the advisory size at runtime.
    """
    n = max(1, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }
