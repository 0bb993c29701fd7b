"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every tripflow job relies on. Times carry no zone in the feeds, so the
# session zone is pinned to UTC; HOUR()/MONTH() of a timestamp_ntz never depend on it.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rebalance hints split hot partitions instead of writing one giant file.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Counts from footers; only scans of sources/statistics.py (DataSource V2) use it.
    "spark.sql.parquet.aggregatePushdown": "true",
    # Joins in tripflow have one side bounded by months or columns. No hint forces
    # a broadcast: the planner (local relations) or AQE (measured shuffle output)
    # broadcasts a side only under this size and falls back to sort-merge above it.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tripflow",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the tripflow defaults.

    On a cluster pass ``master=None`` and let the launcher decide; ``shuffle_partitions``
    is only a starting point because AQE coalesces small shuffle partitions at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the SQL options that can change on a live session (idempotent)."""
    for key, value in CORE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster names this folder; we only choose one ourselves when it is unset
    (local tests), and then register it so later ``checkpoint()`` calls use it too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or None
    if root is None:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
        if current:
            return current
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = os.path.join(os.environ.get("TMPDIR", "/tmp"), "tripflow-checkpoints")
        sc.setCheckpointDir(root)
    return root


def application_id(spark: SparkSession) -> str:
    """The running application's id, read from the session config."""
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared checkpoint root for intermediate tables."""
    root = checkpoint_root(spark).rstrip("/")
    leaf = "/".join(parts)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}"
    return f"{root}/tripflow/{leaf}"


def filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path of any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def cluster_conf(total_cores: int, input_bytes: int | None = None,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Sizing for a cluster run.

    Shuffle partitions start at 3x the cores, or at input / target size if that
    is larger (so a shuffle partition fits comfortably in executor memory and
    spills rarely); AQE then coalesces what turns out small and splits skew.
    Scan splits and rebalanced output files aim at ``target_partition_bytes``.
    """
    parts = 3 * total_cores
    if input_bytes:
        parts = max(parts, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * 1024 * 1024),
    }
