"""Session defaults and the shared folder for lineage cuts and mart output."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; every one is also the right choice on local[N].
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "ledgerlake") -> SparkSession:
    """Session for tests and the local bench (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerlake-warehouse-"))
               .config("spark.ui.showConsoleProgress", "false"))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by every executor: the cluster's ``spark.checkpoint.dir``.

    On a cluster this setting names durable shared storage and is always
    read, never replaced; if it is unset there, this fails rather than fall
    back to a folder only the driver can see.  Only in local mode (tests)
    is a scratch folder created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name storage shared by all executors")
        current = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def settings_for_volume(input_bytes: int, partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Shuffle and split sizes for a run over ``input_bytes`` of input.

    AQE can coalesce shuffle partitions and split skewed ones, but it cannot
    create partitions: the initial count must be large enough that an
    average partition fits an executor's memory share.  At 100 TB and 256 MB
    per partition that is ~400k shuffle partitions.
    """
    parts = max(8, -(-int(input_bytes) // partition_bytes))
    size = str(partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def input_bytes(frames) -> int:
    """Summed size of the frames' inputs as the optimizer estimates it (file sizes for scans)."""
    return sum(int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in frames)


def apply_settings(spark: SparkSession, volume: int) -> dict[str, str]:
    """Sets the session defaults and the sizes for ``volume`` bytes of input; returns what was set."""
    settings = {k: v for k, v in SESSION_DEFAULTS.items() if k.startswith("spark.sql.")}
    settings |= settings_for_volume(volume)
    for key, value in settings.items():
        spark.conf.set(key, value)
    return settings
