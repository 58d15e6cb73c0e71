"""Session helper for local runs and tests (UI off, AQE on)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "casewatch") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture costs several Py4J round trips per function call
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, min_partitions: int = 200) -> dict[str, str]:
    """Session settings sized for an input of ``input_bytes`` on a cluster.

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` of
    input each, so a task's share fits executor memory whatever the scale
    (100 TB at 256 MiB gives about 400,000 shuffle partitions, which AQE then
    coalesces to the measured sizes). Skewed join keys are split at run time;
    aggregations rely on partial (map-side) aggregation instead."""
    partitions = max(min_partitions, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
    }
