"""Session settings shared by every job.

The strict flags keep a corrupt or missing file from being skipped silently,
and keep row counts coming from decoded data rather than Parquet footers.
AQE stays on so joins and shuffles are re-planned from runtime sizes
(broadcast conversion, partition coalescing, skew splitting).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this library pins.
STRICT_SETTINGS = {
    "spark.sql.files.ignoreCorruptFiles": "false",
    "spark.sql.files.ignoreMissingFiles": "false",
    "spark.sql.parquet.aggregatePushdown": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "intactly",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Returns a session with the strict settings applied.

    ``master`` and ``shuffle_partitions`` are only for local runs and tests;
    on a cluster they come from the submit configuration.
    """
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**STRICT_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_strict(spark)
    return spark


# Partition sizing targets for large runs.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
MAX_SPLIT_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 200_000


def scale_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Partition sizing for a run reading ``input_bytes`` on ``total_cores`` cores.

    The initial shuffle partition count is sized so each reduce partition
    starts near 128 MiB (at least two waves of tasks); AQE then coalesces
    small partitions and splits skewed ones at run time, which it can only
    do well when the initial partitions are fine-grained.
    """
    by_size = -(-input_bytes // TARGET_PARTITION_BYTES)
    partitions = min(MAX_SHUFFLE_PARTITIONS, max(2 * total_cores, by_size))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(MAX_SPLIT_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * MAX_SPLIT_BYTES),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def apply_strict(spark: SparkSession) -> None:
    """Pins the strict settings on an existing session (they are runtime confs)."""
    for key, value in STRICT_SETTINGS.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at storage every executor can reach;
    without it this raises. In local mode a fresh local folder is created and
    recorded in the session instead.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to storage that every executor shares")
        configured = tempfile.mkdtemp(prefix="intactly-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run of one job."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def to_uri(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path)
