"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime re-planning. forceOptimizeSkewedJoin lets Spark split a hot join key even where the
# operator above the join could have reused its partitioning (one more shuffle, no straggler).
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Most that one task reads of a file or of merged shuffle blocks. Compressed columns grow many times over in sorts and hash
# maps; with Spark's 128 and 64 MB the memory of a task grows with the input until it spills.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
}


def build_session(app: str = "marketlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.bindAddress", "127.0.0.1"
            )
    for key, value in {**SCALE_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_scale_settings(spark: SparkSession) -> SparkSession:
    for key, value in SCALE_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in TASK_BYTES.items():
        if in_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return spark


def size_shuffles(spark: SparkSession, input_gb: float, partition_mb: int = 256) -> int:
    """Enough shuffle partitions that one holds about ``partition_mb`` of an input of ``input_gb``.

    The default of 200 would make partitions of 500 GB out of 100 TB. Asking for too many is harmless:
    Spark merges small ones at run time. Never lowers a setting. A larger ``partition_mb`` gives fewer, larger blocks.
    """
    wanted = int(input_gb * 1024 / partition_mb) + 1
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local master without that setting gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="marketlens-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
