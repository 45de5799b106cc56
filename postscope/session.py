"""Session helpers.

Library code never creates its own session; it receives one. ``get_session``
is for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8, **conf) -> SparkSession:
    builder = SparkSession.builder.master(master or "local[*]").appName("postscope")
    for k, v in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is; if it is unset there, this raises instead of falling back to a
    machine-local folder. Only in local mode (tests) is a fresh scratch folder
    chosen when it is unset.
    """
    try:
        current = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # not a SQL conf on some builds
        current = None
    current = current or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
            "(stream checkpoints and written tables must survive the loss of any machine)"
        )
    path = tempfile.mkdtemp(prefix="postscope-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def cluster_conf(input_bytes: int, total_cores: int, target_split_bytes: int = 256 << 20,
                 shuffle_bytes_per_partition: int = 256 << 20, shuffle_ratio: float = 0.1) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of posts.

    * input splits of ``target_split_bytes`` (JSON and Parquet alike);
    * shuffle partitions sized for the expected shuffle volume
      (``shuffle_ratio`` x input: the questions shuffle partially
      aggregated rows, a small fraction of the input) at
      ``shuffle_bytes_per_partition`` each, never fewer than 2 x cores;
      AQE coalesces what turns out smaller and splits skewed partitions.

    For 100 TB on 1000 executors x 8 cores this gives 256 MB splits
    (~400k scan tasks) and ~41,000 shuffle partitions of ~256 MB.
    """
    shuffle_parts = max(2 * total_cores, int(input_bytes * shuffle_ratio // shuffle_bytes_per_partition) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_bytes_per_partition // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
