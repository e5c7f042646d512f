"""Session helpers.

Library code never builds its own session: callers own it.  ``local_session``
exists for tests, the bench and the smoke entry point only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every quarry job relies on.  AQE does the runtime work that a
# hand-written plan would otherwise guess at: coalescing small shuffle
# partitions, turning a sort-merge join into a broadcast join when the measured
# build side is small, and splitting skewed partitions of a sort-merge join.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 ** 2,
                           minimum: int = 200) -> int:
    """Initial ``spark.sql.shuffle.partitions`` for an input of ``input_bytes``.

    AQE only merges partitions (and splits skewed join partitions), so the
    initial count must be large enough for the biggest shuffle: about one
    partition per ``target_bytes`` of input (100 TB -> ~400k).
    """
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))


def cluster_conf(input_bytes: int) -> dict:
    """Settings to pass when building a cluster session for ``input_bytes`` of input."""
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes))
    conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(256 * 1024 ** 2)
    conf["spark.sql.files.maxPartitionBytes"] = str(256 * 1024 ** 2)
    return conf


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "quarry") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)  # the configured folder, or a fresh one if unset
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (None when unset)."""
    value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        value = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - connect sessions
        value = None
    return value or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; create a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only a local test session without one gets a fresh folder under
    the system temp dir.
    """
    current = checkpoint_dir(spark)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    # Unset: acceptable for a local (test) session only.
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local "
                           "folder does not survive a lost executor")
    path = tempfile.mkdtemp(prefix="quarry-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a lineage-cutting table inside the shared checkpoint folder.

    Tables sit under the application id, so concurrent applications sharing
    the folder never overwrite each other's tables.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{spark.sparkContext.applicationId}/{name}"
