"""Spark session helpers.

The library never hard-codes cluster settings: on a cluster the session is
built by the deployment and we only read from it.  ``get_session`` exists for
tests, the bench and the command line, where nothing else builds one.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the query plans rely on.  AQE re-plans joins from runtime sizes
# (so a dimension is broadcast only when it is measured to be small, and a
# sort-merge join is kept otherwise), splits skewed join partitions, and
# coalesces small shuffle partitions.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Shuffled bytes (compressed) and bytes of files that a task reads where every key is held, and shuffle
#: partitions to make such tasks of.
TASK_BYTES, TASK_FILE_BYTES, TASK_PARTITIONS = 4 << 20, 32 << 20, 400


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "hirelens") -> SparkSession:
    """Build (or reuse) a session with the settings the plans assume."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("HIRELENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        # Checkpoint files go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in PLAN_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_plan_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (driver-built)."""
    for key, value in PLAN_CONF.items():
        if spark.conf.isModifiable(key):  # static settings stay as deployed
            spark.conf.set(key, value)


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit]


def small_shuffle_tasks(spark: SparkSession) -> None:
    """Aggregates over nearly unique keys hold all that a task reads.  AQE merges
    a shuffle's partitions until there are as few as cores, up to 64 MB each, and
    a task's memory then grows with the input; from here on tasks read at most
    ``TASK_BYTES`` (less, if the session says so), and large inputs make more tasks.
    """
    for key, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES),
                      ("spark.sql.files.maxPartitionBytes", TASK_FILE_BYTES)):
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, most)
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    partitions = int(spark.conf.get(first, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if partitions < TASK_PARTITIONS:
        spark.conf.set(first, TASK_PARTITIONS)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    (local tests, the bench) do we pick a fresh scratch folder ourselves.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="hirelens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh output location under the shared checkpoint folder."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/hirelens-out/{name}-{uuid.uuid4().hex[:12]}"
