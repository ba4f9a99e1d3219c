"""Session construction and the shared working folder.

Intermediate tables (snapshots, quarantine, exports, streaming checkpoints)
are written under the folder the cluster names in ``spark.checkpoint.dir``.
That folder must be shared storage on a cluster; a machine-local temporary
folder is only created when the setting is absent *and* Spark runs in local
mode (tests, the laptop).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def cluster_conf(
    initial_shuffle_partitions: int = 16384,
    partition_bytes: str = "256m",
    broadcast_bytes: str = "64m",
) -> dict[str, str]:
    """Settings for a large cluster (thousands of cores, ~100 TB inputs).

    Shuffles start wide (``initialPartitionNum``) and AQE coalesces them to
    ``partition_bytes`` per task from the real map-output sizes, so a task's
    input fits executor memory at any scale; file splits have the same size;
    a shuffle partition more than 5× the median (and over the size) is split
    by the skew-join rule; only relations under ``broadcast_bytes`` are
    broadcast by the planner.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial_shuffle_partitions),
        "spark.sql.shuffle.partitions": str(initial_shuffle_partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": partition_bytes,
        "spark.sql.files.maxPartitionBytes": partition_bytes,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": partition_bytes,
        "spark.sql.autoBroadcastJoinThreshold": broadcast_bytes,
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.periodicGC.interval": "5min",
    }


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "farelake",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the library is designed for.

    AQE stays on (coalescing, skew-join splitting, runtime broadcast
    conversion); the session time zone is UTC so that any zoned timestamp
    buckets the same way ``window`` does.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # long-running drivers: let the context cleaner release broadcast
        # blocks and shuffle files of finished queries promptly
        .config("spark.cleaner.periodicGC.interval", "1min")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    value = sc.getConf().get("spark.checkpoint.dir", None)
    if value:
        return value
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - unset key raises on some versions
        return None


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared working folder (``spark.checkpoint.dir``).

    Only when the setting is unset and the master is local, a fresh local
    folder is created and registered as the checkpoint dir.
    """
    configured = _configured_checkpoint_dir(spark)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: configure a folder on shared "
            "storage that every executor can reach"
        )
    local = tempfile.mkdtemp(prefix="farelake-")
    spark.sparkContext.setCheckpointDir(local)
    # setCheckpointDir creates a uuid sub-folder; later calls resolve to it.
    return _configured_checkpoint_dir(spark).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder path under the shared working folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``farelake`` importable in the Python workers (``--py-files``).

    Needed before any Python UDF of the library runs; done once per
    application. The archive is written under the shared folder and handed
    to ``addPyFile``; Spark distributes it to every executor.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    target = scratch_path(spark, "pyfiles")
    local_target = target[len("file:"):] if target.startswith("file:") else target
    if "://" in local_target:
        # remote shared storage: the archive is built on the driver and Spark
        # itself serves it to the executors (as with --py-files); executors
        # never read the driver's disk
        local_target = tempfile.mkdtemp(prefix="farelake-pyfiles-")
    os.makedirs(local_target, exist_ok=True)
    archive = os.path.join(local_target, "farelake.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(package_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(package_dir)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
