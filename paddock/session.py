"""Session defaults and shared scratch locations.

Nothing here runs at import time; callers build the session explicitly.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  The time zone is pinned so
# ``to_date`` / ``year`` on TIMESTAMP columns do not depend on the host.
# Automatic, estimate-based broadcast is off: dimensions are broadcast only
# after ``operators.joins.dimension`` has measured them.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # Checkpoint files of upserts are removed once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster (hundreds of executors, tens of TB per run).
# Shuffles start wide and AQE merges them towards the advisory size; raw files are
# split at the same size; a partition counts as skewed from 1 GB and 5x the median
# and is then split.  4,000 partitions keep a task at the advisory size up to 1 TB in one
# shuffle; for more pass ``shuffle_bytes`` (the star join doesn't shuffle the fact, but a
# first load's partitioned write does).
ADVISORY_BYTES = 256 << 20
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ADVISORY_BYTES),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "8m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def build_session(
    master: str | None = None,
    app_name: str = "paddock",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    profile: str = "local",
    shuffle_bytes: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied.

    ``profile="cluster"`` adds ``CLUSTER_CONF``; explicit arguments win.  ``shuffle_bytes``, the most that one
    shuffle is expected to carry, widens its shuffles to partitions of the advisory size.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_bytes is not None:
        wide = -(-shuffle_bytes // ADVISORY_BYTES)
        conf["spark.sql.shuffle.partitions"] = str(max(wide, int(conf.get("spark.sql.shuffle.partitions", "200"))))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None under Spark Connect (which has none)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``; that value always wins.
    Only when it is unset *and* the master is local (tests, local runs) a fresh
    temporary folder is created and registered; on a cluster an unset value is
    an error, so staged data never lands in a machine-local folder.
    """
    sc = _context(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc is None:
        # Spark Connect: the server's own setting is used by checkpoint().
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must be set on the Spark Connect server")
        return configured.rstrip("/")
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if not current:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        # SparkContext appends a random sub-folder; use its parent as root.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name a shared "
            "folder (staged tables and checkpoints are read back by other executors)"
        )
    local = tempfile.mkdtemp(prefix="paddock-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the checkpoint root for staged tables."""
    root = checkpoint_root(spark)
    return f"{root}/paddock-scratch/{name}-{uuid.uuid4().hex[:12]}"


def unique_table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
