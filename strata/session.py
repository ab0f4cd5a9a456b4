"""Session construction (K7) and the shared checkpoint folder.

Nothing here knows about credentials: catalog, object store and connector
settings come in as a plain dict, so a deployment adds them without code.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Settings every session of ours gets unless the caller overrides them.
# AQE re-plans joins and aggregates from runtime sizes, coalesces small
# shuffle partitions and splits skewed join partitions; the broadcast
# threshold is Spark's own size check for joins we do not hint.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # JSON objects with a repeated key parse with the last value winning (as
    # Python's json module does) instead of failing to parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def sizing_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024,
                scan_split_bytes: int = 512 * 1024 * 1024) -> dict[str, str]:
    """Shuffle and scan sizing for a job over ``input_bytes`` on ``total_cores``.

    The initial shuffle partition count is chosen so that the largest shuffle
    (at most about the input size after column pruning) gives partitions near
    ``target_partition_bytes``, and never fewer than two waves of tasks; AQE
    then coalesces small partitions towards the same advisory size and splits
    skewed ones. Scans are split at ``scan_split_bytes``. For 100 TB on
    1,000 executors x 8 cores this gives 409,600 shuffle partitions before
    coalescing and 204,800 scan splits.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
    }


def session_conf(conf: Mapping[str, str] | None = None, input_bytes: int | None = None,
                 total_cores: int | None = None) -> dict[str, str]:
    """Our defaults, then sizing for the input (when given), then ``conf``."""
    merged = dict(DEFAULT_CONF)
    if input_bytes is not None and total_cores:
        merged.update(sizing_conf(input_bytes, total_cores))
    merged.update(conf or {})
    return merged


def build_session(
    app_name: str = "strata",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Return a session with our defaults (sized for ``input_bytes`` on
    ``total_cores`` when both are given); ``conf`` wins over both."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in session_conf(conf, input_bytes, total_cores).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; we read it from the session and never replace it. Where it is unset
    a local session gets a fresh temporary folder, and a cluster an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = None
    try:
        context = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext in a remote (Connect) session
        pass
    if not configured and context is not None:
        configured = context.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if context is not None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if context is not None and context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    leaf = "-".join(parts + (uuid.uuid4().hex[:12],)) if parts else uuid.uuid4().hex
    return f"{root.rstrip('/')}/strata/{leaf}"
