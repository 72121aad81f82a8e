"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (a
# broadcast only happens when the measured side is under the threshold) and
# splits skewed shuffle partitions, so a hot event or order does not land in
# one task.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    # as shuffled; a task that sorts and aggregates such rows takes some fifty times that in memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # hive-style `day=05` must stay text, not become the integer 5
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # colliding fee keys after slugging: the later key wins, as in a Ruby hash
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.parquet.filterPushdown": "true",
    # the state of a stream lies on disk, not in the heap, and a batch checkpoints its changes only
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Suggested settings for a large cluster (about 100 TB of input): many initial
# shuffle partitions that AQE coalesces to ~128 MB, larger scan splits, and a
# broadcast threshold that still only admits sides measured small at runtime.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "boxoffice") -> SparkSession:
    """Return a session with the engine's settings.

    Without ``master`` (spark-submit on a cluster) the cluster settings above
    apply too; locally (tests, bench) pass ``master`` and a small
    ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if not master:
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
    if master:
        builder = (builder.master(master)
                   .config("spark.driver.host", "127.0.0.1")
                   .config("spark.driver.bindAddress", "127.0.0.1")
                   .config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false")
                   .config("spark.driver.memory", "8g"))
    for k, v in BASE_CONF.items():
        if master or k not in CLUSTER_CONF:
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (e.g. the driver's)."""
    for k, v in BASE_CONF.items():
        spark.conf.set(k, v)


# Input bytes for each partition that a shuffle may have at first; AQE joins those that turn out small.
INPUT_SHARE = 2 << 20


def first_partitions(spark: SparkSession, input_bytes: int) -> int:
    """Partitions of a shuffle before AQE joins the small ones: by the size of the input, so that what
    a task sorts or aggregates does not grow with it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), input_bytes // INPUT_SHARE)


def is_local(spark: SparkSession) -> bool:
    """One process holds driver and executors (tests, bench), so a local folder is shared."""
    return re.match(r"local(\[|$)", spark.conf.get("spark.master", "")) is not None


_LOCAL_CKPT: dict[str, str] = {}  # application id -> folder of a local session without the setting


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name it; only a local session without the setting (tests)
    gets a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.conf.get("spark.app.id")
        d = _LOCAL_CKPT.setdefault(app, _LOCAL_CKPT.get(app) or tempfile.mkdtemp(prefix="boxoffice-ckpt-"))
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)
