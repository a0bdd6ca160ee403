"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "txpulse",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings every txpulse job assumes.

    On a cluster pass ``master=None`` and size ``shuffle_partitions`` to the
    input (about one partition per 128 MB of shuffled data); AQE coalesces
    what turns out smaller and splits skewed partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.metricsEnabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.ui.enabled": "false",
        # checkpointed summaries are deleted once nothing references them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and written tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only a local
    session with nothing configured gets a fresh private folder, as in tests;
    a cluster session without the setting is an error, since a machine-local
    folder would not survive the loss of an executor.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; a cluster job needs a shared folder"
            )
        root = tempfile.mkdtemp(prefix="txpulse-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        # setCheckpointDir adds a unique child folder; use what it settled on
        root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint root for one job's output."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
