"""Session settings, the shared scratch folder and size limits."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# A group with more rows than this is split over several tasks.
HOT_ROWS_CONF = "spark.cohortspark.hotRows"
HOT_ROWS_DEFAULT = 1_000_000

# A side of a join is broadcast by hint only below this counted number of rows.
BROADCAST_ROWS_CONF = "spark.cohortspark.broadcastRows"
BROADCAST_ROWS_DEFAULT = 200_000

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that costs one more shuffle later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.timeType.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators count on."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "cohortspark", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    # checkpoints of finished loop rounds are removed once nothing refers to them
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def int_conf(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def hot_rows(spark: SparkSession) -> int:
    return int_conf(spark, HOT_ROWS_CONF, HOT_ROWS_DEFAULT)


def broadcast_rows(spark: SparkSession) -> int:
    return int_conf(spark, BROADCAST_ROWS_CONF, BROADCAST_ROWS_DEFAULT)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see; also used as the checkpoint folder.

    A cluster names it in ``spark.checkpoint.dir``, and it is an error if it does
    not. Only a ``local`` master (tests, one machine) gets a new temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.cohortspark.sharedDir", None)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="cohortspark-")
        spark.conf.set("spark.cohortspark.sharedDir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df):
    """Reliable checkpoint: the rows survive the loss of an executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
