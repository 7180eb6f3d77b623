"""Session factory and shared-storage helpers.

The pipeline semantics assume a UTC session (event dates, partition values and
the consistency rule are all UTC).  Scratch output and streaming checkpoints go
under the cluster's shared ``spark.checkpoint.dir``; a local temporary folder is
only used when that setting is absent on a local master (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every chalkline job relies on.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # small scans are cut by the cluster's parallelism, not by a size switch in the code
    "spark.sql.files.openCostInBytes": "64k",
    # of a repeated key in a JSON object the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "chalkline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_utc(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Event dates and partitions are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def pin_last_key_counts(spark: SparkSession) -> None:
    """Of a repeated key in a JSON object the last value counts, whatever the session was
    built with.  Spark reads this setting when the plan is made, so every parse pins it."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.  Only a local master, where
    all tasks share the driver's disk, gets a temporary folder when none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="chalkline-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/chalkline/{name}-{uuid.uuid4().hex[:12]}"
