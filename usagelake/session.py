"""Spark session defaults and shared-folder lookup."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that every job in the package relies on.  AQE coalesces small
# shuffles, splits skewed join partitions and turns joins into broadcasts only
# when the runtime size of a side is under the broadcast threshold.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of DataFrames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "usagelake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster leave ``master`` unset so spark-submit decides; size
    ``shuffle_partitions`` so one shuffle partition is roughly 128-256 MB at
    the target scale (AQE coalesces it down for small batches).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session.  Only a local-mode session (tests)
    without the setting gets a fresh scratch folder, which is then recorded as
    the session's checkpoint dir; on a cluster a missing setting is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        root = tempfile.mkdtemp(prefix="usagelake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    path = os.path.join(root, name) if "://" not in root else root.rstrip("/") + "/" + name
    return path


def reusable(df):
    """Materialise ``df`` once for a plan that reads it several times.

    One pass writes it as Parquet to the shared folder: later passes read only
    the columns they need instead of recomputing the lineage, and a lost
    executor re-reads the files.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"usagelake-stored-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
