"""SparkSession construction and session-level settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session of the library wants. AQE re-plans joins and
# shuffle sizes at runtime (skew splitting, partition coalescing, runtime
# broadcast conversion); UTC keeps timestamps identical across engines.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "prelaunch",
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    ``master='local[8]'`` with ``shuffle_partitions`` near the core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``; that setting wins.
    Only a local session without the setting gets a private folder; on a
    cluster executors could not share one, so an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not fallback and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = fallback or tempfile.mkdtemp(prefix="prelaunch-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more, in whatever store it is; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
