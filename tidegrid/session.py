"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that are safe to set on any session. Shuffle sizes are left to
# the cluster; adaptive execution sizes partitions and splits skewed joins.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the time zone and switch adaptive execution on."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, **extra: str) -> SparkSession:
    """Build or fetch a session; ``extra`` uses ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName("tidegrid")
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets a folder of its own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tidegrid-saved-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """A copy of ``df`` in the shared folder; cuts its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
