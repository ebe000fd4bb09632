"""Session construction and lineage cutting.

On a cluster the session comes from spark-submit and already names a shared
``spark.checkpoint.dir``; this module only reads it. A local folder is created
only when the setting is absent (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ratecraft.errors import CheckpointFolderError

# Settings every job here relies on. AQE re-plans joins from runtime sizes
# (this is what checks the size of a derived lookup before broadcasting it),
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete reliable checkpoint files once their DataFrame is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # let Python data sources (the SQLite reader) evaluate filters at the source
    "spark.sql.python.filterPushdown.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ratecraft", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, taking it from the session.

    Order: the SparkContext's folder if already set; else ``spark.checkpoint.dir``
    from the session conf (the shared folder a cluster names); else, only when
    nothing is configured on a local master (tests), a fresh temporary folder.
    On a cluster a machine's own folder would lose data, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise CheckpointFolderError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ratecraft-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and return the re-read frame.

    Survives executor loss (data is on shared storage, not executor disks) and
    pins any physical-layout-dependent columns (partition ids, row positions).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint folder for intermediate written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and read it again. Unlike a checkpoint the
    result has a known size in bytes, by which Spark decides whether a join may broadcast it."""
    path = scratch_dir(df.sparkSession, f"tables/{uuid.uuid4().hex}/{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
