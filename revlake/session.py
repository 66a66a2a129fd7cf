"""Session defaults and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import time
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when a grouping on the same keys follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: When the driver was last made to collect its garbage.
_COLLECTED: dict[str, float] = {}


def build_session(app: str = "revlake", master: str | None = None, **conf) -> SparkSession:
    """A session with the defaults above; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"revlake-{application}-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees, taken from ``spark.checkpoint.dir``.

    Where that is unset, a machine-local folder serves local mode, in which driver and tasks share
    one machine; on a cluster it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder(context.applicationId)


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/revlake/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path inside the shared folder that no other run uses."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete the tables this application stored; call it when their readers are done."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs: it does when the driver collects its garbage, which may not be for long.

    Steps that follow each other within seconds have little to delete and are spared the collection.
    """
    if time.monotonic() - _COLLECTED.get("at", -60.0) > 10:
        spark._jvm.System.gc()
        _COLLECTED["at"] = time.monotonic()


def pinned(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The stored table survives executor loss and gives every later reader the same rows, which
    recomputing an expression such as ``spark_partition_id`` would not.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    drop_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)
