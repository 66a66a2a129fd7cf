"""Word rules and stored intermediates shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.session import fresh_path

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_STORED: dict[str, list[str]] = {}


def stored(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write ``df`` below the session's shared folder and read it back.

    The table survives the loss of executors and gives every reader the same rows. ``release``
    deletes it once its readers are done.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    # Shuffle files of finished jobs go when the driver collects its garbage, which it may not do for long.
    spark._jvm.System.gc()
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what ``stored`` has written so far in this application."""
    for path in _STORED.pop(spark.sparkContext.applicationId, []):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(hex_digest: Column) -> Column:
    """The first 60 bits of a hexadecimal digest as a non-negative long."""
    return F.conv(F.substring(hex_digest, 1, 15), 16, 10).cast("long")
