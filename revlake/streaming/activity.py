"""Log activity per day and request alerts as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Alert limits.
ERROR_RATE_LIMIT = 5.0
RESPONSE_LIMIT_MS = 5000.0


def log_activity_stream(logs: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Logs and errors per day; state is one row per open day."""
    return (
        logs.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", "1 day"))
        .agg(F.count(F.lit(1)).alias("total_logs"), F.count_if(F.col("level") == "ERROR").alias("error_logs"))
        .select(F.to_date("window.start").alias("date"), "total_logs", "error_logs")
    )


def request_rates(requests: DataFrame, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Requests, error share and mean response time per window; state is one row per open window."""
    error_rate = F.avg((F.col("status_code") >= 400).cast("double")) * 100
    return (
        requests.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", width))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            error_rate.alias("error_rate"),
            F.avg("response_time_ms").alias("avg_response_ms"),
        )
        .select(F.col("window.start").alias("window_start"), "requests", "error_rate", "avg_response_ms")
    )


def rate_alerts(rates: DataFrame) -> DataFrame:
    """Windows of ``request_rates`` whose error share or mean response time is past its limit."""
    return rates.where((F.col("error_rate") > ERROR_RATE_LIMIT) | (F.col("avg_response_ms") > RESPONSE_LIMIT_MS)).select(
        "*",
        (F.col("error_rate") > ERROR_RATE_LIMIT).alias("error_alert"),
        (F.col("avg_response_ms") > RESPONSE_LIMIT_MS).alias("response_alert"),
    )


def run_to_files(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, then stop. Every batch writes the windows it changed, under its number.

    Open windows are written as they stand and written again when rows are added, so nothing waits for
    the watermark. A batch that is retried replaces its own rows.
    """
    def load(rows: DataFrame, batch: int) -> None:
        rows.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch").parquet(out)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def newest(spark: SparkSession, stream: DataFrame, out: str) -> DataFrame:
    """The last state of every window that ``run_to_files`` has written; the first column names the window."""
    key, *rest = stream.columns
    rows = spark.read.schema(stream.schema.add("batch", "long")).parquet(out)
    last = F.max_by(F.struct(*rest), "batch").alias("_last")
    return rows.groupBy(key).agg(last).select(key, "_last.*")


def finished(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run ``stream`` over all available input and return every window up to the last row."""
    query = run_to_files(stream, out, checkpoint)
    query.awaitTermination()
    return newest(spark, stream, out)
