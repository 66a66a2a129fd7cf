"""Incremental ingest: new invoice files to the invoice table, each record once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from revlake.plans.load_invoices import commit_batch
from revlake.sources.invoices import invoice_files


def ingest_stream(
    spark: SparkSession, directory: str, base: str, checkpoint: str, files_per_batch: int | None = None, pattern: str = "*.json"
) -> StreamingQuery:
    """Process everything new, then stop. A fresh ``checkpoint`` processes all files again.

    Batches are committed under the checkpoint and their number, as ``ingest_batch`` commits its own: to
    the same tables, ledger included. A batch that is retried or read again adds nothing.
    """
    def load(contents: DataFrame, batch: int) -> None:
        commit_batch(contents, base, f"{checkpoint}#{batch}")

    files = invoice_files(spark, directory, pattern, stream=True, files_per_batch=files_per_batch)
    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def bounded_dedupe(stream: DataFrame, time_column: str, delay: str = "7 days") -> DataFrame:
    """Drop repeated hashes that arrive within ``delay``; state stays bounded by the watermark."""
    return stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["record_hash"])
