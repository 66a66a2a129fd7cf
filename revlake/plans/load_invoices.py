"""Ingest of invoice files to the invoice table, reject table, ledger and commit log.

A batch has a key. Its tables are written one after the other, each without what it already holds, and
the commit log last: a batch that broke off can be repeated, and one that is in the log is skipped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlake.operators.ingest import (
    accepted,
    dedupe_invoices,
    file_ledger,
    ingest_summary,
    month_groups,
    new_entries,
    new_rejects,
    parse_records,
    rejected,
    same_months,
)
from revlake.schemas import COMMITS, LEDGER
from revlake.session import drop_shuffles, fresh_path, pinned
from revlake.sources.invoices import (
    drop_table,
    empty_ledger,
    invoice_files,
    invoice_records,
    latest_ledger,
    list_files,
    pending_files,
    read_invoice_table,
    table_exists,
    write_invoices,
)

#: Rows whose copies are merged at a time, as far as months can be told apart: their shuffles are on disk together.
AT_ONCE = 25_000_000


def ledger_table(spark: SparkSession, base: str) -> DataFrame:
    path = f"{base}/ledger"
    return spark.read.schema(LEDGER).parquet(path) if table_exists(spark, path) else empty_ledger(spark)


def commit_log(spark: SparkSession, base: str) -> DataFrame:
    """One row per committed batch: its key, counts and time."""
    path = f"{base}/commits"
    return spark.read.schema(COMMITS).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], COMMITS)


def commit_batch(contents: DataFrame, base: str, key: str) -> None:
    """Bring the files of ``contents`` (see ``invoice_files``) into the tables below ``base``, once per ``key``."""
    spark = contents.sparkSession
    if not commit_log(spark, base).where(F.col("batch") == key).isEmpty():
        return
    # Read and parsed once to a stored table: the readers below follow.
    stage = fresh_path(spark, "parsed")
    try:
        parse_records(invoice_records(contents, every_file=True)).write.option("compression", "zstd").parquet(stage)
        drop_shuffles(spark)
        _write_tables(spark.read.parquet(stage), base, key)
    finally:
        drop_table(spark, stage)


def _write_new(rows: DataFrame, known: DataFrame | None, months: list[int], table: str) -> None:
    """Add what ``rows``, all of ``months``, have beyond the ``known`` rows of the table."""
    if known is not None:
        # Hashes alone are compared with the table. Rows move only if theirs is new, in a repetition none.
        key = F.unhex("record_hash").alias("key")
        existing = same_months(known, rows, months).select(key)
        fresh = pinned(rows.select(key).distinct().join(existing, "key", "left_anti"), "fresh")
        if fresh.isEmpty():
            return
        rows = rows.join(fresh, F.unhex("record_hash") == F.col("key"), "left_semi")
    write_invoices(dedupe_invoices(rows), table)


def _write_tables(staged: DataFrame, base: str, key: str) -> None:
    spark = staged.sparkSession
    if staged.isEmpty():
        return
    files = staged.select("file_path", F.col("source_file").alias("file_name"), "file_size", "file_modified_time").distinct()
    parsed = staged.where("record_no is not null")
    table, rejects = f"{base}/invoices", f"{base}/rejects"
    rows = accepted(parsed)
    present = read_invoice_table(spark, table) if table_exists(spark, table) else None
    groups = month_groups(rows, AT_ONCE)
    for months in groups:
        _write_new(rows if len(groups) == 1 else same_months(rows, rows, months), present, months, table)
        drop_shuffles(spark)
    if not groups and present is None:
        write_invoices(rows, table)
    known = spark.read.parquet(rejects) if table_exists(spark, rejects) else None
    new_rejects(rejected(parsed), known).write.mode("append").parquet(rejects)
    new_entries(file_ledger(parsed, files), latest_ledger(ledger_table(spark, base))).write.mode("append").parquet(f"{base}/ledger")
    counts = files.agg(F.count(F.lit(1)).alias("files_processed"))
    summary = ingest_summary(parsed).drop("files_processed").crossJoin(counts).withColumns(  # one row each
        {"status": F.lit("completed"), "batch": F.lit(key), "committed_at": F.current_timestamp()}
    )
    summary.select(*COMMITS.fieldNames()).write.mode("append").parquet(f"{base}/commits")


def ingest_batch(
    spark: SparkSession, input_dir: str, base: str, force: bool = False, key: str | None = None, pattern: str = "*.json"
) -> DataFrame:
    """Process pending (or all) files of ``input_dir`` into tables below ``base``; one summary row.

    Pending files are found from names and times. Only files as new as the oldest pending one are opened,
    which takes one time from the cluster, not a list of paths. Spark's sources do not list files without
    a byte: they are never pending. ``key`` names the batch (default: a
    new name); repeating a key, or forcing files that are in the tables, changes nothing.
    """
    key = key or uuid.uuid4().hex
    pending = oldest = None
    if not force:
        pending = pending_files(list_files(spark, input_dir, pattern), ledger_table(spark, base))
        before = F.min("file_modified_time") - F.expr("INTERVAL 2 SECONDS")
        oldest = pending.agg(F.date_format(before, "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    if force or oldest is not None:
        contents = invoice_files(spark, input_dir, pattern, oldest)
        if pending is not None:
            contents = contents.join(pending.select("file_path"), "file_path", "left_semi")
        commit_batch(contents, base, key)
    nothing = spark.range(1).select(
        *[F.lit(0).cast("long").alias(c) for c in ("files_processed", "records", "errors")], F.lit("no_files").alias("status")
    )
    done = commit_log(spark, base).where(F.col("batch") == key).select(nothing.columns)
    return nothing if done.isEmpty() else done
