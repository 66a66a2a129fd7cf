"""Invoice files, the invoice table, the file ledger, and CSV exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.schemas import CORRUPT, INVOICES, LEDGER, RAW


def list_files(spark: SparkSession, directory: str, pattern: str = "*.json") -> DataFrame:
    """Path, name, size and modification time of each input file; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(directory)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("file_modified_time"),
        )
    )


def invoice_files(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.json", after=None, stream: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Input files with their text, one row each, as a table or (``stream``) as they arrive.

    ``after`` is a time as text (``2024-01-31T00:00:00``): files last changed up to then are not opened.
    """
    reader = (spark.readStream if stream else spark.read).option("wholetext", True).option("pathGlobFilter", pattern)
    if after is not None:
        reader = reader.option("modifiedAfter", after)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    paths = [paths] if isinstance(paths, str) else list(paths)
    meta = {"file_path": "file_path", "source_file": "file_name", "file_size": "file_size", "file_modified_time": "file_modification_time"}
    return reader.text(paths[0] if stream else paths).select(
        "value", *[F.col(f"_metadata.{field}").alias(name) for name, field in meta.items()]
    )


def invoice_records(files: DataFrame, every_file: bool = False) -> DataFrame:
    """Raw records of files, each of which must hold one JSON array; every task parses the files it reads.

    ``record_no`` counts the records of a file from 0. A file that is unreadable or holds something
    else gives one row without fields, and ``file_error`` says why.
    """
    fields = [f for f in RAW.fields if f.name != CORRUPT]
    record = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    first = F.substring(F.regexp_replace(F.substring("value", 1, 1000), r"^[\s\ufeff]+", ""), 1, 1)
    parsed = F.from_json(F.regexp_replace("value", "^\ufeff", ""), T.ArrayType(record))
    files = files.withColumn("_records", parsed).withColumn(
        "file_error",
        F.when(~first.isin("[", ""), "top level is not an array").when(F.col("_records").isNull() | (first == ""), "unreadable JSON"),
    )
    rest = [c for c in files.columns if c not in ("value", "_records")]
    listed = F.when(F.col("file_error").isNull(), F.col("_records")).otherwise(F.array(F.lit(None).cast(record)))
    explode = F.posexplode_outer if every_file else F.posexplode
    return files.select(*rest, explode(listed).alias("record_no", "_record")).select(
        *[F.col(f"_record.{f.name}").alias(f.name) for f in fields], *rest, "record_no"
    )


def read_invoices(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.json") -> DataFrame:
    """Raw records of JSON files, read once. A file without a byte has no row."""
    return invoice_records(invoice_files(spark, paths, pattern))


def write_invoices(df: DataFrame, path: str) -> None:
    """Append to the invoice table by month; rebalancing merges small months and splits large ones."""
    columns = [f.name for f in INVOICES.fields]
    df.select(*columns).hint("rebalance", "year", "month").write.mode("append").option(
        "compression", "zstd"
    ).partitionBy("year", "month").parquet(path)


def read_invoice_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INVOICES).parquet(path)


def empty_invoices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], INVOICES)


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a stored table, if there is one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored table has been committed at ``path``."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def scan_date_range(df: DataFrame, start=None, end=None, column: str = "date") -> DataFrame:
    """Rows with start <= date <= end; either bound may be missing. Reaches the scan as a filter.

    A table with ``year`` and ``month`` beside ``date`` is partitioned by them: the bounds are given
    for these as well, so that other months are not opened.
    """
    months = F.col("year") * 12 + F.col("month")
    by_month = column == "date" and {"year", "month"} <= set(df.columns)
    for bound, keep in ((start, lambda a, b: a >= b), (end, lambda a, b: a <= b)):
        if bound is not None:
            day = F.lit(bound).cast("date")
            df = df.where(keep(F.col(column), day))
            if by_month:
                df = df.where(keep(months, F.year(day) * 12 + F.month(day)))
    return df


def export_invoices(df: DataFrame, limit: int | None = None) -> DataFrame:
    """The invoice table as users export it; ``limit`` takes any rows."""
    out = df.select(
        "invoice", "country", "customer_id", "stream_id", "price", "times_viewed", "year", "month", "day", "date"
    )
    return out if limit is None else out.limit(limit)


def read_for_models(df: DataFrame) -> DataFrame:
    """Rows usable for modelling, in date order."""
    return (
        df.where("price is not null and date is not null")
        .select("country", "date", "invoice", "customer_id", "stream_id", "price", "times_viewed")
        .orderBy("date", "invoice", "stream_id", "price")
    )


def write_series_csv(df: DataFrame, path: str) -> None:
    """Per-series CSV cache: one folder per series."""
    df.hint("rebalance", "series").write.mode("overwrite").option("header", True).partitionBy("series").csv(path)


def read_series_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def latest_ledger(entries: DataFrame) -> DataFrame:
    """One row per file from an append-only ledger: the entry processed last."""
    newest = W.partitionBy("file_path").orderBy(F.col("processed_at").desc(), F.col("processing_status"))
    return entries.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def pending_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files without a completed ledger entry."""
    done = latest_ledger(ledger).where("processing_status = 'completed'").select("file_path")
    return files.join(done, "file_path", "left_anti")


def write_l3(df: DataFrame, path: str, updated: bool = False, replace_dates: bool = False, by: str = "date") -> None:
    """Append a result table with its creation time.

    ``replace_dates`` overwrites the dates (column ``by``) contained in ``df`` instead, so a re-run
    adds no copies.
    """
    out = df.withColumn("created_at", F.current_timestamp())
    if updated:
        out = out.withColumn("updated_at", F.current_timestamp())
    if replace_dates:
        out.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    else:
        out.write.mode("append").parquet(path)


def save_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_metrics_history(spark: SparkSession, path: str) -> DataFrame:
    """Persisted model history ``{"country_model": [record, ...]}`` as one row per record."""
    record = (
        "array<struct<mae:double,mape:double,rmse:double,mase:double,r2:double,"
        "timestamp:timestamp,model_type:string,country:string>>"
    )
    text = spark.read.option("wholetext", True).text(path)
    return (
        text.select(F.explode(F.from_json("value", f"map<string,{record}>")).alias("key", "records"))
        .select("key", F.explode("records").alias("r"))
        .select("key", "r.*")
    )


def read_baseline_stats(spark: SparkSession, path: str) -> DataFrame:
    """Persisted baseline ``{"feature": {"stat": value}}`` in long form."""
    text = spark.read.option("wholetext", True).text(path)
    return (
        text.select(F.explode(F.from_json("value", "map<string,map<string,double>>")).alias("feature", "stats"))
        .select("feature", F.explode("stats").alias("stat", "value"))
    )
