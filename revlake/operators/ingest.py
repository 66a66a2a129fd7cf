"""From raw records to typed, hashed, unique invoices, keeping what is rejected and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.functions.columns import col, make_invoice_date, title_case
from revlake.schemas import ALIASES, COUNTRY_SYNONYMS, INVOICES, REQUIRED, SUPPORTED_COUNTRIES

HASHED = ["invoice", "customer_id", "stream_id", "price", "times_viewed", "year", "month", "day"]


def normalize_fields(df: DataFrame) -> DataFrame:
    """Resolve input aliases to the standard names; other columns are kept."""
    inputs = {name for names in ALIASES.values() for name in names}
    present = set(df.columns)
    resolved = []
    for standard, names in ALIASES.items():
        found = [F.col(n) for n in names if n in present]
        resolved.append((F.coalesce(*found) if found else F.lit(None).cast("string")).alias(standard))
    return df.select(*resolved, *[c for c in df.columns if c not in inputs])


def validate_required(df: DataFrame) -> DataFrame:
    """Add ``missing``: the names of absent required fields, in their declared order."""
    checks = [F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]
    return df.withColumn("missing", F.array_compact(F.array(*checks)))


def whole_number(c) -> Column:
    """Text such as 7, 07 or 7.0 as a whole number, null otherwise."""
    return col(c).try_cast("double").try_cast("int")


def typed_projection(df: DataFrame) -> DataFrame:
    """Cast to the invoice table's types; views default to 0."""
    # A plain long first: going through double would lose digits of long ids.
    customer = F.coalesce(F.col("customer_id").try_cast("long"), F.col("customer_id").try_cast("double").try_cast("long"))
    typed = df.select(
        F.col("invoice").cast("string").alias("invoice"),
        F.col("country").cast("string").alias("country"),
        customer.alias("customer_id"),
        F.col("stream_id").cast("string").alias("stream_id"),
        F.col("price").try_cast("double").alias("price"),
        F.coalesce(whole_number("times_viewed"), F.lit(0)).alias("times_viewed"),
        whole_number("year").alias("year"),
        whole_number("month").alias("month"),
        whole_number("day").alias("day"),
        *[c for c in df.columns if c not in ALIASES],
    )
    return typed.withColumn("date", make_invoice_date("year", "month", "day"))


def with_reject_reason(df: DataFrame) -> DataFrame:
    """Add ``reject_reason`` (null = accepted) to a frame that went through the two steps above."""
    reason = F.when(F.size("missing") > 0, F.concat(F.lit("missing: "), F.array_join("missing", ",")))
    if "file_error" in df.columns:
        reason = F.coalesce(F.col("file_error"), reason)
    return df.withColumn(
        "reject_reason",
        F.coalesce(
            reason,
            F.when(F.col("price").isNull(), "price is not a number"),
            F.when(F.col("date").isNull(), "not a calendar date"),
        ),
    )


def record_hash(df: DataFrame) -> DataFrame:
    """Add ``record_hash``; absent fields count as empty text, and the country is left out."""
    # concat_ws would skip nulls and let neighbouring fields move, hence the coalesce.
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in HASHED]
    return df.withColumn("record_hash", F.md5(F.concat_ws("|", *parts)))


def parse_records(raw: DataFrame) -> DataFrame:
    """All record-level steps in one projection: aliases, required fields, types, date, hash."""
    if "source_file" not in raw.columns:
        raw = raw.withColumn("source_file", F.lit(None).cast("string"))
    return record_hash(with_reject_reason(typed_projection(validate_required(normalize_fields(raw)))))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason is null").select(*[f.name for f in INVOICES.fields])


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where("reject_reason is not null")


def dedupe_invoices(df: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per hash, the one from the first file; hashes already stored are left out.

    Copies are merged before the shuffle, so a record copied very often reaches a task once per
    input partition.
    """
    rest = [c for c in df.columns if c != "record_hash"]
    ordered = ["source_file", *[c for c in rest if c != "source_file"]] if "source_file" in rest else rest
    first = (
        df.groupBy("record_hash")
        .agg(F.min(F.struct(*ordered)).alias("_r"))
        .select("record_hash", "_r.*")
        .select(*df.columns)
    )
    if existing is None:
        return first
    return first.join(existing.select("record_hash"), "record_hash", "left_anti")


def month_groups(batch: DataFrame, most: int) -> list[list[int]]:
    """The calendar months in ``batch``, as 201902, in groups of at most ``most`` rows or of one month."""
    counts = batch.groupBy((F.col("year") * 100 + F.col("month")).alias("month")).count().where("month is not null")
    groups, rows = [], 0
    for month, n in sorted(map(tuple, counts.collect())):
        if not groups or rows + n > most:
            groups, rows = [*groups, []], 0
        groups[-1].append(month)
        rows += n
    return groups


def same_months(existing: DataFrame, batch: DataFrame, months: list[int] | None = None) -> DataFrame:
    """The part of a month-partitioned table that can hold copies of ``batch``.

    The hash covers year and month. The month list has one entry per calendar month in the batch, unless
    ``months`` names them, and turns into a partition filter.
    """
    key = F.col("year") * 100 + F.col("month")
    if months is None:
        months = [r[0] for r in batch.select(key).distinct().collect() if r[0] is not None]
    return existing.where(key.isin(months))


def file_ledger(parsed: DataFrame, files: DataFrame) -> DataFrame:
    """One ledger entry per processed file; a file without records or with an error has failed or 0.

    Records are matched by path where they carry one, else by file name.
    """
    key = ["file_path", "file_path"] if "file_path" in parsed.columns else ["source_file", "file_name"]
    per_file = parsed.groupBy(F.col(key[0]).alias("_file")).agg(
        F.count_if(F.col("reject_reason").isNull()).alias("records_processed"),
        F.max("file_error").alias("error_message"),
    )
    return files.join(per_file, F.col(key[1]) == F.col("_file"), "left").select(
        "file_path",
        "file_name",
        "file_size",
        "file_modified_time",
        F.coalesce("records_processed", F.lit(0)).cast("long").alias("records_processed"),
        F.when(F.col("error_message").isNull(), "completed").otherwise("failed").alias("processing_status"),
        "error_message",
        F.current_timestamp().alias("processed_at"),
    )


def new_rejects(rejects: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Rejects with ``reject_key``, which names file, record and content; keys already stored are left out."""
    fields = [c for c in rejects.columns if c not in ("missing", "file_size", "file_modified_time")]
    out = rejects.drop("missing").withColumn("reject_key", F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})))
    return out if existing is None else out.join(existing.select("reject_key"), "reject_key", "left_anti").select(out.columns)


def new_entries(entries: DataFrame, existing: DataFrame) -> DataFrame:
    """Ledger entries that say something new about their file; the time of processing does not count."""
    same = [c for c in entries.columns if c != "processed_at"]
    known = existing.select(*[F.col(c).alias(f"_{c}") for c in same])
    return entries.join(known, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same], "left_anti")


def upsert_ledger(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old entries replaced by new ones for the same file."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    newest = W.partitionBy("file_path").orderBy(F.col("_new").desc(), F.col("processed_at").desc())
    return both.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", "_new")


def ingest_summary(parsed: DataFrame) -> DataFrame:
    """Files, records and errors of a run as one row."""
    return parsed.agg(
        F.count_distinct("source_file").alias("files_processed"),
        F.count_if(F.col("reject_reason").isNull()).alias("records"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("errors"),
        F.when(F.count(F.lit(1)) == 0, "no_files").otherwise("completed").alias("status"),
    )


def check_columns(df: DataFrame) -> DataFrame:
    """Pass ``df`` on when its columns, after renaming, are the nine expected ones."""
    to_standard = {name: standard for standard, names in ALIASES.items() for name in names}
    found = sorted(to_standard.get(c, c) for c in df.columns)
    if found != sorted(ALIASES):
        raise ValueError(f"columns do not match: {found}")
    return df.withColumnsRenamed({c: to_standard[c] for c in df.columns})


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; absent columns become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def supported_countries(spark) -> DataFrame:
    """The fixed list of accepted countries as a frame of known size."""
    rows = ", ".join(f"('{c}')" for c in SUPPORTED_COUNTRIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(country)")


def select_countries(df: DataFrame, supported: DataFrame | None = None) -> DataFrame:
    """Rows whose country is supported; the fixed list becomes a scan filter."""
    if supported is None:
        return df.where(F.col("country").isin(SUPPORTED_COUNTRIES))
    return df.join(supported.select("country").distinct(), "country", "left_semi")


def normalize_country(df: DataFrame, supported: DataFrame | None = None, column: str = "country") -> DataFrame:
    """Canonical country names in ``country``; ``country_ok`` is false where the name is unknown."""
    synonyms = F.create_map(*[F.lit(x) for pair in COUNTRY_SYNONYMS.items() for x in pair])
    titled = title_case(column)
    known = supported_countries(df.sparkSession) if supported is None else supported
    known = known.select(F.col("country").alias("_known")).distinct()
    return (
        df.withColumn("country", F.coalesce(F.try_element_at(synonyms, titled), titled))
        .join(known, F.col("country") == F.col("_known"), "left")
        .withColumn("country_ok", F.col("_known").isNotNull())
        .drop("_known")
    )


def explode_streams(df: DataFrame, column: str = "streams") -> DataFrame:
    """Nested invoices (streams as JSON text) as one row per stream line."""
    line = "array<struct<stream_id:string,times_viewed:int,price:double>>"
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(F.from_json(column, line)).alias("_s")).select(*rest, "_s.*")
