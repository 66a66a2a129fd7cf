"""Request and model logs: rows to append, filters, pages, summaries, endpoint statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.functions.columns import col
from revlake.functions.quantiles import exact_quantiles
from revlake.schemas import API_LOGS
from revlake.session import pinned

# Key words of secrets, their replacement, longest list kept.
SECRET_WORDS = ["password", "token", "api_key", "secret", "auth"]
REDACTED = "***REDACTED***"
LONGEST_LIST = 100
#: Levels of objects inside objects that are followed; what is an object below them goes as a whole.
DEPTH = 24
RETENTION_DAYS = 90
# Log category per model operation.
OPERATION_CATEGORIES = {
    "training": "model_training",
    "prediction": "model_prediction",
    "validation": "model_validation",
}


def level_of(status) -> Column:
    status = col(status)
    return F.when(status >= 500, "ERROR").when(status >= 400, "WARNING").otherwise("INFO")


def redact_json(c, depth: int = DEPTH) -> Column:
    """Mask the values of secret-looking keys and shorten long lists in a JSON object text.

    The text is taken apart as typed values. One rule holds for the object and every object inside it:
    a secret-looking key's value is masked whatever it is, a list of more than ``LONGEST_LIST`` items becomes
    its length, all else stays. Keys come out in order of their names. Texts that hold no object stay
    as they are; unreadable ones that name a secret are masked as a whole.
    """
    text = col(c)
    value = F.try_parse_json(text)
    unread = F.when(value.isNull() & text.rlike(_SECRET), F.lit(REDACTED)).otherwise(text)
    return F.coalesce(F.to_json(_without_secrets(value, depth)), unread)


_SECRET = "(?i)" + "|".join(SECRET_WORDS)


def _without_secrets(value: Column, depth: int) -> Column:
    """The object that ``value`` holds, cleaned; null where it holds none."""
    masked = F.parse_json(F.lit(f'"{REDACTED}"'))

    def clean(key: Column, inner: Column) -> Column:
        items = F.size(F.try_variant_get(inner, "$", "array<variant>"))
        if depth > 0:
            whole = F.coalesce(_without_secrets(inner, depth - 1), inner)
        else:
            whole = F.when(F.try_variant_get(inner, "$", "map<string,variant>").isNotNull(), masked).otherwise(inner)
        return (
            F.when(key.rlike(_SECRET), masked)
            .when(items > LONGEST_LIST, F.parse_json(F.format_string('"[%d items]"', items)))
            .otherwise(whole)
        )

    fields = F.try_variant_get(value, "$", "map<string,variant>")
    return F.call_function("to_variant_object", F.transform_values(fields, clean))


def request_logs(requests: DataFrame) -> DataFrame:
    """Log rows for raw requests; country and model come from the request body.

    Expects timestamp, endpoint, method, status_code, response_time_ms, and optionally request_data,
    user_id, request_id, error.
    """
    body = _text(requests, "request_data")
    details = F.to_json(
        F.struct(
            "endpoint",
            "method",
            "status_code",
            "response_time_ms",
            redact_json(body).alias("request_data"),
            _text(requests, "error").alias("error"),
        )
    )
    return requests.select(
        "timestamp",
        level_of("status_code").alias("level"),
        F.lit("api_request").alias("category"),
        F.format_string("%s %s -> %s", "method", "endpoint", F.col("status_code").cast("string")).alias("message"),
        details.alias("details"),
        F.get_json_object(body, "$.country").alias("country"),
        F.get_json_object(body, "$.model_type").alias("model_type"),
        _text(requests, "user_id").alias("user_id"),
        _text(requests, "request_id").alias("request_id"),
        (F.col("response_time_ms") / 1000).alias("duration_seconds"),
    )


def _text(df: DataFrame, name: str) -> Column:
    """The column where the frame has it, null text otherwise."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def model_operation_logs(operations: DataFrame) -> DataFrame:
    """Log rows for model operations.

    Expects timestamp, operation, country, model_type, success, duration_seconds, details, and
    optionally user_id, request_id.
    """
    categories = F.create_map(*[F.lit(x) for pair in OPERATION_CATEGORIES.items() for x in pair])
    outcome = F.when(F.col("success"), "completed").otherwise("failed")
    return operations.select(
        "timestamp",
        F.when(F.col("success"), "INFO").otherwise("ERROR").alias("level"),
        F.coalesce(F.try_element_at(categories, F.col("operation")), F.lit("system_event")).alias("category"),
        F.format_string("Model %s %s for %s model in %s", "operation", outcome, "model_type", "country").alias("message"),
        "details",
        "country",
        "model_type",
        _text(operations, "user_id").alias("user_id"),
        _text(operations, "request_id").alias("request_id"),
        "duration_seconds",
    )


def error_logs(errors: DataFrame) -> DataFrame:
    """Log rows for errors: timestamp, message, details, and optionally level, category and the ids."""
    return errors.select(
        "timestamp",
        F.coalesce(_text(errors, "level"), F.lit("ERROR")).alias("level"),
        F.coalesce(_text(errors, "category"), F.lit("error_event")).alias("category"),
        "message",
        "details",
        *[_text(errors, c).alias(c) for c in ("country", "model_type", "user_id", "request_id")],
        F.lit(None).cast("double").alias("duration_seconds"),
    )


def data_access_logs(accesses: DataFrame) -> DataFrame:
    """Log rows for reads and writes.

    Expects timestamp, operation, database, query_type, records_affected, success, duration_seconds,
    and optionally error, country.
    """
    fields = [F.col(c) for c in ("operation", "database", "query_type", "records_affected", "success")]
    details = F.to_json(F.struct(*fields, _text(accesses, "error").alias("error")))
    text = "Data access: %s on %s (%s records)"
    return accesses.select(
        "timestamp",
        F.when(F.col("success"), "INFO").otherwise("ERROR").alias("level"),
        F.lit("data_access").alias("category"),
        F.format_string(text, "operation", "database", F.col("records_affected").cast("string")).alias("message"),
        details.alias("details"),
        _text(accesses, "country").alias("country"),
        *[F.lit(None).cast("string").alias(c) for c in ("model_type", "user_id", "request_id")],
        "duration_seconds",
    )


def request_metrics(requests: DataFrame) -> DataFrame:
    """Rows of the performance table for raw requests."""
    body = _text(requests, "request_data")
    return requests.select(
        "timestamp",
        "endpoint",
        "method",
        "response_time_ms",
        "status_code",
        F.get_json_object(body, "$.country").alias("country"),
        F.get_json_object(body, "$.model_type").alias("model_type"),
    )


def append_log(rows: DataFrame, path: str) -> None:
    """Append log rows, one folder per day."""
    columns = [f.name for f in API_LOGS.fields]
    rows.select(*columns).withColumn("day", F.to_date("timestamp")).hint("rebalance", "day").write.mode(
        "append"
    ).partitionBy("day").parquet(path)


def filter_logs(logs: DataFrame, start=None, end=None, level=None, category=None, country=None, model_type=None) -> DataFrame:
    """Rows matching every given condition; ``end`` is a day and is included as a whole.

    Stored logs are partitioned by ``day``: the bounds are given for it as well.
    """
    if "day" in logs.columns:
        if start is not None:
            logs = logs.where(F.col("day").cast("date") >= F.lit(start).cast("date"))
        if end is not None:
            logs = logs.where(F.col("day").cast("date") <= F.lit(end).cast("date"))
    if start is not None:
        logs = logs.where(F.col("timestamp") >= F.lit(start).cast("date").cast("timestamp"))
    if end is not None:
        logs = logs.where(F.col("timestamp") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    for name, value in (("level", level), ("category", category), ("country", country), ("model_type", model_type)):
        if value is not None:
            logs = logs.where(F.col(name) == value)
    return logs


def paginate_logs(logs: DataFrame, limit: int = 100, offset: int = 0, tiebreak: str = "message") -> DataFrame:
    """One page, newest first, with the total and whether more follow."""
    total = logs.agg(F.count(F.lit(1)).alias("total_count"))
    page = logs.orderBy(F.col("timestamp").desc(), tiebreak).offset(offset).limit(limit)
    return page.crossJoin(F.broadcast(total)).withColumn("has_more", F.col("total_count") > offset + limit)  # one row


def retention_delete(logs: DataFrame, now, days: int = RETENTION_DAYS) -> tuple[DataFrame, DataFrame]:
    """Rows young enough to keep, and the number of rows to delete as one row."""
    old = F.col("timestamp") < F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return logs.where(~old), logs.agg(F.count_if(old).alias("deleted"))


def delete_old_logs(spark: SparkSession, path: str, now, days: int = RETENTION_DAYS) -> DataFrame:
    """Delete the rows of a stored log table (one folder a day) older than ``days``; the number deleted as one row.

    Days that end before the limit are dropped as whole folders, counted from their files' footers. The
    day of the limit is written anew without its old rows, from a stored copy. Both steps can be
    repeated: a run that broke off loses nothing and is finished by the next.
    """
    limit = F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))
    edge = spark.range(1).select(F.to_date(limit).alias("d")).first()[0]
    logs = spark.read.parquet(path)
    before = logs.where(F.col("day").cast("date") < edge)
    # One entry a day: the folders that go.
    gone = before.groupBy("day").agg(F.count(F.lit(1)).alias("n")).collect()
    split = logs.where(F.col("day").cast("date") == edge)
    old, young = split.agg(F.count_if(F.col("timestamp") < limit), F.count_if(F.col("timestamp") >= limit)).first()
    if old and young:
        kept = pinned(split.where(F.col("timestamp") >= limit), "edge-day")
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for day in [r["day"] for r in gone] + [edge] * bool(old and not young):
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(root, f"day={day}"), True)
    spark.catalog.refreshByPath(path)
    return spark.range(1).select(F.lit(sum(r["n"] for r in gone) + old).cast("long").alias("deleted"))


def _since(logs: DataFrame, days: int) -> DataFrame:
    """Rows from the day ``days`` before the newest row's day on. Of a stored table, only those days are opened."""
    if "day" in logs.columns:
        newest = logs.agg(F.date_sub(F.max(F.col("day").cast("date")), days)).scalar()
        return logs.where(F.col("day").cast("date") >= newest)
    newest = logs.agg(F.date_sub(F.to_date(F.max("timestamp")), days)).scalar()
    return logs.where(F.to_date("timestamp") >= newest)


def log_summary(logs: DataFrame, days: int = 7) -> DataFrame:
    keys = ["level", "category", "country", "model_type"]
    return _since(logs, days).groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), *keys)


def top_errors(logs: DataFrame, days: int = 7, n: int = 10) -> DataFrame:
    return (
        _since(logs, days)
        .where(F.col("level").isin("ERROR", "CRITICAL"))
        .groupBy("message")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "message")
        .limit(n)
    )


def daily_activity(logs: DataFrame, days: int | None = 7) -> DataFrame:
    rows = logs if days is None else _since(logs, days)
    return rows.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("total_logs"), F.count_if(F.col("level") == "ERROR").alias("error_logs")
    )


def endpoint_metrics(metrics: DataFrame) -> DataFrame:
    """Requests, response times with exact p50 and p95, and error share per endpoint."""
    failed = (F.col("status_code") >= 400).cast("double")
    extra = [F.avg(c).alias(f"avg_{c}") for c in ("memory_usage_mb", "cpu_usage_percent") if c in metrics.columns]
    base = metrics.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("requests"),
        F.avg("response_time_ms").alias("avg_response_ms"),
        F.min("response_time_ms").alias("min_response_ms"),
        F.max("response_time_ms").alias("max_response_ms"),
        (F.avg(failed) * 100).alias("error_rate"),
        *extra,
    )
    marks = exact_quantiles(metrics, "response_time_ms", [0.5, 0.95], ["endpoint"])
    marks = marks.select("endpoint", F.col("q")[0].alias("p50_response_ms"), F.col("q")[1].alias("p95_response_ms"))
    return base.join(marks, "endpoint", "left").orderBy(F.col("requests").desc(), "endpoint")


def overall_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.avg("response_time_ms").alias("avg_response_ms"),
        (F.avg((F.col("status_code") >= 400).cast("double")) * 100).alias("error_rate"),
        F.count_distinct(F.to_date("timestamp")).alias("active_days"),
    )


def last_n_per_key(records: DataFrame, n: int, keys: list[str], order: list[str]) -> DataFrame:
    """The newest ``n`` rows per key. Spark drops rows past ``n`` before the shuffle as well."""
    newest = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return records.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= n).drop("_n")
