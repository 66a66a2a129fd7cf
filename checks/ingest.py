"""Ingest, sources and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import api_logs, clean, cte, daily, final, history, invoices, lines, raw_records, requests, series, table, tidy
from revlake.functions import columns as C
from revlake.operators import cleaning, ingest, logs, metrics
from revlake.plans import build_tables, load_invoices
from revlake.session import drop_shuffles, fresh_path
from revlake.sources import invoices as sources
from revlake.streaming.invoices import ingest_stream

QUERIES, ORACLES = {}, {}


def check(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


def parsed(spark, sf):
    return ingest.parse_records(raw_records(spark, sf))


FIELDS = "invoice country customer_id stream_id price times_viewed year month day"
check(
    "normalize_fields",
    lambda s, sf: ingest.normalize_fields(raw_records(s, sf)),
    cte("raw", f"SELECT {FIELDS.replace(' ', ', ')}, source_file FROM raw"),
)
check(
    "validate_required",
    lambda s, sf: ingest.validate_required(ingest.normalize_fields(raw_records(s, sf)))
    .select("invoice", F.array_join("missing", ",").alias("missing")),
    cte("raw", "SELECT invoice, CASE WHEN country IS NULL THEN 'country' ELSE '' END AS missing FROM raw"),
)
check(
    "make_invoice_date",
    lambda s, sf: tidy(
        raw_records(s, sf).select("invoice", C.make_invoice_date("year", "month", "day").alias("date"))
        .groupBy("date").agg(F.count(F.lit(1)).alias("records"))
        .withColumn("date", F.coalesce(F.col("date").cast("string"), F.lit("none")))
    ),
    cte("typed", "SELECT coalesce(CAST(date AS VARCHAR), 'none') AS date, count(*) AS records FROM typed GROUP BY date"),
)
check(
    "typed_projection",
    lambda s, sf: tidy(
        ingest.typed_projection(ingest.normalize_fields(raw_records(s, sf))).select(*FIELDS.split(), "source_file")
    ),
    final(cte("typed", "SELECT * FROM typed"), FIELDS.replace("price ", "") + " source_file", "price"),
)
check(
    "record_hash",
    # Hash texts are engine-specific; which records share one is not.
    lambda s, sf: parsed(s, sf).groupBy("record_hash").agg(
        F.min("invoice").alias("invoice"), F.min("stream_id").alias("stream_id"),
        F.count_distinct("invoice", "stream_id", "price", "times_viewed").alias("members"), F.count(F.lit(1)).alias("copies")
    ).drop("record_hash"),
    cte("typed", """SELECT invoice, stream_id, 1 AS members, count(*) AS copies FROM typed
        GROUP BY invoice, customer_id, stream_id, price, times_viewed, year, month, day"""),
)
check(
    "dedupe_invoices",
    lambda s, sf: tidy(
        ingest.dedupe_invoices(ingest.accepted(parsed(s, sf)))
        .select("invoice", "customer_id", "stream_id", "price", "times_viewed", "date", "source_file", "country")
    ),
    final(
        cte("good", """SELECT invoice, customer_id, stream_id, price, times_viewed, date, min(source_file) AS source_file,
            min(country) AS country FROM good GROUP BY invoice, customer_id, stream_id, price, times_viewed, date"""),
        "invoice customer_id stream_id times_viewed source_file country", "price", "date",
    ),
)
check(
    "dedupe_against_table",
    lambda s, sf: tidy(
        ingest.dedupe_invoices(
            ingest.accepted(parsed(s, sf)),
            ingest.accepted(parsed(s, sf)).where("source_file = 'invoices-F.json'"),
        ).select("invoice", "stream_id", "price", "times_viewed")
    ),
    final(
        cte("good", """SELECT invoice, stream_id, price, times_viewed FROM good
            GROUP BY invoice, customer_id, stream_id, price, times_viewed, date
            HAVING count(*) FILTER (source_file = 'invoices-F.json') = 0"""),
        "invoice stream_id times_viewed", "price",
    ),
)
check(
    "rejected_records",
    lambda s, sf: ingest.rejected(parsed(s, sf)).groupBy("source_file", "reject_reason").agg(F.count(F.lit(1)).alias("records")),
    cte("typed", """SELECT source_file, CASE WHEN country IS NULL THEN 'missing: country' ELSE 'not a calendar date' END
        AS reject_reason, count(*) AS records FROM typed WHERE country IS NULL OR date IS NULL GROUP BY ALL"""),
)
check(
    "ingest_summary",
    lambda s, sf: ingest.ingest_summary(parsed(s, sf)),
    cte("typed", """SELECT count(DISTINCT source_file) AS files_processed,
        count(*) FILTER (country IS NOT NULL AND date IS NOT NULL) AS records,
        count(*) FILTER (country IS NULL OR date IS NULL) AS errors, 'completed' AS status FROM typed"""),
)


def files(spark, sf):
    """One file per supplier; the size is that of its lines."""
    return table(spark, sf, "lineitem").groupBy(F.concat(F.lit("/in/"), F.col("l_suppkey"), F.lit(".json")).alias("file_path")).agg(
        F.concat(F.max("l_suppkey"), F.lit(".json")).alias("file_name"),
        F.count(F.lit(1)).alias("file_size"),
        F.max("l_shipdate").cast("timestamp").alias("file_modified_time"),
    )


def ledger(spark, sf):
    """Suppliers with an even key, each with an older failed and a newer entry."""
    s = table(spark, sf, "supplier").where("s_suppkey % 2 = 0")
    status = F.when(F.col("s_suppkey") % 3 == 0, "failed").otherwise("completed")
    entry = s.select(
        F.concat(F.lit("/in/"), F.col("s_suppkey"), F.lit(".json")).alias("file_path"),
        F.concat(F.col("s_suppkey"), F.lit(".json")).alias("file_name"),
        F.lit(0).cast("long").alias("file_size"),
        F.lit("2020-01-01").cast("timestamp").alias("file_modified_time"),
        F.lit(0).cast("long").alias("records_processed"),
        status.alias("processing_status"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit("2020-01-02").cast("timestamp").alias("processed_at"),
    )
    older = entry.withColumn("processing_status", F.lit("failed")).withColumn("processed_at", F.lit("2020-01-01").cast("timestamp"))
    return entry.unionByName(older)


def new_entries(spark, sf):
    return files(spark, sf).where("file_size % 2 = 0").select(
        "*", F.col("file_size").alias("records_processed"), F.lit("completed").alias("processing_status"),
        F.lit(None).cast("string").alias("error_message"), F.lit("2021-01-01").cast("timestamp").alias("processed_at"),
    )


FILES_SQL = """SELECT '/in/' || l_suppkey || '.json' AS file_path, l_suppkey || '.json' AS file_name, count(*) AS file_size
    FROM lineitem GROUP BY l_suppkey"""
check(
    "pending_files",
    lambda s, sf: sources.pending_files(files(s, sf), ledger(s, sf)).select("file_path", "file_name", "file_size"),
    f"""SELECT * FROM ({FILES_SQL}) WHERE file_path NOT IN
        (SELECT '/in/' || s_suppkey || '.json' FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey % 3 <> 0)""",
)
check(
    "upsert_ledger",
    lambda s, sf: ingest.upsert_ledger(ledger(s, sf), new_entries(s, sf)).select("file_path", "records_processed", "processing_status"),
    f"""WITH f AS ({FILES_SQL}), n AS (SELECT file_path, file_size AS records_processed, 'completed' AS processing_status
          FROM f WHERE file_size % 2 = 0),
        o AS (SELECT '/in/' || s_suppkey || '.json' AS file_path, 0 AS records_processed,
          CASE WHEN s_suppkey % 3 = 0 THEN 'failed' ELSE 'completed' END AS processing_status
          FROM supplier WHERE s_suppkey % 2 = 0)
        SELECT * FROM n UNION ALL SELECT * FROM o WHERE file_path NOT IN (SELECT file_path FROM n)""",
)
check(
    "file_ledger",
    lambda s, sf: ingest.file_ledger(
        parsed(s, sf).withColumn("file_error", F.lit(None).cast("string")),
        raw_records(s, sf).groupBy(F.col("source_file").alias("file_name")).agg(
            F.concat(F.lit("/in/"), F.max("source_file")).alias("file_path"), F.count(F.lit(1)).alias("file_size"),
            F.max(F.lit("2020-01-01").cast("timestamp")).alias("file_modified_time")),
    ).select("file_path", "file_size", "records_processed", "processing_status"),
    cte("typed", """SELECT '/in/' || source_file AS file_path, count(*) AS file_size,
        count(*) FILTER (country IS NOT NULL AND date IS NOT NULL) AS records_processed, 'completed' AS processing_status
        FROM typed GROUP BY source_file"""),
)
check(
    "export_invoices",
    lambda s, sf: tidy(sources.export_invoices(invoices(s, sf))),
    final(cte("inv", "SELECT * FROM inv"), "invoice country customer_id stream_id times_viewed year month day", "price", "date"),
)
check(
    "scan_date_range",
    lambda s, sf: tidy(sources.scan_date_range(invoices(s, sf), "1996-01-01", "1996-12-31").select("invoice", "date", "price")),
    final(cte("inv", "SELECT * FROM inv WHERE date BETWEEN '1996-01-01' AND '1996-12-31'"), "invoice", "price", "date"),
)
check(
    "read_for_models",
    lambda s, sf: tidy(sources.read_for_models(invoices(s, sf))),
    final(cte("inv", "SELECT * FROM inv WHERE price IS NOT NULL AND date IS NOT NULL"),
          "country invoice customer_id stream_id times_viewed", "price", "date"),
)
check(
    "union_files",
    lambda s, sf: ingest.union_files([
        table(s, sf, "orders").select("o_orderkey", "o_orderstatus"),
        table(s, sf, "orders").select("o_orderkey", "o_orderpriority"),
    ]).groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n")).na.fill("-"),
    """SELECT coalesce(o_orderstatus, '-') AS o_orderstatus, coalesce(o_orderpriority, '-') AS o_orderpriority, count(*) AS n
       FROM (SELECT o_orderstatus, NULL AS o_orderpriority FROM orders UNION ALL SELECT NULL, o_orderpriority FROM orders) GROUP BY ALL""",
)
check(
    "select_countries",
    lambda s, sf: ingest.select_countries(
        invoices(s, sf), table(s, sf, "nation").where("n_nationkey % 2 = 0").select(F.col("n_name").alias("country"))
    ).groupBy("country").agg(F.count(F.lit(1)).alias("n")),
    cte("inv", "SELECT country, count(*) AS n FROM inv WHERE country IN (SELECT n_name FROM nation WHERE n_nationkey % 2 = 0) GROUP BY country"),
)
SPELLED = {0: " uk ", 1: "great britain", 2: "HOLLAND", 3: "deutschland", 4: "france", 5: "republic of ireland", 6: "eire"}
CANONICAL = {0: "United Kingdom", 1: "United Kingdom", 2: "Netherlands", 3: "Germany", 4: "France", 5: "EIRE", 6: "Eire"}


def spelled_customers(spark, sf):
    text = F.col("n_name")
    for k, v in SPELLED.items():
        text = F.when(F.col("n_nationkey") == k, v).otherwise(text)
    return (
        table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", text.alias("country"))
    )


check(
    "normalize_country",
    lambda s, sf: ingest.normalize_country(spelled_customers(s, sf)).groupBy("country", "country_ok").agg(F.count(F.lit(1)).alias("n")),
    "SELECT CASE n_nationkey " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in CANONICAL.items())
    + " ELSE replace(n_name, 'NATION', 'Nation') END AS country, n_nationkey < 6 AS country_ok, count(*) AS n"
    + " FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL",
)
check(
    "sanitize_text",
    lambda s, sf: table(s, sf, "customer").select(
        "c_custkey", C.sanitize_text(F.concat(F.lit("  <b>"), "c_name", F.lit("'; \\ "))).alias("name")),
    """SELECT c_custkey, 'b' || c_name || ' ' AS name FROM customer""",
)
check(
    "sanitize_long_text",
    # The accepted length includes what is taken out: names repeated to about the limit.
    lambda s, sf: table(s, sf, "customer").select(
        "c_custkey", F.repeat(F.concat("c_name", F.lit("<>")), (F.lit(10) + F.col("c_custkey") % 10).cast("int")).alias("t"))
    .select("c_custkey", F.length(C.sanitize_text("t")).alias("n"), C.text_error("t").alias("error")),
    """SELECT c_custkey, CASE WHEN n <= 255 THEN n END AS n, CASE WHEN n > 255 THEN 'Input too long. Maximum 255 characters allowed' END AS error
       FROM (SELECT c_custkey, length(c_name) * (10 + c_custkey % 10) AS n FROM customer)""",
)
check(
    "redact_json",
    lambda s, sf: table(s, sf, "events").select(
        "event_id",
        logs.redact_json(F.format_string(
            '{"user":%d,"API_TOKEN":"t%d","note":"a \\"b\\"","inner":{"password":"p","k":%d},"list":[1,2]}',
            "user_id", "user_id", "event_id")).alias("details")),
    """SELECT event_id, '{"API_TOKEN":"***REDACTED***","inner":{"k":' || event_id || ',"password":"***REDACTED***"},"list":[1,2],"note":"a \\"b\\"","user":'
       || user_id || '}' AS details FROM events""",
)
check(
    "redact_json_deep",
    # Six levels down: a secret that holds an object, a long list, and a list of objects that stays.
    lambda s, sf: table(s, sf, "events").select(
        "event_id",
        logs.redact_json(F.concat(
            F.lit('{"a":{"b":{"c":{"d":{"e":'), F.to_json(F.struct(
                F.col("user_id").alias("keep"), F.struct(F.col("event_id").alias("x")).alias("authData"),
                F.sequence(F.lit(1), F.lit(99) + F.col("event_id") % 4).alias("list"), F.array(F.struct(F.lit("t").alias("token"))).alias("short"))),
            F.lit("}}}}}"))).alias("details")),
    """SELECT event_id, '{"a":{"b":{"c":{"d":{"e":{"authData":"***REDACTED***","keep":' || user_id || ',"list":'
       || CASE WHEN event_id % 4 > 1 THEN '"[' || (99 + event_id % 4) || ' items]"' ELSE '[' || array_to_string(range(1, 100 + event_id % 4), ',') || ']' END
       || ',"short":[{"token":"t"}]}}}}}}' AS details FROM events""",
)
def nested_line(views):
    return F.struct(F.col("l_partkey").cast("string").alias("stream_id"), views.cast("int").alias("times_viewed"), F.col("l_extendedprice").alias("price"))


check(
    "explode_streams",
    lambda s, sf: tidy(ingest.explode_streams(lines(s, sf).select(
        F.col("o_orderkey").alias("invoice"),
        F.to_json(F.array(nested_line(F.col("l_quantity")), nested_line(F.col("l_quantity") + 1))).alias("streams")))),
    final(cte("lines", """SELECT o_orderkey AS invoice, CAST(l_partkey AS VARCHAR) AS stream_id, CAST(l_quantity AS INTEGER) + k AS times_viewed,
        l_extendedprice AS price FROM lines, (SELECT unnest([0, 1]) AS k)"""), "invoice stream_id times_viewed", "price"),
)
check(
    "check_columns",
    lambda s, sf: ingest.check_columns(
        invoices(s, sf).drop("date").withColumnsRenamed({"stream_id": "StreamID", "price": "total_price", "times_viewed": "TimesViewed"})
    ).groupBy("year").agg(F.count("stream_id").alias("streams"), F.sum("times_viewed").alias("views")),
    cte("inv", "SELECT year, count(stream_id) AS streams, CAST(sum(times_viewed) AS BIGINT) AS views FROM inv GROUP BY year"),
)
check(
    "price_filter",
    lambda s, sf: cleaning.price_filter(invoices(s, sf)).agg(
        F.count(F.lit(1)).alias("kept"), F.count_distinct("invoice").alias("invoices")),
    cte("kept", "SELECT count(*) AS kept, count(DISTINCT invoice) AS invoices FROM kept"),
)
check(
    "flag_zscore_outliers",
    lambda s, sf: tidy(cleaning.flag_zscore_outliers(cleaning.price_filter(invoices(s, sf)), "price")
                       .where("price_outlier").select("invoice", "stream_id", "price")),
    final(cte("clean", "SELECT * FROM clean WHERE is_price_outlier"), "invoice stream_id", "price"),
)
check(
    "flag_iqr_outliers",
    lambda s, sf: tidy(cleaning.flag_iqr_outliers(invoices(s, sf), "price").where("price_iqr_outlier").select("invoice", "stream_id", "price")),
    final(cte("inv", """SELECT inv.* FROM inv, (SELECT quantile_cont(price, 0.25) a, quantile_cont(price, 0.75) b FROM inv)
        WHERE price < a - 1.5::DOUBLE * (b - a) OR price > b + 1.5::DOUBLE * (b - a)"""), "invoice stream_id", "price"),
)
check(
    "flag_iqr_outliers_by_country",
    lambda s, sf: cleaning.flag_iqr_outliers(invoices(s, sf), "price", ["country"]).groupBy("country").agg(
        F.count_if("price_iqr_outlier").alias("outliers")),
    cte("inv", """SELECT inv.country, count(*) FILTER (price < a - 1.5::DOUBLE * (b - a) OR price > b + 1.5::DOUBLE * (b - a)) AS outliers
        FROM inv JOIN (SELECT country, quantile_cont(price, 0.25) a, quantile_cont(price, 0.75) b FROM inv GROUP BY country) q
        ON inv.country = q.country GROUP BY inv.country"""),
)
check(
    "flag_missing_customer",
    lambda s, sf: cleaning.flag_missing_customer(invoices(s, sf)).groupBy("country", "has_customer_id").agg(F.count(F.lit(1)).alias("n")),
    cte("inv", "SELECT country, customer_id IS NOT NULL AS has_customer_id, count(*) AS n FROM inv GROUP BY ALL"),
)
check(
    "cast_clean_types",
    lambda s, sf: tidy(cleaning.cast_clean_types(
        invoices(s, sf).withColumn("customer_id", F.col("customer_id").cast("double")).withColumn("times_viewed", F.col("times_viewed").cast("double"))
    ).groupBy("customer_id").agg(F.sum("times_viewed").alias("views"))),
    cte("inv", "SELECT customer_id, CAST(sum(times_viewed) AS BIGINT) AS views FROM inv GROUP BY customer_id"),
)
check(
    "clean_invoices",
    lambda s, sf: tidy(clean(s, sf).select(
        "invoice", "country", "customer_id", "stream_id", "price", "times_viewed", "date", "has_customer_id", "is_price_outlier", "is_view_outlier")),
    final(cte("clean", "SELECT *, customer_id IS NOT NULL AS has_customer_id FROM clean"),
          "invoice country customer_id stream_id times_viewed has_customer_id is_price_outlier is_view_outlier", "price", "date"),
)
METRICS_SQL = cte("clean", """SELECT (SELECT count(*) FROM inv) AS total_records,
    (SELECT count(*) FROM inv WHERE customer_id IS NULL) AS missing_customer_ids,
    (SELECT count(*) FROM inv WHERE price < 0.01 OR price > 10000) AS invalid_prices,
    count(*) FILTER (is_price_outlier) AS price_outliers, count(*) FILTER (is_view_outlier) AS view_outliers,
    count(*) AS valid_records FROM clean""")
check("cleaning_metrics", lambda s, sf: cleaning.cleaning_metrics(invoices(s, sf)), METRICS_SQL)
check(
    "overall_quality_score",
    lambda s, sf: tidy(cleaning.overall_quality_score(cleaning.cleaning_metrics(invoices(s, sf)))),
    final(f"SELECT *, valid_records::DOUBLE / total_records AS overall_quality_score FROM ({METRICS_SQL})",
          "total_records valid_records", "overall_quality_score"),
)
check(
    "high_engagement",
    lambda s, sf: tidy(cleaning.high_engagement(invoices(s, sf))),
    final(cte("inv", """SELECT count(*) FILTER (times_viewed > vq) AS high_engagement,
        avg(price) FILTER (times_viewed > vq) AS high_engagement_avg_price, avg(price) AS avg_price,
        count(*) FILTER (price > pq AND times_viewed <= 2) AS high_price_low_engagement,
        avg(price) FILTER (price > pq AND times_viewed <= 2) AS high_price_low_engagement_avg_price,
        count(*) FILTER (times_viewed > 2 * vm) * 100.0::DOUBLE / count(*) AS busy_share
        FROM inv, (SELECT quantile_cont(times_viewed::DOUBLE, 0.8) vq, quantile_cont(price, 0.8) pq, avg(times_viewed) vm FROM inv)"""),
        "high_engagement high_price_low_engagement",
        "high_engagement_avg_price avg_price high_price_low_engagement_avg_price busy_share"),
)
# A random sample has no SQL twin; its size is what can be told.
check("sample_rows", lambda s, sf: tidy(cleaning.sample_rows(invoices(s, sf), fraction=0.3)))
check("sample_rows_exact", lambda s, sf: tidy(cleaning.sample_rows(invoices(s, sf), n=1000)))
check(
    "request_logs",
    lambda s, sf: tidy(logs.request_logs(requests(s, sf)).select(
        "timestamp", "level", "category", "message", "country", "model_type", "user_id", "request_id", "duration_seconds",
        F.get_json_object("details", "$.request_data").alias("body"))),
    final(cte("reqs", """SELECT epoch_us(timestamp) AS timestamp,
        CASE WHEN status_code >= 500 THEN 'ERROR' WHEN status_code >= 400 THEN 'WARNING' ELSE 'INFO' END AS level,
        'api_request' AS category, 'POST ' || endpoint || ' -> ' || status_code AS message, 'C' || (user_id % 5) AS country,
        CASE WHEN user_id % 2 = 0 THEN 'prophet' ELSE 'arima' END AS model_type, CAST(user_id AS VARCHAR) AS user_id,
        CAST(event_id AS VARCHAR) AS request_id, response_time_ms / 1000 AS duration_seconds,
        '{"api_token":"***REDACTED***","country":"C' || (user_id % 5) || '","model_type":"' || CASE WHEN user_id % 2 = 0 THEN 'prophet' ELSE 'arima' END
        || '"}' AS body FROM reqs"""),
        "timestamp level category message country model_type user_id request_id body", "duration_seconds"),
)
check(
    "model_operation_logs",
    lambda s, sf: logs.model_operation_logs(api_logs(s, sf).select(
        "timestamp", F.when(F.col("category") == "click", "training").otherwise(F.col("category")).alias("operation"), "country", "model_type",
        F.lit(1.5).alias("duration_seconds"), (F.col("level") != "ERROR").alias("success"), "details"))
    .groupBy("level", "message", "category").agg(F.count(F.lit(1)).alias("n")),
    cte("logs", """SELECT CASE WHEN level = 'ERROR' THEN 'ERROR' ELSE 'INFO' END AS level,
        'Model ' || CASE category WHEN 'click' THEN 'training' ELSE category END || CASE WHEN level = 'ERROR' THEN ' failed for ' ELSE ' completed for ' END
        || model_type || ' model in ' || country AS message, CASE category WHEN 'click' THEN 'model_training' ELSE 'system_event' END AS category, count(*) AS n FROM logs GROUP BY ALL"""),
)
check(
    "error_logs",
    lambda s, sf: logs.error_logs(api_logs(s, sf).where("level = 'ERROR'").select("timestamp", "message", "details", "country"))
    .groupBy("level", "category", "message", "country").agg(F.count(F.lit(1)).alias("n")),
    cte("logs", "SELECT 'ERROR' AS level, 'error_event' AS category, message, country, count(*) AS n FROM logs WHERE level = 'ERROR' GROUP BY ALL"),
)
check(
    "data_access_logs",
    lambda s, sf: logs.data_access_logs(api_logs(s, sf).groupBy("category").agg(
        F.max("timestamp").alias("timestamp"), F.count(F.lit(1)).alias("records_affected"), F.count_if(F.col("level") == "ERROR").alias("bad"))
        .select("timestamp", F.lit("SELECT").alias("operation"), F.col("category").alias("database"), F.lit("read").alias("query_type"),
                "records_affected", (F.col("bad") == 0).alias("success"), F.lit(0.5).alias("duration_seconds")))
    .select("level", "category", "message", "details"),
    cte("logs", """SELECT CASE WHEN b > 0 THEN 'ERROR' ELSE 'INFO' END AS level, 'data_access' AS category, 'Data access: SELECT on ' || c || ' (' || n || ' records)' AS message,
        '{"operation":"SELECT","database":"' || c || '","query_type":"read","records_affected":' || n || ',"success":' || CASE WHEN b > 0 THEN 'false' ELSE 'true' END || '}' AS details
        FROM (SELECT category AS c, count(*) AS n, count(*) FILTER (level = 'ERROR') AS b FROM logs GROUP BY category)"""),
)


# Sources and sinks: files made from the given tables, written and read back.
RAW_NAMES = "invoice country customer_id stream_id StreamID price total_price times_viewed TimesViewed year month day".split()


def invoice_folder(spark, sf, per_file=5000):
    """The raw records as JSON array files of about ``per_file`` records, and one that is cut off."""
    rows = raw_records(spark, sf).select(*RAW_NAMES)
    # The number of files follows from that of the lines, which takes no join.
    n = 1 + table(spark, sf, "lineitem").count() // per_file
    path = fresh_path(spark, "json-files")
    texts = rows.groupBy(F.pmod(F.xxhash64("invoice", "stream_id", "StreamID"), F.lit(n)).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(*RAW_NAMES))), ","), F.lit("]")).alias("value"))
    texts = texts.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("file"), F.lit('[{"invoice": ').alias("value")))
    # A row a file: the texts need not move again, nor have a folder each.
    texts.select("value").write.option("maxRecordsPerFile", 1).text(path)
    drop_shuffles(spark)
    return path


def ingested(spark, sf, what):
    """The tables below a base after a batch, its repetition, a forced run and a stream over the same files."""
    folder, base = invoice_folder(spark, sf), fresh_path(spark, "base")
    for force, key in ((False, "first"), (False, "first"), (True, "again"), (False, None)):
        summary = load_invoices.ingest_batch(spark, folder, base, force, key, "*.txt")
        if key == "first":
            first = summary
    ingest_stream(spark, folder, base, fresh_path(spark, "state"), pattern="*.txt").awaitTermination()
    if what == "summary":
        return first
    if what == "ledger":
        return sources.latest_ledger(load_invoices.ledger_table(spark, base))
    return sources.read_invoice_table(spark, f"{base}/invoices") if what == "invoices" else spark.read.parquet(f"{base}/rejects")


def streamed_invoices(spark, sf):
    folder, base = invoice_folder(spark, sf), fresh_path(spark, "base")
    for state in ("one", "two"):  # a fresh state reads all files again
        ingest_stream(spark, folder, base, fresh_path(spark, state), files_per_batch=3, pattern="*.txt").awaitTermination()
    return sources.read_invoice_table(spark, f"{base}/invoices")


STORED = "invoice customer_id stream_id price times_viewed date country".split()
STORED_SQL = final(
    cte("good", """SELECT invoice, customer_id, stream_id, price, times_viewed, date, min(country) AS country FROM good
        GROUP BY invoice, customer_id, stream_id, price, times_viewed, date"""),
    "invoice customer_id stream_id times_viewed country", "price", "date")
check(
    "read_invoices",
    lambda s, sf: sources.read_invoices(s, invoice_folder(s, sf), "*.txt").where("file_error is null").select(*RAW_NAMES),
    cte("lines", """SELECT CAST(o_orderkey AS VARCHAR) AS invoice,
        CASE WHEN l_partkey % 97 <> 0 THEN n_name END AS country,
        CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
        CASE WHEN l_linenumber % 2 = 0 THEN id END AS stream_id, CASE WHEN l_linenumber % 2 <> 0 THEN id END AS StreamID,
        CASE WHEN l_linenumber % 3 = 0 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) END AS price,
        CASE WHEN l_linenumber % 3 <> 0 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) END AS total_price,
        CASE WHEN l_linenumber % 4 = 0 THEN CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) END AS times_viewed,
        CASE WHEN l_linenumber % 4 <> 0 AND l_partkey % 7 <> 0 THEN CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) END AS TimesViewed,
        CAST(year(o_orderdate) AS VARCHAR) AS year, CASE WHEN l_partkey % 89 = 0 THEN '2' ELSE CAST(month(o_orderdate) AS VARCHAR) END AS month,
        CASE WHEN l_partkey % 89 = 0 THEN '31' ELSE CAST(day(o_orderdate) AS VARCHAR) END AS day FROM
        (SELECT *, CASE WHEN l_partkey % 50 = 0 THEN 'POST' WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS VARCHAR) || 'A' ELSE CAST(l_partkey AS VARCHAR) END AS id FROM lines)"""),
)
check("ingest_batch", lambda s, sf: tidy(ingested(s, sf, "invoices").select(*STORED)), STORED_SQL)
check("ingest_stream", lambda s, sf: tidy(streamed_invoices(s, sf).select(*STORED)), STORED_SQL)
check(
    "ingest_rejects",
    lambda s, sf: ingested(s, sf, "rejects").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("reject_key").alias("keys")),
    cte("typed", """SELECT CASE WHEN country IS NULL THEN 'missing: country' ELSE 'not a calendar date' END AS reject_reason, count(*) AS records,
        count(*) AS keys FROM typed WHERE country IS NULL OR date IS NULL GROUP BY ALL UNION ALL SELECT 'unreadable JSON', 1, 1"""),
)
check(
    "ingest_ledger",
    lambda s, sf: ingested(s, sf, "ledger").groupBy("processing_status").agg(F.sum("records_processed").alias("records"), F.count("error_message").alias("errors")),
    cte("typed", """SELECT 'completed' AS processing_status, count(*) FILTER (country IS NOT NULL AND date IS NOT NULL) AS records, 0 AS errors FROM typed
        UNION ALL SELECT 'failed', 0, 1"""),
)
check(
    "ingest_batch_summary",
    lambda s, sf: ingested(s, sf, "summary").drop("files_processed"),
    cte("typed", """SELECT count(*) FILTER (country IS NOT NULL AND date IS NOT NULL) AS records,
        count(*) FILTER (country IS NULL OR date IS NULL) + 1 AS errors, 'completed' AS status FROM typed"""),
)


def back(spark, label, write, read):
    path = fresh_path(spark, label)
    write(path)
    return read(path)


def csv_round_trip(s, sf):
    rows = invoices(s, sf).select("invoice", "country", "customer_id", "price", "date")
    return back(s, "csv", lambda p: sources.write_csv(rows, p), lambda p: sources.read_csv(s, p, rows.schema))


check("csv_round_trip", lambda s, sf: tidy(csv_round_trip(s, sf)), final(cte("inv", "SELECT * FROM inv"), "invoice country customer_id", "price", "date"))


def series_csv_round_trip(s, sf):
    rows = series(s, sf).select("series", "ds", "y")
    back_schema = "ds date, y double, series string"
    return back(s, "series-csv", lambda p: sources.write_series_csv(rows, p), lambda p: sources.read_series_csv(s, p, back_schema))


check("series_csv_round_trip", lambda s, sf: tidy(series_csv_round_trip(s, sf)), final(cte("series", "SELECT series, ds, y FROM series"), "series", "y", "ds"))


def later_tables(s, sf, name):
    """A result table of the later dates, given the visits before them."""
    rows = invoices(s, sf)
    earlier = metrics.customer_visits(cleaning.price_filter(rows).where("date < '1997-01-01'"))
    return build_tables.result_tables(rows, "1997-01-01", None, earlier)[name]


# The second part of the dates by its own statistics; visits before it decide who is new.
LATER = {
    "late": "SELECT * FROM kept WHERE date >= '1997-01-01'",
    "vis": "SELECT DISTINCT customer_id, date, country FROM kept WHERE customer_id IS NOT NULL",
    "prev": """SELECT * FROM (SELECT *, max(date) OVER (PARTITION BY customer_id ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS previous
               FROM vis) WHERE date >= '1997-01-01'""",
    "cust": """SELECT *, date - previous AS away FROM (SELECT date, country, customer_id, round_even(round(sum(price), 6) * 100, 0) / 100 AS spend, count(*) AS frequency
               FROM late WHERE customer_id IS NOT NULL GROUP BY ALL) JOIN prev USING (date, country, customer_id)""",
    "cuts": "SELECT date, country, quantile_cont(spend, 0.75) AS sq, quantile_cont(frequency::DOUBLE, 0.75) AS fq FROM cust GROUP BY date, country",
}
check(
    "stored_daily_metrics",
    lambda s, sf: tidy(later_tables(s, sf, "daily_aggregated_metrics").select(
        "country", "date", "total_transactions", "total_revenue", "new_customers", "returning_customers", "customer_retention_rate")),
    final(cte("kept", """SELECT date, country, n AS total_transactions, r AS total_revenue, coalesce(new, 0) AS new_customers, coalesce(old, 0) AS returning_customers,
        coalesce(old::DOUBLE / (new + old), 0) AS customer_retention_rate FROM (SELECT date, country, count(*) AS n, sum(price) AS r FROM late GROUP BY ALL)
        LEFT JOIN (SELECT date, country, count(*) FILTER (previous IS NULL) AS new, count(*) FILTER (previous IS NOT NULL) AS old FROM prev GROUP BY ALL) USING (date, country)""", **LATER),
        "country total_transactions new_customers returning_customers", "total_revenue customer_retention_rate", "date"),
)
check(
    "stored_segments",
    lambda s, sf: tidy(later_tables(s, sf, "customer_segment_metrics").drop("new_customers_count", "avg_customer_lifetime_value", "avg_frequency", "avg_monetary_value")),
    final(cte("kept", """SELECT date, country, count(*) FILTER (spend >= sq AND frequency >= fq) AS champions_count, count(*) FILTER (spend < sq AND frequency >= fq) AS loyal_customers_count,
        coalesce(avg(away), 0) AS avg_recency_days, count(*) FILTER (away <= 30 AND spend < sq AND frequency < fq) AS potential_loyalists_count,
        count(*) FILTER (away > 90 AND frequency >= fq AND spend < sq) AS at_risk_count, count(*) FILTER (away > 90 AND spend >= sq) AS cannot_lose_count,
        count(*) FILTER (away > 90 AND spend < sq AND frequency < fq) AS hibernating_count, count(*) FILTER (away IS NULL)::DOUBLE / count(*) AS customer_acquisition_rate,
        avg(CASE WHEN away IS NULL THEN 0 ELSE least(1.0::DOUBLE, away / 90.0::DOUBLE) END) AS customer_churn_risk_score FROM cust JOIN cuts USING (date, country) GROUP BY date, country""", **LATER),
        "country champions_count loyal_customers_count potential_loyalists_count at_risk_count cannot_lose_count hibernating_count",
        "avg_recency_days customer_acquisition_rate customer_churn_risk_score", "date"),
)
check(
    "stored_products",
    lambda s, sf: tidy(later_tables(s, sf, "product_performance_metrics").select("country", "date", "stream_id", "transactions", "revenue", "customer_penetration")),
    final(cte("kept", """SELECT date, country, stream_id, count(*) AS transactions, sum(price) AS revenue,
        coalesce(count(DISTINCT customer_id)::DOUBLE / nullif(any_value(all_customers), 0), 0) AS customer_penetration FROM late
        JOIN (SELECT date, country, count(DISTINCT customer_id) AS all_customers FROM late GROUP BY date, country) USING (date, country) GROUP BY date, country, stream_id""", **LATER),
        "country stream_id transactions", "revenue customer_penetration", "date"),
)
check(
    "report_round_trip",
    lambda s, sf: tidy(back(s, "report", lambda p: sources.save_report(daily(s, sf).groupBy("country").agg(F.sum("total_revenue").alias("revenue"), F.count("date").alias("days")), p), s.read.json)),
    final(cte("daily", "SELECT country, sum(total_revenue) AS revenue, count(*) AS days FROM daily GROUP BY country"), "country days", "revenue"),
)


def history_round_trip(s, sf):
    """Model history as one JSON object of lists, as it is kept on disk."""
    fields = "mae mape rmse mase r2 timestamp model_type country".split()
    per_model = history(s, sf).groupBy(F.concat_ws("_", "country", "model_type").alias("k")).agg(F.collect_list(F.struct(*fields)).alias("v"))
    text = per_model.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", "v")))).alias("value"))
    return back(s, "history", text.write.text, lambda p: sources.read_metrics_history(s, p))


check(
    "read_metrics_history",
    lambda s, sf: tidy(history_round_trip(s, sf).select("key", "country", "timestamp", "r2", "mae")),
    final(cte("history", "SELECT country || '_' || model_type AS key, country, epoch_us(timestamp) AS timestamp, r2, mae FROM history"), "key country timestamp", "r2 mae"),
)
