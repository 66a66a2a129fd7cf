"""Input frames derived from the given tables, and the same inputs as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlake.operators.cleaning import clean_invoices
from revlake.operators.metrics import daily_metrics
from revlake.operators.series import complete_calendar, revenue_series

# Results are compared on a grid. The offset keeps grid edges away from the decimals that sums,
# means and halves of prices fall on, where two engines' last bits would decide.
EDGE = 0.3765


def grid(c: Column, digits: int = 4) -> Column:
    return F.floor(c * float(10**digits) + EDGE) / float(10**digits)


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles on the grid, dates as text, timestamps as microseconds."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = grid(c, digits)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def final(body: str, plain: str = "", dbl: str = "", date: str = "", digits: int = 4) -> str:
    """SQL counterpart of ``tidy`` with the columns named per kind."""
    scale = f"1e{digits}"
    columns = plain.split()
    columns += [f"floor({c} * {scale} + {EDGE}) / {scale} AS {c}" for c in dbl.split()]
    columns += [f"CAST({c} AS VARCHAR) AS {c}" for c in date.split()]
    return f"SELECT {', '.join(columns)} FROM ({body}) AS t"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with order, customer and nation."""
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def _stream_id() -> Column:
    part = F.col("l_partkey")
    text = part.cast("string")
    return F.when(part % 50 == 0, "POST").when(part % 3 == 0, F.concat(text, F.lit("A"))).otherwise(text)


def _customer() -> Column:
    return F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey"))


def invoices(spark: SparkSession, sf: str) -> DataFrame:
    date = F.col("o_orderdate").cast("date")
    return lines(spark, sf).select(
        F.col("o_orderkey").cast("string").alias("invoice"),
        F.col("n_name").alias("country"),
        _customer().alias("customer_id"),
        _stream_id().alias("stream_id"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("price"),
        F.col("l_quantity").cast("int").alias("times_viewed"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        date.alias("date"),
    )


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_invoices(invoices(spark, sf))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return daily_metrics(clean(spark, sf))


def series(spark: SparkSession, sf: str) -> DataFrame:
    """Daily revenue per country without gaps: series, ds, y."""
    return complete_calendar(revenue_series(invoices(spark, sf)))


def sparse_series(spark: SparkSession, sf: str) -> DataFrame:
    return revenue_series(invoices(spark, sf))


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records as they come in files: mixed names, missing fields, impossible dates."""
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    date = F.col("o_orderdate").cast("date")
    broken = part % 89 == 0
    price = F.floor("l_extendedprice").cast("string")
    views = F.col("l_quantity").cast("int").cast("string")
    return lines(spark, sf).select(
        F.col("o_orderkey").cast("string").alias("invoice"),
        F.when(part % 97 != 0, F.col("n_name")).alias("country"),
        _customer().cast("string").alias("customer_id"),
        F.when(line % 2 == 0, _stream_id()).alias("stream_id"),
        F.when(line % 2 != 0, _stream_id()).alias("StreamID"),
        F.when(line % 3 == 0, price).alias("price"),
        F.when(line % 3 != 0, price).alias("total_price"),
        F.when(line % 4 == 0, views).alias("times_viewed"),
        F.when((line % 4 != 0) & (part % 7 != 0), views).alias("TimesViewed"),
        F.year(date).cast("string").alias("year"),
        F.when(broken, "2").otherwise(F.month(date).cast("string")).alias("month"),
        F.when(broken, "31").otherwise(F.dayofmonth(date).cast("string")).alias("day"),
        F.concat(F.lit("invoices-"), F.col("o_orderstatus"), F.lit(".json")).alias("source_file"),
    )


def api_logs(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(kind == "error", "ERROR").when(kind == "signup", "WARNING").otherwise("INFO").alias("level"),
        kind.alias("category"),
        F.concat(kind, F.lit(" "), F.get_json_object("props", "$.k")).alias("message"),
        F.col("props").alias("details"),
        F.concat(F.lit("C"), (F.col("user_id") % 5).cast("string")).alias("country"),
        F.when(F.col("user_id") % 2 == 0, "prophet").otherwise("arima").alias("model_type"),
        F.col("event_id"),
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    body = F.format_string(
        '{"country":"C%d","model_type":"%s","api_token":"t%d"}',
        F.col("user_id") % 5,
        F.when(F.col("user_id") % 2 == 0, "prophet").otherwise("arima"),
        F.col("user_id"),
    )
    return table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        kind.alias("endpoint"),
        F.lit("POST").alias("method"),
        F.col("value").alias("response_time_ms"),
        F.when(kind == "error", 500).when(kind == "signup", 404).otherwise(200).alias("status_code"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_id").cast("string").alias("request_id"),
        body.alias("request_data"),
    )


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Model performance records: one per event type and day."""
    return (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("country"), F.to_date("ts").alias("d"))
        .agg(F.avg("value").alias("v"))
        .select(
            "country",
            F.lit("arima").alias("model_type"),
            F.col("d").cast("timestamp").alias("timestamp"),
            (1 / (1 + F.col("v") / 100)).alias("r2"),
            F.col("v").alias("mae"),
            (F.col("v") * 1.5).alias("rmse"),
            (F.col("v") / 10).alias("mape"),
            (F.col("v") / 20).alias("mase"),
        )
    )


# The same inputs for the SQL side, in dependency order.
CTES = {
    "lines": """
        SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "inv": """
        SELECT CAST(o_orderkey AS VARCHAR) AS invoice, n_name AS country,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS customer_id,
               CASE WHEN l_partkey % 50 = 0 THEN 'POST'
                    WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS VARCHAR) || 'A'
                    ELSE CAST(l_partkey AS VARCHAR) END AS stream_id,
               l_extendedprice * l_discount AS price, CAST(trunc(l_quantity) AS INTEGER) AS times_viewed,
               CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
        FROM lines""",
    "kept": "SELECT * FROM inv WHERE NOT (price < 0.01 OR price > 10000)",
    "stats": """
        SELECT avg(price) AS mp, stddev_samp(price) AS sp, avg(times_viewed::DOUBLE) AS mv,
               stddev_samp(times_viewed::DOUBLE) AS sv FROM kept""",
    "clean": """
        SELECT kept.*, coalesce(abs((price - mp) / nullif(sp, 0)) > 3, false) AS is_price_outlier,
               coalesce(abs((times_viewed - mv) / nullif(sv, 0)) > 3, false) AS is_view_outlier
        FROM kept, stats""",
    "daily": """
        SELECT date, country, year(date) AS year, month(date) AS month, day(date) AS day,
               isodow(date) - 1 AS day_of_week, week(date) AS week_of_year,
               sum(price) AS total_revenue, avg(price) AS avg_transaction_value, min(price) AS min_transaction_value,
               max(price) AS max_transaction_value, quantile_cont(price, 0.5) AS median_transaction_value,
               coalesce(stddev_samp(price), 0) AS revenue_std_dev, count(*) AS total_transactions,
               count(DISTINCT invoice) AS unique_invoices, count(DISTINCT customer_id) AS unique_customers,
               count(DISTINCT stream_id) AS unique_products,
               coalesce(sum(price) FILTER (customer_id IS NOT NULL) / nullif(count(DISTINCT customer_id), 0), 0)
                   AS avg_customer_value,
               CAST(sum(times_viewed) AS BIGINT) AS total_views,
               sum(times_viewed)::DOUBLE / count(DISTINCT stream_id) AS avg_views_per_product,
               coalesce(count(*)::DOUBLE / nullif(sum(times_viewed), 0), 0) AS view_to_purchase_ratio,
               count(*) FILTER (is_price_outlier OR is_view_outlier) AS outlier_transactions,
               count(*) FILTER (customer_id IS NULL) AS missing_customer_ids,
               1 - (count(*) FILTER (is_price_outlier OR is_view_outlier)
                    + count(*) FILTER (customer_id IS NULL))::DOUBLE / count(*) AS data_quality_score,
               count(*) AS source_record_count
        FROM clean GROUP BY date, country""",
    "custs": """
        SELECT customer_id, sum(price) AS total_spent, avg(price) AS avg_price, count(*) AS transactions,
               CAST(sum(times_viewed) AS BIGINT) AS total_views, min(date) AS first_purchase, max(date) AS last_purchase
        FROM inv WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    "markets": """
        SELECT *, round_even(total_revenue / sum(total_revenue) OVER () * 100 * 100, 0) / 100 AS market_share,
               round_even(total_revenue / nullif(unique_customers, 0) * 100, 0) / 100 AS revenue_per_customer,
               round_even(total_revenue / transactions * 100, 0) / 100 AS revenue_per_transaction
        FROM (SELECT country, round_even(round(sum(price), 6) * 100, 0) / 100 AS total_revenue, count(price) AS transactions,
                     round_even(round(avg(price), 6) * 100, 0) / 100 AS avg_price, count(DISTINCT customer_id) AS unique_customers,
                     CAST(sum(times_viewed) AS BIGINT) AS total_views
              FROM inv GROUP BY country)""",
    "streams": """
        SELECT *, round_even(total_revenue / nullif(unique_customers, 0) * 100, 0) / 100 AS revenue_per_customer,
               round_even(total_views::DOUBLE / transactions * 100, 0) / 100 AS views_per_transaction
        FROM (SELECT stream_id, round_even(round(sum(price), 6) * 100, 0) / 100 AS total_revenue,
                     round_even(round(avg(price), 6) * 100, 0) / 100 AS avg_price, count(price) AS transactions,
                     round_even(round(stddev_samp(price), 6) * 100, 0) / 100 AS price_std,
                     CAST(sum(times_viewed) AS BIGINT) AS total_views,
                     round_even(round(avg(times_viewed), 6) * 100, 0) / 100 AS avg_views,
                     count(DISTINCT customer_id) AS unique_customers
              FROM inv GROUP BY stream_id)""",
    "sparse": "SELECT country AS series, date AS ds, sum(price) AS y FROM inv GROUP BY country, date",
    "series": """
        SELECT s.series, s.ds, coalesce(p.y, 0) AS y
        FROM (SELECT series, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
              FROM sparse GROUP BY series) s
        LEFT JOIN sparse p ON s.series = p.series AND s.ds = p.ds""",
    "raw": """
        SELECT CAST(o_orderkey AS VARCHAR) AS invoice, CASE WHEN l_partkey % 97 <> 0 THEN n_name END AS country,
               CAST(CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS VARCHAR) AS customer_id,
               CASE WHEN l_partkey % 50 = 0 THEN 'POST'
                    WHEN l_partkey % 3 = 0 THEN CAST(l_partkey AS VARCHAR) || 'A'
                    ELSE CAST(l_partkey AS VARCHAR) END AS stream_id,
               CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS price,
               CASE WHEN l_linenumber % 4 = 0 OR l_partkey % 7 <> 0
                    THEN CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) END AS times_viewed,
               CAST(year(o_orderdate) AS VARCHAR) AS year,
               CASE WHEN l_partkey % 89 = 0 THEN '2' ELSE CAST(month(o_orderdate) AS VARCHAR) END AS month,
               CASE WHEN l_partkey % 89 = 0 THEN '31' ELSE CAST(day(o_orderdate) AS VARCHAR) END AS day,
               'invoices-' || o_orderstatus || '.json' AS source_file
        FROM lines""",
    "typed": """
        SELECT invoice, country, CAST(customer_id AS BIGINT) AS customer_id, stream_id, CAST(price AS DOUBLE) AS price,
               coalesce(CAST(times_viewed AS INTEGER), 0) AS times_viewed, CAST(year AS INTEGER) AS year,
               CAST(month AS INTEGER) AS month, CAST(day AS INTEGER) AS day, source_file,
               TRY_CAST(year || '-' || lpad(month, 2, '0') || '-' || lpad(day, 2, '0') AS DATE) AS date
        FROM raw""",
    "good": "SELECT * FROM typed WHERE country IS NOT NULL AND date IS NOT NULL",
    "logs": """
        SELECT ts AS timestamp,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS level,
               event_type AS category, event_type || ' ' || json_extract_string(props, '$.k') AS message,
               props AS details, 'C' || CAST(user_id % 5 AS VARCHAR) AS country,
               CASE WHEN user_id % 2 = 0 THEN 'prophet' ELSE 'arima' END AS model_type, event_id
        FROM events""",
    "reqs": """
        SELECT ts AS timestamp, event_type AS endpoint, 'POST' AS method, value AS response_time_ms,
               CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 ELSE 200 END AS status_code,
               user_id, event_id FROM events""",
    "history": """
        SELECT event_type AS country, 'arima' AS model_type, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS timestamp,
               1 / (1 + avg(value) / 100) AS r2, avg(value) AS mae, avg(value) * 1.5::DOUBLE AS rmse,
               avg(value) / 10 AS mape, avg(value) / 20 AS mase
        FROM events GROUP BY event_type, CAST(ts AS DATE)""",
}
NEEDS = {
    "inv": ["lines"], "kept": ["inv"], "stats": ["kept"], "clean": ["kept", "stats"], "daily": ["clean"],
    "custs": ["inv"], "markets": ["inv"], "streams": ["inv"], "sparse": ["inv"], "series": ["sparse"],
    "raw": ["lines"], "typed": ["raw"], "good": ["typed"],
}


def cte(names: str, body: str, **extra: str) -> str:
    """``body`` under a WITH clause holding the named inputs and what they need, then ``extra``."""
    wanted: set[str] = set()

    def need(name: str) -> None:
        for other in NEEDS.get(name, []):
            need(other)
        wanted.add(name)

    for name in names.split():
        need(name)
    parts = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in CTES if n in wanted]
    parts += [f"{n} AS MATERIALIZED ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(parts)} {body}"
