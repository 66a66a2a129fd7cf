"""The result tables and the queries served from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import clean, cte, daily, final, invoices, tidy
from revlake.operators import cleaning, metrics, serving
from revlake.session import pinned

QUERIES, ORACLES = {}, {}


def check(name, query, sql=None):
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


check(
    "daily_metrics",
    lambda s, sf: tidy(daily(s, sf)),
    final(
        cte("daily", "SELECT * FROM daily"),
        "country year month day day_of_week week_of_year total_transactions unique_invoices unique_customers unique_products "
        "total_views outlier_transactions missing_customer_ids source_record_count",
        "total_revenue avg_transaction_value min_transaction_value max_transaction_value median_transaction_value "
        "revenue_std_dev avg_customer_value avg_views_per_product view_to_purchase_ratio data_quality_score",
        "date",
    ),
)
SEGMENTS_SQL = cte(
    "clean",
    """SELECT date, country, avg(frequency) AS avg_frequency, avg(spend) AS avg_monetary_value,
        count(*) FILTER (spend >= sq AND frequency >= fq) AS champions_count,
        count(*) FILTER (spend < sq AND frequency >= fq) AS loyal_customers_count,
        count(*) AS new_customers_count, avg(spend) AS avg_customer_lifetime_value
        FROM c JOIN (SELECT date, country, quantile_cont(spend, 0.75) AS sq, quantile_cont(frequency::DOUBLE, 0.75) AS fq
                     FROM c GROUP BY date, country) q USING (date, country) GROUP BY date, country""",
    c="""SELECT date, country, customer_id, round_even(round(sum(price), 6) * 100, 0) / 100 AS spend, count(*) AS frequency
         FROM clean WHERE customer_id IS NOT NULL GROUP BY ALL""",
)
check(
    "customer_segments",
    lambda s, sf: tidy(metrics.customer_segments(clean(s, sf))),
    final(SEGMENTS_SQL, "country champions_count loyal_customers_count new_customers_count",
          "avg_frequency avg_monetary_value avg_customer_lifetime_value", "date"),
)
# Revenue is brought to the grid's precision before ranking, so that equal sums stay equal in both engines.
PRODUCTS_SQL = cte("clean", """SELECT date, country, stream_id, sum(price) AS revenue, count(*) AS transactions,
    count(DISTINCT customer_id) AS unique_customers, CAST(sum(times_viewed) AS BIGINT) AS total_views, avg(price) AS avg_price,
    coalesce(count(*)::DOUBLE / nullif(sum(times_viewed), 0), 0) AS conversion_rate,
    dense_rank() OVER (PARTITION BY date, country ORDER BY sum(price) DESC) AS revenue_rank,
    dense_rank() OVER (PARTITION BY date, country ORDER BY count(*) DESC) AS popularity_rank
    FROM clean GROUP BY date, country, stream_id""")
check(
    "product_performance",
    lambda s, sf: tidy(metrics.product_performance(clean(s, sf))),
    final(PRODUCTS_SQL, "country stream_id transactions unique_customers total_views revenue_rank popularity_rank",
          "revenue avg_price conversion_rate", "date"),
)
check(
    "product_ranks",
    lambda s, sf: tidy(metrics.product_ranks(
        invoices(s, sf).groupBy(F.trunc("date", "year").alias("date"), "country", "stream_id")
        .agg(F.sum("times_viewed").alias("revenue"), F.count(F.lit(1)).alias("transactions")))),
    final(cte("inv", """SELECT *, dense_rank() OVER (PARTITION BY date, country ORDER BY revenue DESC) AS revenue_rank,
        dense_rank() OVER (PARTITION BY date, country ORDER BY transactions DESC) AS popularity_rank FROM
        (SELECT date_trunc('year', date)::DATE AS date, country, stream_id, CAST(sum(times_viewed) AS BIGINT) AS revenue,
         count(*) AS transactions FROM inv GROUP BY 1, 2, 3)"""),
        "country stream_id revenue transactions revenue_rank popularity_rank", "", "date"),
)
QUALITY = "country total_records valid_records missing_customer_ids invalid_prices invalid_dates revenue_anomalies volume_anomalies price_outliers view_count_outliers price_iqr_outliers"
QUALITY_SQL = cte(
    "clean",
    """SELECT b.country, total_records, total_records AS valid_records, missing_customer_ids,
        (SELECT count(*) FROM inv WHERE price < 0.01 OR price > 10000) AS invalid_prices, 0 AS invalid_dates,
        1 - missing_customer_ids::DOUBLE / total_records AS completeness_score, 1.0::DOUBLE AS consistency_score,
        (SELECT 1 - count(*) FILTER (price < 0.01 OR price > 10000)::DOUBLE / count(*) FROM inv) AS accuracy_score,
        (1 - missing_customer_ids::DOUBLE / total_records + 1
          + (SELECT 1 - count(*) FILTER (price < 0.01 OR price > 10000)::DOUBLE / count(*) FROM inv)) / 3 AS overall_quality_score,
        revenue_anomalies, volume_anomalies, price_outliers, view_count_outliers, coalesce(revenue_z_score_max, 0) AS revenue_z_score_max,
        price_iqr_outliers
        FROM b JOIN an ON b.country = an.country JOIN iq ON b.country = iq.country""",
    two="SELECT country, date, price, customer_id, is_price_outlier, is_view_outlier FROM clean UNION ALL SELECT '(all)', date, price, customer_id, is_price_outlier, is_view_outlier FROM clean",
    b="""SELECT country, count(*) AS total_records, count(*) FILTER (customer_id IS NULL) AS missing_customer_ids,
         count(*) FILTER (is_price_outlier) AS price_outliers, count(*) FILTER (is_view_outlier) AS view_count_outliers
         FROM two GROUP BY country""",
    dd="SELECT country, date, sum(price) AS r, count(*)::DOUBLE AS n FROM two GROUP BY country, date",
    ds="SELECT country, avg(r) mr, nullif(stddev_samp(r), 0) sr, avg(n) mn, nullif(stddev_samp(n), 0) sn FROM dd GROUP BY country",
    an="""SELECT dd.country, max(abs((r - mr) / sr)) AS revenue_z_score_max, count(*) FILTER (abs((r - mr) / sr) > 2) AS revenue_anomalies,
          count(*) FILTER (abs((n - mn) / sn) > 2) AS volume_anomalies FROM dd JOIN ds ON dd.country = ds.country GROUP BY dd.country""",
    qq="SELECT country, quantile_cont(price, 0.25) a, quantile_cont(price, 0.75) z FROM two GROUP BY country",
    iq="""SELECT two.country, count(*) FILTER (price < a - 1.5::DOUBLE * (z - a) OR price > z + 1.5::DOUBLE * (z - a)) AS price_iqr_outliers
          FROM two JOIN qq ON two.country = qq.country GROUP BY two.country""",
)
check(
    "quality_report",
    lambda s, sf: tidy(metrics.quality_report(clean(s, sf), cleaning.cleaning_metrics(invoices(s, sf)))).na.fill({"country": "(all)"}),
    final(QUALITY_SQL, QUALITY, "completeness_score consistency_score accuracy_score overall_quality_score revenue_z_score_max"),
)
check(
    "quality_report_empty",
    lambda s, sf: tidy(metrics.quality_report(
        clean(s, sf).where("price < 0"), cleaning.cleaning_metrics(invoices(s, sf)))).na.fill({"country": "(all)"})
    .select("country", "total_records", "valid_records", "missing_customer_ids", "price_outliers", "view_count_outliers",
            "completeness_score", "overall_quality_score", "price_iqr_outliers", "invalid_prices"),
    cte("clean", """SELECT '(all)' AS country, (SELECT count(*) FROM inv) AS total_records, 0 AS valid_records,
        (SELECT count(*) FROM inv WHERE customer_id IS NULL) AS missing_customer_ids, count(*) FILTER (is_price_outlier) AS price_outliers,
        count(*) FILTER (is_view_outlier) AS view_count_outliers, 0.0::DOUBLE AS completeness_score, 0.0::DOUBLE AS overall_quality_score,
        0 AS price_iqr_outliers, (SELECT count(*) FROM inv WHERE price < 0.01 OR price > 10000) AS invalid_prices FROM clean"""),
)
check(
    "volume_anomalies",
    lambda s, sf: metrics.volume_anomalies(clean(s, sf)).na.fill({"country": "(all)"}),
    f"SELECT country, volume_anomalies FROM ({QUALITY_SQL})",
)
check(
    "customer_penetration",
    lambda s, sf: tidy(metrics.customer_penetration(clean(s, sf))),
    final(cte("clean", """SELECT *, coalesce(unique_customers::DOUBLE / nullif(cell_customers, 0), 0) AS customer_penetration FROM
        (SELECT date, country, stream_id, count(DISTINCT customer_id) AS unique_customers FROM clean GROUP BY ALL)
        JOIN (SELECT date, country, count(DISTINCT customer_id) AS cell_customers FROM clean GROUP BY ALL) USING (date, country)"""),
        "country stream_id unique_customers cell_customers", "customer_penetration", "date"),
)
check(
    "l0_stats",
    lambda s, sf: tidy(metrics.l0_stats(invoices(s, sf))),
    final(cte("inv", """SELECT count(*) AS total_records, count(DISTINCT invoice) AS unique_invoice,
        count(DISTINCT customer_id) + max(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS unique_customer_id,
        count(DISTINCT country) AS unique_country, count(DISTINCT stream_id) AS unique_stream_id,
        min(date) AS min_date, max(date) AS max_date FROM inv"""),
        "total_records unique_invoice unique_customer_id unique_country unique_stream_id", "", "min_date max_date"),
)


def four_tables(s, sf):
    """The stored result tables. They are made from the same rows, which are joined once and stored."""
    rows = pinned(invoices(s, sf), "invoices")
    kept = pinned(cleaning.clean_invoices(rows), "clean")
    makers = (
        lambda: metrics.daily_metrics(kept), lambda: metrics.customer_segments(kept), lambda: metrics.product_performance(kept),
        lambda: metrics.quality_report(kept, cleaning.cleaning_metrics(rows)),
    )
    return [pinned(make()) for make in makers]


check(
    "l3_stats",
    lambda s, sf: tidy(metrics.l3_stats(*four_tables(s, sf)), 2)
    .select("table_name", "records", F.coalesce("total_revenue", F.lit(-1.0)).alias("total_revenue"),
            F.coalesce("min_date", F.lit("-")).alias("min_date"), F.coalesce("max_date", F.lit("-")).alias("max_date"),
            F.coalesce("avg_quality", F.lit(-1.0)).alias("avg_quality")),
    "SELECT table_name, records, coalesce(total_revenue, -1) AS total_revenue, coalesce(min_date, '-') AS min_date, "
    "coalesce(max_date, '-') AS max_date, coalesce(avg_quality, -1) AS avg_quality FROM ("
    + final(cte("daily", """
        SELECT 'daily_aggregated_metrics' AS table_name, count(*) AS records, sum(total_revenue) AS total_revenue,
               min(date) AS min_date, max(date) AS max_date, NULL::DOUBLE AS avg_quality FROM daily
        UNION ALL SELECT 'customer_segment_metrics', count(DISTINCT (date, country)), NULL, min(date), max(date), NULL
               FROM clean WHERE customer_id IS NOT NULL
        UNION ALL SELECT 'product_performance_metrics', count(DISTINCT (date, country, stream_id)), sum(price), min(date), max(date), NULL FROM clean
        UNION ALL SELECT 'data_quality_reports', count(*), NULL, NULL, NULL, avg((2 - m::DOUBLE / n + a) / 3)
               FROM (SELECT count(*) AS n, count(*) FILTER (customer_id IS NULL) AS m FROM clean GROUP BY GROUPING SETS ((country), ())),
                    (SELECT 1 - count(*) FILTER (price < 0.01 OR price > 10000)::DOUBLE / count(*) AS a FROM inv)"""),
        "table_name records", "total_revenue avg_quality", "min_date max_date", 2) + ")",
)


def on_daily(name, query, body, plain="", dbl="", date=""):
    check(name, lambda s, sf: tidy(query(daily(s, sf))), final(cte("daily", body), plain, dbl, date))


SUMMARY = """SELECT count(*) AS total_days, min(date) AS min_date, max(date) AS max_date, sum(total_revenue) AS total_revenue,
    CAST(sum(total_transactions) AS BIGINT) AS total_transactions, count(DISTINCT country) AS countries FROM daily"""
on_daily("data_summary", serving.data_summary, SUMMARY, "total_days total_transactions countries", "total_revenue", "min_date max_date")
on_daily("data_summary_of_country", lambda d: serving.data_summary(d, "NATION_3"), SUMMARY + " WHERE country = 'NATION_3'",
         "total_days total_transactions countries", "total_revenue", "min_date max_date")
on_daily("country_stats", serving.country_stats, """SELECT country, count(*) AS days, sum(total_revenue) AS total_revenue,
    avg(total_revenue) AS avg_daily_revenue, min(date) AS first_date, max(date) AS last_date FROM daily GROUP BY country""",
    "country days", "total_revenue avg_daily_revenue", "first_date last_date")
on_daily("business_metrics", lambda d: serving.business_metrics(d, "NATION_5", "1996-01-01", "1998-12-31"),
    """SELECT avg(total_revenue) AS avg_daily_revenue, avg(total_transactions) AS avg_daily_transactions,
    avg(unique_customers) AS avg_daily_customers, avg(avg_transaction_value) AS avg_order_value, sum(total_revenue) AS total_revenue,
    count(*) AS total_days, max(total_revenue) AS max_daily_revenue, min(total_revenue) AS min_daily_revenue,
    stddev_samp(total_revenue) AS revenue_std_dev FROM daily
    WHERE country = 'NATION_5' AND date BETWEEN '1996-01-01' AND '1998-12-31'""", "total_days",
    "avg_daily_revenue avg_daily_transactions avg_daily_customers avg_order_value total_revenue max_daily_revenue min_daily_revenue revenue_std_dev")
on_daily("verify_summary", serving.verify_summary, """SELECT count(*) AS records, min(date) AS min_date, max(date) AS max_date,
    count(DISTINCT country) AS countries, printf('%.2f', sum(total_revenue)) AS total_revenue,
    CAST(sum(total_transactions) AS BIGINT) AS total_transactions FROM daily""",
    "records countries total_revenue total_transactions", "", "min_date max_date")
on_daily("top_countries", serving.top_countries, """SELECT country, sum(total_revenue) AS revenue,
    CAST(sum(total_transactions) AS BIGINT) AS transactions, avg(unique_customers) AS avg_customers
    FROM daily GROUP BY country ORDER BY revenue DESC, country LIMIT 5""", "country transactions", "revenue avg_customers")
on_daily("metric_rows", serving.metric_rows, """SELECT date, country, 'revenue_per_customer' AS metric_name,
    total_revenue / greatest(unique_customers, 1) AS metric_value FROM daily UNION ALL
    SELECT date, country, 'customer_acquisition_rate', unique_customers::DOUBLE / greatest(unique_invoices, 1) FROM daily""",
    "country metric_name", "metric_value", "date")
PROJECTED = """SELECT country, date AS ds, total_revenue AS y, total_transactions AS transactions, unique_customers AS customers,
    avg_transaction_value AS avg_order_value, day_of_week, week_of_year, month, year FROM daily"""
on_daily("project_series", lambda d: serving.project_series(d, "NATION_1", "1997-01-01"),
    PROJECTED + " WHERE country = 'NATION_1' AND date >= '1997-01-01'",
    "country transactions customers day_of_week week_of_year month year", "y avg_order_value", "ds")
on_daily("lookback_window", lambda d: serving.lookback_window(d, "NATION_1", "1998-06-30").select("date", "country", "total_revenue"),
    """SELECT date, country, total_revenue FROM daily WHERE country = 'NATION_1'
    AND date BETWEEN DATE '1998-06-30' - 90 AND DATE '1998-06-30'""", "country", "total_revenue", "date")
on_daily("distinct_values", lambda d: serving.distinct_values(d, "country"), "SELECT DISTINCT country FROM daily", "country")
on_daily("top_k", lambda d: serving.top_k(d.select("country", "date", "total_revenue"), "total_revenue", 20, "date"),
    "SELECT country, date, total_revenue FROM daily ORDER BY total_revenue DESC, date LIMIT 20", "country", "total_revenue", "date")
