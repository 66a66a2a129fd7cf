"""Exploration: profiles, geography, customers, products, trends, headline figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import cte, final, invoices, tidy
from revlake.functions import columns as C
from revlake.operators import customers, geography, kpis, products, profile, trends

QUERIES, ORACLES = {}, {}


def on(name, query, needs, body, plain="", dbl="", date="", digits=4, **extra):
    QUERIES[name] = lambda s, sf: tidy(query(invoices(s, sf)), digits)
    ORACLES[name] = final(cte(needs, body, **extra), plain, dbl, date, digits)


COLS = "invoice country customer_id stream_id price times_viewed year month day date".split()
on("null_profile", lambda d: profile.null_profile(d).drop("data_type"), "inv",
   " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS non_null, count(*) - count({c}) AS null_count,
   (count(*) - count({c}))::DOUBLE / count(*) * 100 AS null_percent FROM inv""" for c in COLS),
   '"column" non_null null_count', "null_percent")
on("duplicate_count", profile.duplicate_count, "inv",
   "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM inv)) AS duplicates FROM inv", "duplicates")
on("range_profile", lambda d: profile.range_profile(d, ["price", "times_viewed"]), "inv",
   " UNION ALL ".join(f"""SELECT '{c}' AS "column", min({c})::DOUBLE AS "min", max({c})::DOUBLE AS "max", count(*) FILTER ({c} = 0) AS zeros,
   count(*) FILTER ({c} = 0)::DOUBLE / count(*) * 100 AS zero_percent, count(*) FILTER ({c} < 0) AS negatives FROM inv""" for c in ("price", "times_viewed")),
   '"column" zeros negatives', '"min" "max" zero_percent')
on("describe_numeric", lambda d: profile.describe_numeric(d, ["price", "times_viewed", "year"]), "inv",
   " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(v) AS "count", avg(v) AS mean, stddev_samp(v) AS std, min(v) AS "min",
   quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75, max(v) AS "max"
   FROM (SELECT {c}::DOUBLE AS v FROM inv)""" for c in ("price", "times_viewed", "year")),
   '"column" "count"', 'mean std "min" q25 q50 q75 "max"')
on("moments", lambda d: profile.moments(d, "price"), "inv",
   """SELECT quantile_cont(price, 0.5) AS median, (SELECT price FROM inv GROUP BY price ORDER BY count(*) DESC, price LIMIT 1) AS mode,
   skewness(price) AS skewness, kurtosis(price) AS kurtosis FROM inv""", "", "median mode skewness kurtosis")
on("quantiles", lambda d: profile.quantiles(d, ["price", "times_viewed"]), "inv",
   " UNION ALL ".join(f"""SELECT '{c}' AS "column", quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50,
   quantile_cont({c}::DOUBLE, 0.75) AS q75, quantile_cont({c}::DOUBLE, 0.9) AS q90 FROM inv""" for c in ("price", "times_viewed")),
   '"column"', "q25 q50 q75 q90")
on("histogram", lambda d: profile.histogram(d, "price", 50), "inv",
   """SELECT b AS bin, lo + b * w AS lower, lo + (b + 1) * w AS upper, coalesce(n, 0) AS "count"
   FROM (SELECT unnest(range(50)) AS b), (SELECT min(price) AS lo, (max(price) - min(price)) / 50 AS w FROM inv)
   LEFT JOIN (SELECT least(floor((price - lo) / w), 49)::INTEGER AS bin, count(*) AS n FROM inv,
   (SELECT min(price) AS lo, (max(price) - min(price)) / 50 AS w FROM inv) GROUP BY 1) ON b = bin""",
   'bin "count"', "lower upper")
on("correlation", profile.correlation, "inv", "SELECT corr(price, times_viewed) AS correlation FROM inv", "", "correlation")
on("value_counts", lambda d: profile.value_counts(d, "country"), "inv", 'SELECT country, count(*) AS "count" FROM inv GROUP BY country', 'country "count"')
on("unique_values", lambda d: profile.unique_values(d, ["country", "month", "year"]).select("column", "unique_count", F.coalesce(F.array_join("values", ","), F.lit("-")).alias("values")), "inv",
   " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS unique_count, CASE WHEN count(DISTINCT {c}) <= 20
   THEN (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {c}::VARCHAR AS v FROM inv)) ELSE '-' END AS "values" FROM inv""" for c in ("country", "month", "year")),
   '"column" unique_count "values"')
on("boxplot_stats", lambda d: profile.boxplot_stats(d, "price", ["month"]), "inv",
   """SELECT month, max(a) AS q1, max(b) AS median, max(c) AS q3, min(price) FILTER (price BETWEEN a - 1.5::DOUBLE * (c - a) AND c + 1.5::DOUBLE * (c - a)) AS whisker_low,
   max(price) FILTER (price BETWEEN a - 1.5::DOUBLE * (c - a) AND c + 1.5::DOUBLE * (c - a)) AS whisker_high,
   count(*) FILTER (NOT price BETWEEN a - 1.5::DOUBLE * (c - a) AND c + 1.5::DOUBLE * (c - a)) AS outliers
   FROM inv JOIN (SELECT month, quantile_cont(price, 0.25) a, quantile_cont(price, 0.5) b, quantile_cont(price, 0.75) c FROM inv GROUP BY month) q USING (month) GROUP BY month""",
   "month outliers", "q1 median q3 whisker_low whisker_high")

MARKET = "total_revenue avg_price market_share revenue_per_customer revenue_per_transaction"
on("country_revenue", geography.country_revenue, "markets", "SELECT * FROM markets", "country transactions unique_customers total_views", MARKET)
on("concentration", lambda d: geography.concentration(geography.country_revenue(d)), "markets",
   """SELECT count(*) AS countries, sum(total_revenue) FILTER (p <= 3) / sum(total_revenue) * 100 AS top3_share,
   sum(total_revenue) FILTER (p <= 5) / sum(total_revenue) * 100 AS top5_share,
   1 - sum(total_revenue) FILTER (p <= 5) / sum(total_revenue) AS diversity_index
   FROM (SELECT *, row_number() OVER (ORDER BY total_revenue DESC, country) AS p FROM markets)""", "countries", "top3_share top5_share diversity_index")
on("with_others", lambda d: geography.with_others(geography.country_revenue(d)), "markets",
   """SELECT CASE WHEN p <= 10 THEN country ELSE 'Others' END AS market, sum(total_revenue) AS total_revenue
   FROM (SELECT *, row_number() OVER (ORDER BY total_revenue DESC, country) AS p FROM markets) GROUP BY 1""", "market", "total_revenue")
on("market_classes", lambda d: geography.market_classes(geography.country_revenue(d)), "markets",
   """SELECT country, revenue_per_customer >= a AS high_value, transactions > t AND revenue_per_customer < b AS volume_growth,
   revenue_per_customer > m AS above_mean_value, transactions > tm AS above_mean_volume, transactions > tm AND revenue_per_transaction < e AS growth_market
   FROM markets, (SELECT quantile_cont(revenue_per_customer, 0.75) a, quantile_cont(revenue_per_customer, 0.5) b, avg(revenue_per_customer) m,
   quantile_cont(transactions::DOUBLE, 0.5) t, avg(transactions) tm, quantile_cont(revenue_per_transaction, 0.5) e FROM markets)""",
   "country high_value volume_growth above_mean_value above_mean_volume growth_market")
on("coefficient_of_variation", lambda d: geography.coefficient_of_variation(d, "price"), "inv",
   "SELECT cv, CASE WHEN cv < 1 THEN 'Stable' ELSE 'Volatile' END AS stability FROM (SELECT stddev_samp(price) / avg(price) AS cv FROM inv)", "stability", "cv")
on("country_engagement", lambda d: geography.country_engagement(geography.country_revenue(d)), "markets",
   """SELECT country, round_even(total_views::DOUBLE / transactions * 100, 0) / 100 AS views_per_transaction FROM markets
   ORDER BY views_per_transaction DESC, country LIMIT 5""", "country", "views_per_transaction")

CV = customers.customer_value
on("customer_value", CV, "custs", "SELECT * FROM custs", "customer_id transactions total_views", "total_spent avg_price", "first_purchase last_purchase")
on("frequency_stats", lambda d: customers.frequency_stats(CV(d)), "custs",
   "SELECT avg(transactions) AS avg_frequency, max(transactions) AS max_frequency, quantile_cont(transactions::DOUBLE, 0.5) AS median_frequency FROM custs",
   "max_frequency", "avg_frequency median_frequency")
QUARTILES = """SELECT custs.*, CASE WHEN total_spent < 0 THEN NULL WHEN total_spent <= a THEN 'Low Value' WHEN total_spent <= b THEN 'Medium Value'
   WHEN total_spent <= c THEN 'High Value' ELSE 'Premium' END AS segment FROM custs,
   (SELECT quantile_cont(total_spent, 0.25) a, quantile_cont(total_spent, 0.5) b, quantile_cont(total_spent, 0.75) c FROM custs)"""
on("value_quartile_segment", lambda d: customers.value_quartile_segment(CV(d)).select("customer_id", "segment"), "custs", QUARTILES, "customer_id segment")
VALUE = """SELECT c.*, CASE WHEN total_spent >= a AND transactions >= f THEN 'VIP' WHEN total_spent >= a THEN 'High Value'
   WHEN transactions >= f THEN 'Loyal' ELSE 'Standard' END AS segment
   FROM (SELECT * REPLACE (round_even(round(total_spent, 6) * 100, 0) / 100 AS total_spent, round_even(round(avg_price, 6) * 100, 0) / 100 AS avg_price) FROM custs) c,
   (SELECT quantile_cont(round_even(round(total_spent, 6) * 100, 0) / 100, 0.8) a, quantile_cont(transactions::DOUBLE, 0.8) f FROM custs)"""
SEGMENTED = lambda d: customers.value_frequency_segment(customers.rounded_value(CV(d)))
on("value_frequency_segment", lambda d: SEGMENTED(d).select("customer_id", "segment"), "custs", VALUE, "customer_id segment")
on("segment_rollup", lambda d: customers.segment_rollup(SEGMENTED(d)), "custs",
   f"""SELECT segment, count(*) AS customers, round_even(round(sum(total_spent), 6) * 100, 0) / 100 AS total_revenue,
   round_even(round(avg(total_spent), 6) * 100, 0) / 100 AS avg_customer_value, round_even(round(avg(transactions), 6) * 100, 0) / 100 AS avg_frequency,
   round_even(round(avg(avg_price), 6) * 100, 0) / 100 AS avg_order_value, round_even(round(avg(total_views), 6) * 100, 0) / 100 AS avg_views,
   round_even(round_even(round(sum(total_spent), 6) * 100, 0) / 100 / (SELECT sum(total_spent) FROM ({VALUE})) * 100 * 10, 0) / 10 AS revenue_share
   FROM ({VALUE}) GROUP BY segment""", "segment customers", "total_revenue avg_customer_value avg_frequency avg_order_value avg_views revenue_share")
on("frequency_distribution", lambda d: customers.frequency_distribution(CV(d)), "custs", "SELECT transactions, count(*) AS customers FROM custs GROUP BY transactions", "transactions customers")
on("loyalty_counts", lambda d: customers.loyalty_counts(CV(d)), "custs",
   "SELECT count(*) AS customers, " + ", ".join(f"count(*) FILTER (transactions {t}) AS {n}_customers, count(*) FILTER (transactions {t})::DOUBLE / count(*) * 100 AS {n}_percent"
   for n, t in (("one_time", "= 1"), ("repeat", "> 1"), ("loyal", "> 5"))) + " FROM custs",
   "customers one_time_customers repeat_customers loyal_customers", "one_time_percent repeat_percent loyal_percent")
on("customer_lifecycle", lambda d: customers.customer_lifecycle(CV(d)), "custs",
   """SELECT avg(last_purchase - first_purchase) AS avg_days_active,
   avg((last_purchase - first_purchase)::DOUBLE / nullif(transactions - 1, 0)) AS avg_days_between_purchases FROM custs""", "", "avg_days_active avg_days_between_purchases")
on("customer_ranks", lambda d: customers.customer_ranks(CV(d)).select("customer_id", "revenue_rank", "frequency_rank"), "custs",
   "SELECT customer_id, dense_rank() OVER (ORDER BY total_spent DESC) AS revenue_rank, dense_rank() OVER (ORDER BY transactions DESC) AS frequency_rank FROM custs",
   "customer_id revenue_rank frequency_rank")
on("top_bottom_share", lambda d: customers.top_bottom_share(CV(d), "total_spent"), "custs",
   """SELECT n AS members, k AS top_members, t AS top_revenue, t / s * 100 AS top_share FROM (SELECT count(*) AS n, floor(count(*) * 0.2::DOUBLE)::BIGINT AS k,
   sum(total_spent) AS s FROM custs), (SELECT sum(total_spent) AS t FROM (SELECT total_spent, row_number() OVER (ORDER BY total_spent DESC) AS r,
   count(*) OVER () AS c FROM custs) WHERE r <= floor(c * 0.2::DOUBLE))""", "members top_members", "top_revenue top_share")
on("engagement_by_customer", lambda d: customers.engagement_by_customer(CV(d)), "custs",
   """SELECT max(m) AS avg_views, count(*) FILTER (total_views > m * 1.5::DOUBLE) AS busy_customers, count(*) FILTER (total_views > m * 1.5::DOUBLE)::DOUBLE / count(*) * 100 AS busy_percent,
   coalesce(sum(total_spent) FILTER (total_views > m * 1.5::DOUBLE), 0) / sum(total_spent) * 100 AS busy_revenue_share FROM custs, (SELECT avg(total_views) AS m FROM custs)""",
   "busy_customers", "avg_views busy_percent busy_revenue_share")
on("new_vs_returning", customers.new_vs_returning, "inv",
   """SELECT v.date, v.country, count(*) AS customers, count(*) FILTER (p IS NULL) AS new_customers, count(*) FILTER (p IS NOT NULL) AS returning_customers,
   coalesce(avg(v.date - p), -1) AS avg_recency_days, count(*) FILTER (p IS NOT NULL)::DOUBLE / count(*) AS customer_retention_rate,
   count(*) FILTER (p IS NULL)::DOUBLE / count(*) AS customer_acquisition_rate
   FROM v JOIN h ON v.customer_id = h.customer_id AND v.date = h.date GROUP BY v.date, v.country""",
   "country customers new_customers returning_customers", "avg_recency_days customer_retention_rate customer_acquisition_rate", "date",
   v="SELECT DISTINCT customer_id, date, country FROM inv WHERE customer_id IS NOT NULL",
   h="SELECT customer_id, date, lag(date) OVER (PARTITION BY customer_id ORDER BY date) AS p FROM (SELECT DISTINCT customer_id, date FROM v)")
NEW = QUERIES["new_vs_returning"]
QUERIES["new_vs_returning"] = lambda s, sf: NEW(s, sf).na.fill({"avg_recency_days": -1.0})
on("rfm_segments", lambda d: customers.rfm_segments(CV(d)).select("customer_id", "recency_days", "r", "f", "m", "segment"), "custs",
   """SELECT customer_id, recency_days, r, f, m, CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'champions' WHEN r <= 2 AND f >= 4 AND m >= 4 THEN 'cannot_lose'
   WHEN f >= 4 THEN 'loyal' WHEN r <= 2 AND f >= 3 THEN 'at_risk' WHEN r >= 4 AND f <= 1 THEN 'new' WHEN r >= 3 THEN 'potential_loyalists' ELSE 'hibernating' END AS segment FROM
   (SELECT customer_id, recency_days, 5 - len(list_filter(rq, lambda x: x < recency_days)) AS r, 1 + len(list_filter(fq, lambda x: x < transactions)) AS f,
   1 + len(list_filter(mq, lambda x: x < total_spent)) AS m FROM dd, qq)""", "customer_id recency_days r f m segment",
   dd="SELECT *, (SELECT max(last_purchase) FROM custs) - last_purchase AS recency_days FROM custs",
   qq="""SELECT quantile_cont(recency_days::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS rq, quantile_cont(transactions::DOUBLE, [0.2, 0.4, 0.6, 0.8]) AS fq,
   quantile_cont(total_spent, [0.2, 0.4, 0.6, 0.8]) AS mq FROM dd""")
on("view_bucket", lambda d: d.groupBy(C.view_bucket("times_viewed").alias("bucket")).agg(F.count(F.lit(1)).alias("n")), "inv",
   """SELECT CASE WHEN times_viewed < 0 THEN NULL WHEN times_viewed <= 1 THEN '1 view' WHEN times_viewed <= 5 THEN '2-5 views' WHEN times_viewed <= 10 THEN '6-10 views'
   WHEN times_viewed <= 20 THEN '11-20 views' ELSE '20+ views' END AS bucket, count(*) AS n FROM inv GROUP BY 1""", "bucket n")

on("stream_performance", products.stream_performance, "streams", "SELECT * REPLACE (coalesce(price_std, -1) AS price_std, coalesce(revenue_per_customer, -1) AS revenue_per_customer) FROM streams",
   "stream_id transactions total_views unique_customers", "total_revenue avg_price price_std avg_views revenue_per_customer views_per_transaction")
STREAMS = QUERIES["stream_performance"]
QUERIES["stream_performance"] = lambda s, sf: STREAMS(s, sf).na.fill({"price_std": -1.0, "revenue_per_customer": -1.0})
CATEGORY = """CASE WHEN upper(stream_id) IN ('DOT', 'POST') THEN 'Special' WHEN regexp_matches(stream_id, '[A-Z]') THEN 'Alphanumeric'
   WHEN regexp_matches(stream_id, '^[0-9]+$') THEN 'Numeric' ELSE 'Other' END"""
on("stream_category_performance", products.stream_category_performance, "inv",
   f"""SELECT {CATEGORY} AS stream_category, round_even(round(sum(price), 6) * 100, 0) / 100 AS total_revenue, round_even(round(avg(price), 6) * 100, 0) / 100 AS avg_price,
   count(price) AS transactions, CAST(sum(times_viewed) AS BIGINT) AS total_views FROM inv GROUP BY 1""", "stream_category transactions total_views", "total_revenue avg_price")
on("premium_streams", lambda d: products.premium_streams(products.stream_performance(d)), "streams",
   """SELECT count(*) AS premium_streams, avg(avg_price) AS avg_price, sum(total_revenue) AS total_revenue FROM streams
   WHERE avg_price > (SELECT quantile_cont(avg_price, 0.8) FROM streams)""", "premium_streams", "avg_price total_revenue")
on("product_portfolio", lambda d: products.product_portfolio(products.product_revenue(d)), "inv",
   """SELECT count(*) AS products, avg(r) AS avg_revenue_per_product, sum(r) FILTER (p <= floor(c * 0.2::DOUBLE)) / sum(r) * 100 AS top_fifth_share
   FROM (SELECT r, row_number() OVER (ORDER BY r DESC) AS p, count(*) OVER () AS c FROM (SELECT sum(price) AS r FROM inv GROUP BY stream_id))""",
   "products", "avg_revenue_per_product top_fifth_share")
CURVE = """SELECT stream_id, total_revenue, row_number() OVER o AS position, sum(total_revenue) OVER o AS cumulative,
   sum(total_revenue) OVER o / sum(total_revenue) OVER () * 100 AS cumulative_percent FROM streams
   WINDOW o AS (ORDER BY total_revenue DESC, stream_id ROWS UNBOUNDED PRECEDING)"""
PARETO = lambda d: products.pareto(products.stream_performance(d), "stream_id", "total_revenue")
on("pareto", lambda d: PARETO(d).drop("total"), "streams", CURVE, "stream_id position", "total_revenue cumulative cumulative_percent")
on("pareto_summary", lambda d: products.pareto_summary(PARETO(d), "total_revenue"), "streams",
   f"""SELECT count(*) AS members, count(*) FILTER (cumulative_percent <= 80) AS members_for_80, count(*) FILTER (cumulative_percent <= 80)::DOUBLE / count(*) * 100 AS members_for_80_percent,
   sum(total_revenue) FILTER (position <= 10) / sum(total_revenue) * 100 AS top10_share, sum(total_revenue) FILTER (position <= 50) / sum(total_revenue) * 100 AS top50_share FROM ({CURVE})""",
   "members members_for_80", "members_for_80_percent top10_share top50_share")

R2 = "round_even(round(sum(price), 6) * 100, 0) / 100 AS total_revenue, round_even(round(avg(price), 6) * 100, 0) / 100 AS avg_price, count(price) AS transactions"
DAYS = f"SELECT date, {R2}, CAST(sum(times_viewed) AS BIGINT) AS total_views FROM inv GROUP BY date"
MONTHS = f"SELECT month(date) AS month, strftime(date, '%b') AS month_name, {R2}, round_even(round(avg(times_viewed), 6) * 100, 0) / 100 AS avg_views FROM inv GROUP BY 1, 2"
DOWS = f"SELECT isodow(date) - 1 AS day_of_week, dayname(date) AS day_of_week_name, {R2}, round_even(round(avg(times_viewed), 6) * 100, 0) / 100 AS avg_views FROM inv GROUP BY 1, 2"
on("daily_trend", trends.daily_trend, "inv", DAYS, "transactions total_views", "total_revenue avg_price", "date")
on("daily_trend_summary", lambda d: trends.daily_trend_summary(trends.daily_trend(d)), "inv",
   f"""SELECT avg(total_revenue) AS avg_daily_revenue, avg(transactions) AS avg_daily_transactions, max(total_revenue) AS peak_daily_revenue,
   max(transactions) AS peak_daily_transactions, max(date) - min(date) AS period_days FROM ({DAYS})""", "peak_daily_transactions period_days", "avg_daily_revenue avg_daily_transactions peak_daily_revenue")
on("monthly_trend", trends.monthly_trend, "inv", MONTHS, "month month_name transactions", "total_revenue avg_price avg_views")
on("dow_trend", trends.dow_trend, "inv", DOWS, "day_of_week day_of_week_name transactions", "total_revenue avg_price avg_views")
on("weekend_share", trends.weekend_share, "inv", "SELECT sum(price) FILTER (isodow(date) >= 6) / sum(price) * 100 AS weekend_share FROM inv", "", "weekend_share")
on("best_worst_period", lambda d: trends.best_worst_period(trends.monthly_trend(d), trends.dow_trend(d)), "inv",
   " UNION ALL ".join(f"""SELECT '{p}' AS period, (SELECT {p}_name FROM ({q}) ORDER BY total_revenue DESC, {p} LIMIT 1) AS best, max(total_revenue) AS best_revenue,
   (SELECT {p}_name FROM ({q}) ORDER BY total_revenue, {p} LIMIT 1) AS worst, min(total_revenue) AS worst_revenue FROM ({q})""" for p, q in (("month", MONTHS), ("day_of_week", DOWS))),
   "period best worst", "best_revenue worst_revenue")
GROWTH = f"SELECT month, total_revenue, (total_revenue - p) / nullif(p, 0) * 100 AS growth FROM (SELECT *, lag(total_revenue) OVER (ORDER BY month) AS p FROM ({MONTHS}))"
on("month_over_month", lambda d: trends.month_over_month(trends.monthly_trend(d)), "inv",
   f"""SELECT avg(growth) AS avg_growth, (SELECT growth FROM ({GROWTH}) WHERE growth IS NOT NULL ORDER BY abs(growth) DESC, month LIMIT 1) AS most_volatile,
   (arg_max(total_revenue, month) - arg_min(total_revenue, month)) / arg_min(total_revenue, month) * 100 AS first_to_last_growth FROM ({GROWTH})""", "", "avg_growth most_volatile first_to_last_growth")
on("month_growth", lambda d: trends.month_growth(trends.monthly_trend(d)).na.fill({"growth": 0.0}), "inv", f"SELECT month, total_revenue, coalesce(growth, 0) AS growth FROM ({GROWTH})", "month", "total_revenue growth")
on("kpi_summary", kpis.kpi_summary, "custs",
   """SELECT total_revenue, total_transactions, unique_customers, unique_products, countries, total_views, total_revenue / total_transactions AS avg_transaction_value,
   total_revenue / unique_customers AS revenue_per_customer, repeat_customers, repeat_customers::DOUBLE / unique_customers * 100 AS retention_rate, avg_transactions_per_customer,
   high_value_customers, total_revenue / total_views AS revenue_per_view, total_views::DOUBLE / total_transactions AS views_per_transaction,
   total_transactions::DOUBLE / total_views * 100 AS conversion_rate
   FROM (SELECT sum(price) AS total_revenue, count(*) AS total_transactions, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT stream_id) AS unique_products,
   count(DISTINCT country) AS countries, CAST(sum(times_viewed) AS BIGINT) AS total_views FROM inv),
   (SELECT count(*) FILTER (transactions > 1) AS repeat_customers, avg(transactions) AS avg_transactions_per_customer,
   count(*) FILTER (total_spent > (SELECT quantile_cont(total_spent, 0.8) FROM custs)) AS high_value_customers FROM custs)""",
   "total_transactions unique_customers unique_products countries total_views repeat_customers high_value_customers",
   "total_revenue avg_transaction_value revenue_per_customer retention_rate avg_transactions_per_customer revenue_per_view views_per_transaction conversion_rate")
INPUTS = """SELECT (SELECT sum(price) FROM inv) AS total_revenue, (SELECT avg(price) FROM inv) AS avg_transaction_value,
   (SELECT stddev_samp(price) / avg(price) FROM inv) AS price_cv,
   (SELECT count(*) FILTER (times_viewed > 2 * m)::DOUBLE / count(*) * 100 FROM inv, (SELECT avg(times_viewed) AS m FROM inv)) AS high_engagement_share,
   (SELECT count(*) FILTER (transactions = 1)::DOUBLE / count(*) * 100 FROM custs) AS one_time_share,
   (SELECT count(*) FILTER (transactions > 1)::DOUBLE / count(*) * 100 FROM custs) AS retention_rate,
   (SELECT count(DISTINCT country) FROM inv) AS countries,
   (SELECT sum(v) FILTER (p <= floor(c * 0.2::DOUBLE)) FROM (SELECT total_spent AS v, row_number() OVER (ORDER BY total_spent DESC) AS p, count(*) OVER () AS c FROM custs))
     / (SELECT sum(price) FROM inv) * 100 AS customer_concentration,
   (SELECT sum(v) FILTER (p <= floor(c * 0.2::DOUBLE)) FROM (SELECT v, row_number() OVER (ORDER BY v DESC) AS p, count(*) OVER () AS c
     FROM (SELECT sum(price) AS v FROM inv GROUP BY stream_id))) / (SELECT sum(price) FROM inv) * 100 AS product_concentration,
   (SELECT sum(v) FROM (SELECT sum(price) AS v FROM inv GROUP BY country ORDER BY v DESC LIMIT 3)) / (SELECT sum(price) FROM inv) * 100 AS geographic_concentration"""
INPUT_COLUMNS = "total_revenue avg_transaction_value price_cv high_engagement_share one_time_share retention_rate customer_concentration product_concentration geographic_concentration"
on("advice_inputs", kpis.advice_inputs, "custs", INPUTS, "countries", INPUT_COLUMNS)
RULES = [
    ("opportunity", "Customer Retention Opportunity", "one_time_share", "> 50"), ("opportunity", "Portfolio Diversification", "product_concentration", "> 80"),
    ("opportunity", "Portfolio Optimization", "product_concentration", "< 50"), ("opportunity", "Geographic Expansion", "countries", "< 5"),
    ("opportunity", "Price Strategy", "price_cv", "> 1"), ("opportunity", "Engagement Optimization", "high_engagement_share", "< 20"),
    ("immediate", "Customer Retention Program", "retention_rate", "< 50"), ("immediate", "Revenue Per Transaction Optimization", "avg_transaction_value", "< 10"),
    ("immediate", "Portfolio Review", "product_concentration", "> 30"), ("short_term", "Retention Focus", "retention_rate", "< 30"),
    ("short_term", "Acquisition Focus", "retention_rate", "> 70"), ("short_term", "Balanced Approach", "retention_rate", "BETWEEN 30 AND 70"),
    ("short_term", "Geographic Expansion", "countries", "< 10"), ("long_term", "Growth Focus", "total_revenue", "< 500000"),
    ("long_term", "Market Leadership", "total_revenue", "BETWEEN 500000 AND 999999.999"), ("long_term", "Innovation Focus", "total_revenue", ">= 1000000"),
    ("risk", "Customer Concentration Risk", "customer_concentration", "> 70"), ("risk", "Geographic Risk", "geographic_concentration", "> 80"),
    ("risk", "Product Risk", "product_concentration", "> 80"),
]
on("business_advice", lambda d: kpis.business_advice(kpis.advice_inputs(d)), "custs",
   " UNION ALL ".join(f"SELECT '{a}' AS area, '{t}' AS topic, '{f}' AS figure, {f}::DOUBLE AS value FROM i WHERE {f} {c}" for a, t, f, c in RULES),
   "area topic figure", "value", i=INPUTS)
# Scalar functions over whole columns.
on("strip_non_digits", lambda d: d.groupBy(C.strip_non_digits("stream_id").alias("digits")).agg(F.count(F.lit(1)).alias("n")), "inv",
   "SELECT regexp_replace(stream_id, '[^0-9]+', '', 'g') AS digits, count(*) AS n FROM inv GROUP BY 1", "digits n")
on("stream_category", lambda d: d.select("stream_id", C.stream_category("stream_id").alias("category")).distinct(), "inv", f"SELECT DISTINCT stream_id, {CATEGORY} AS category FROM inv", "stream_id category")
on("slug_country", lambda d: d.select(C.slug_country(F.concat("country", F.lit("  Of  Test"))).alias("slug")).distinct(), "inv",
   "SELECT DISTINCT lower(country) || '_of_test' AS slug FROM inv", "slug")
on("zero_pad_date", lambda d: d.select(C.date_text("year", "month", "day").alias("text"), C.year_month("date").alias("year_month")).distinct(), "inv",
   "SELECT DISTINCT strftime(date, '%Y-%m-%d') AS text, strftime(date, '%Y-%m') AS year_month FROM inv", "text year_month")
on("calendar_parts", lambda d: d.select("date", *[c.alias(n) for n, c in C.calendar_parts("date").items()]).distinct(), "inv",
   """SELECT DISTINCT date, year(date) AS year, month(date) AS month, day(date) AS day, isodow(date) - 1 AS day_of_week, week(date) AS week_of_year, 0 AS hour FROM inv""",
   "year month day day_of_week week_of_year hour", "", "date")
on("seasonal_flags", lambda d: d.select("date", *[c.alias(n) for n, c in C.seasonal_flags("date").items()]).distinct(), "inv",
   """SELECT DISTINCT date, (isodow(date) >= 6)::INTEGER AS is_weekend, (day(date) <= 3)::INTEGER AS is_month_start, (day(date) >= 28)::INTEGER AS is_month_end FROM inv""",
   "is_weekend is_month_start is_month_end", "", "date")
on("month_and_day_names", lambda d: d.select("date", C.month_name("date").alias("month_name"), C.day_name("date").alias("day_name")).distinct(), "inv",
   "SELECT DISTINCT date, strftime(date, '%b') AS month_name, dayname(date) AS day_name FROM inv", "month_name day_name", "", "date")
on("round_even", lambda d: d.select("invoice", "stream_id", C.round_even("price").alias("rounded")), "inv",
   "SELECT invoice, stream_id, round_even(price * 100, 0) / 100 AS rounded FROM inv", "invoice stream_id", "rounded")
on("two_decimals", lambda d: d.groupBy("country").agg(C.two_decimals(F.sum("price")).alias("text")), "inv",
   "SELECT country, printf('%.2f', sum(price)) AS text FROM inv GROUP BY country", "country text")
on("safe_ratio", lambda d: d.select("invoice", "stream_id", C.safe_ratio("price", F.col("times_viewed") % 3).alias("ratio")), "inv",
   "SELECT invoice, stream_id, CASE WHEN times_viewed % 3 > 0 THEN price / (times_viewed % 3) ELSE 0 END AS ratio FROM inv", "invoice stream_id", "ratio")
