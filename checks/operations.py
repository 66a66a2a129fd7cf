"""Logs, monitoring, drift, recommendations, clusters and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import EDGE, api_logs, cte, final, grid, history, invoices, requests, series, table, tidy
from revlake.functions.columns import parse_details
from revlake.operators import clustering, logs, monitoring
from revlake.schemas import API_LOGS
from revlake.session import fresh_path
from revlake.streaming import activity

QUERIES, ORACLES = {}, {}


def on(name, source, query, needs, body, plain="", dbl="", date="", digits=4, **extra):
    QUERIES[name] = lambda s, sf: tidy(query(source(s, sf)), digits)
    if body:
        ORACLES[name] = final(cte(needs, body, **extra), plain, dbl, date, digits)


TS = "SELECT * REPLACE (epoch_us(timestamp) AS timestamp) FROM "
LOG = "timestamp level category message details country model_type event_id"
on("filter_logs", api_logs, lambda d: logs.filter_logs(d, "2024-01-05", "2024-01-12", level="INFO", country="C2"), "logs",
   TS + "logs WHERE timestamp >= '2024-01-05' AND timestamp < '2024-01-13' AND level = 'INFO' AND country = 'C2'", LOG)
on("paginate_logs", api_logs, lambda d: logs.paginate_logs(logs.filter_logs(d, level="ERROR"), 50, 25, "event_id"), "logs",
   TS + """(SELECT *, count(*) OVER () AS total_count, count(*) OVER () > 75 AS has_more FROM logs WHERE level = 'ERROR' ORDER BY timestamp DESC, event_id LIMIT 50 OFFSET 25)""", LOG + " total_count has_more")
on("retention_keep", api_logs, lambda d: logs.retention_delete(d, "2024-01-31", 20)[0], "logs", TS + "logs WHERE timestamp >= TIMESTAMP '2024-01-31' - INTERVAL 20 DAY", LOG)
on("retention_delete", api_logs, lambda d: logs.retention_delete(d, "2024-01-31", 20)[1], "logs", "SELECT count(*) FILTER (timestamp < TIMESTAMP '2024-01-31' - INTERVAL 20 DAY) AS deleted FROM logs", "deleted")
def retained(spark, sf, what):
    """The log table on disk after its old rows were deleted, and how many were."""
    path = fresh_path(spark, "logs")
    rows = api_logs(spark, sf)
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in API_LOGS.fields if f.name not in rows.columns]
    logs.append_log(rows.select("*", *absent), path)
    deleted = logs.delete_old_logs(spark, path, "2024-01-31 06:00:00", 20)
    return tidy(spark.read.parquet(path).select("timestamp", "level", "category", "country")) if what == "rows" else deleted


QUERIES["delete_old_logs"] = lambda s, sf: retained(s, sf, "rows")
ORACLES["delete_old_logs"] = cte("logs", """SELECT epoch_us(timestamp) AS timestamp, level, category, country FROM logs
   WHERE timestamp >= TIMESTAMP '2024-01-31 06:00:00' - INTERVAL 20 DAY""")
QUERIES["delete_old_logs_count"] = lambda s, sf: retained(s, sf, "count")
ORACLES["delete_old_logs_count"] = cte("logs", "SELECT count(*) FILTER (timestamp < TIMESTAMP '2024-01-31 06:00:00' - INTERVAL 20 DAY) AS deleted FROM logs")
SINCE = "(SELECT * FROM logs WHERE timestamp::DATE >= (SELECT max(timestamp)::DATE - 7 FROM logs))"
on("log_summary", api_logs, logs.log_summary, "logs", f'SELECT level, category, country, model_type, count(*) AS "count" FROM {SINCE} GROUP BY ALL', 'level category country model_type "count"')
on("top_errors", api_logs, logs.top_errors, "logs", f"""SELECT message, count(*) AS "count" FROM {SINCE} WHERE level IN ('ERROR', 'CRITICAL') GROUP BY message ORDER BY count(*) DESC, message LIMIT 10""", 'message "count"')
on("daily_activity", api_logs, logs.daily_activity, "logs", f"SELECT timestamp::DATE AS date, count(*) AS total_logs, count(*) FILTER (level = 'ERROR') AS error_logs FROM {SINCE} GROUP BY 1", "total_logs error_logs", "", "date")
on("endpoint_metrics", requests, logs.endpoint_metrics, "reqs",
   """SELECT endpoint, count(*) AS requests, avg(response_time_ms) AS avg_response_ms, min(response_time_ms) AS min_response_ms, max(response_time_ms) AS max_response_ms,
   avg(CASE WHEN status_code >= 400 THEN 100.0::DOUBLE ELSE 0 END) AS error_rate, quantile_cont(response_time_ms, 0.5) AS p50_response_ms, quantile_cont(response_time_ms, 0.95) AS p95_response_ms FROM reqs GROUP BY endpoint""",
   "endpoint requests", "avg_response_ms min_response_ms max_response_ms error_rate p50_response_ms p95_response_ms")
on("overall_metrics", requests, logs.overall_metrics, "reqs",
   """SELECT count(*) AS total_requests, avg(response_time_ms) AS avg_response_ms, avg(CASE WHEN status_code >= 400 THEN 100.0::DOUBLE ELSE 0 END) AS error_rate, count(DISTINCT timestamp::DATE) AS active_days FROM reqs""",
   "total_requests active_days", "avg_response_ms error_rate")
on("request_metrics", requests, logs.request_metrics, "reqs",
   """SELECT epoch_us(timestamp) AS timestamp, endpoint, method, response_time_ms, status_code, 'C' || (user_id % 5) AS country, CASE WHEN user_id % 2 = 0 THEN 'prophet' ELSE 'arima' END AS model_type FROM reqs""",
   "timestamp endpoint method status_code country model_type", "response_time_ms")
on("parse_details", api_logs, lambda d: d.select("event_id", F.coalesce(F.try_element_at(parse_details(F.when(F.col("event_id") % 3 != 0, F.col("details")).otherwise("{bad")), F.lit("k")), F.lit("-")).alias("k")), "logs",
   "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN json_extract_string(details, '$.k') ELSE '-' END AS k FROM logs", "event_id k")
on("last_n_per_key", api_logs, lambda d: logs.last_n_per_key(d, 5, ["category", "country"], ["timestamp", "event_id"]), "logs",
   TS + "logs QUALIFY row_number() OVER (PARTITION BY category, country ORDER BY logs.timestamp DESC, event_id DESC) <= 5", LOG)

H = "country model_type"
on("capped_history", history, lambda d: monitoring.capped_history(d, 20), "history",
   TS + "history QUALIFY row_number() OVER (PARTITION BY country, model_type ORDER BY history.timestamp DESC) <= 20", H + " timestamp", "r2 mae rmse mape mase")
SPLIT = """SELECT country, model_type, count(*) AS records, count(*) FILTER (p <= 5) AS na, count(*) FILTER (p > 5) AS nb, avg(r2) FILTER (p <= 5) AS recent_r2, avg(r2) FILTER (p > 5) AS earlier_r2,
   coalesce(var_samp(r2) FILTER (p <= 5), 0) AS va, coalesce(var_samp(r2) FILTER (p > 5), 0) AS vb, max(timestamp) AS timestamp
   FROM (SELECT *, row_number() OVER (PARTITION BY country, model_type ORDER BY timestamp DESC) AS p FROM history) WHERE p <= 100 GROUP BY country, model_type"""
CRITICAL = "[" + ", ".join(f"{monitoring.t_critical(d)!r}::DOUBLE" for d in range(1, 99)) + "]"
TESTS = f"""SELECT country, model_type, timestamp, records, recent_r2, earlier_r2, t AS t_statistic, c AS critical, coalesce(t < -2 AND abs(t) > c, false) AS has_drift, CASE WHEN t < -2 AND abs(t) > c THEN abs(t) / 10 END AS drift_score
   FROM (SELECT *, (recent_r2 - earlier_r2) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1.0::DOUBLE / na + 1.0::DOUBLE / nb)) AS t, {CRITICAL}[na + nb - 2] AS c FROM ({SPLIT}) WHERE records > 5)"""
# Shifting one key's newest values down makes the test fire.
SHIFTED = lambda s, sf: history(s, sf).withColumn("r2", F.when((F.col("country") == "click") & (F.col("timestamp") >= "2024-01-26"), F.col("r2") - 0.3).otherwise(F.col("r2")))
SHIFT = "SELECT * REPLACE (CASE WHEN country = 'click' AND timestamp >= '2024-01-26' THEN r2 - 0.3::DOUBLE ELSE r2 END AS r2) FROM history"


def shifted(body):
    return body.replace("FROM history", "FROM shifted")


on("performance_drift_test", SHIFTED, lambda d: monitoring.performance_drift_test(d).na.fill({"drift_score": -1.0}), "history",
   "SELECT * REPLACE (epoch_us(timestamp) AS timestamp, coalesce(drift_score, -1) AS drift_score) FROM (" + shifted(TESTS) + ")", H + " timestamp records has_drift", "recent_r2 earlier_r2 t_statistic critical drift_score", shifted=SHIFT)
on("drift_alerts", SHIFTED, lambda d: monitoring.drift_alerts(monitoring.performance_drift_test(d)).withColumn("affected_features", F.array_join("affected_features", ",")), "history",
   "SELECT country, model_type, epoch_us(timestamp) AS timestamp, 'performance' AS drift_type, drift_score, model_type AS affected_features, 'Model ' || model_type || ' for ' || country || ' showing performance degradation. Consider retraining.' AS recommendation FROM ("
   + shifted(TESTS) + ") WHERE has_drift", H + " timestamp drift_type affected_features recommendation", "drift_score", shifted=SHIFT)
SCORES = f"SELECT country, model_type, greatest(0, (earlier_r2 - recent_r2) / earlier_r2) AS drift_score, greatest(0, (earlier_r2 - recent_r2) / earlier_r2) > 0.3 AS high_drift FROM ({SPLIT}) WHERE records > 10"
on("performance_drift_scores", SHIFTED, monitoring.performance_drift_scores, "history", shifted(SCORES), H + " high_drift", "drift_score", shifted=SHIFT)
on("performance_drift_score", SHIFTED, monitoring.performance_drift_score, "history", f"SELECT avg(drift_score) AS overall_score, count(*) FILTER (high_drift) AS high_drift_models FROM ({shifted(SCORES)})", "high_drift_models", "overall_score", shifted=SHIFT)
PER = "SELECT country, model_type, avg(r2) AS m, count(*) AS n, stddev_pop(r2) AS s, max(timestamp) AS t FROM history GROUP BY ALL"
on("performance_summary", history, monitoring.performance_summary, "history",
   f"SELECT (SELECT avg(r2) FROM history) AS average_accuracy, arg_max(country || '_' || model_type, m) AS best_model, arg_min(country || '_' || model_type, m) AS worst_model, epoch_us(max(t)) AS last_training FROM ({PER})",
   "best_model worst_model last_training", "average_accuracy")
on("latest_performance", history, monitoring.latest_performance, "history", TS + "history QUALIFY row_number() OVER (PARTITION BY country, model_type ORDER BY history.timestamp DESC) = 1", H + " timestamp", "r2 mae rmse mape mase")
on("accuracy_trends", history, lambda d: monitoring.accuracy_trends(d).select("country", "model_type", F.posexplode("r2_trend").alias("place", "r2")), "history",
   "SELECT country, model_type, row_number() OVER (PARTITION BY country, model_type ORDER BY timestamp) - 1 AS place, r2 FROM (SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY country, model_type ORDER BY timestamp DESC) <= 20)", H + " place", "r2")
on("performance_stability", history, monitoring.performance_stability, "history",
   f"SELECT st AS stability, CASE WHEN st > 0.8 THEN 'high' WHEN st > 0.6 THEN 'medium' ELSE 'low' END AS level FROM (SELECT avg(CASE WHEN m > 0 THEN 1 - s / m ELSE 0 END) AS st FROM ({PER}) WHERE n > 5)", "level", "stability")
on("append_performance_records", history, lambda d: monitoring.append_performance_records(d.drop("mase").withColumn("mape", F.when(F.col("mape") < 5, None).otherwise(F.col("mape"))), "2024-02-01"), "history",
   "SELECT country, model_type, mae, CASE WHEN mape < 5 THEN 0 ELSE mape END AS mape, rmse, 0.0::DOUBLE AS mase, r2, epoch_us(TIMESTAMP '2024-02-01') AS timestamp FROM history", H + " timestamp", "mae mape rmse mase r2")
on("append_prediction_records", history, lambda d: monitoring.append_prediction_records(
    d.select("country", "model_type", F.when(F.col("mae") > 55, F.col("mae") / 100).alias("prediction_time"), F.col("r2").alias("confidence")), "2024-02-01"), "history",
   "SELECT country, model_type, CASE WHEN mae > 55 THEN mae / 100 ELSE 0 END AS prediction_time, r2 AS confidence_score, epoch_us(TIMESTAMP '2024-02-01') AS timestamp FROM history",
   H + " timestamp", "prediction_time confidence_score")
on("retrain_candidates", SHIFTED, lambda d: monitoring.retrain_candidates(d.select("country", "model_type").distinct(), monitoring.performance_drift_test(d)), "history",
   f"SELECT country, model_type FROM ({shifted(TESTS)}) WHERE has_drift", H, shifted=SHIFT)
ALERTS = lambda d: d.where("r2 < 0.8").select("country", "model_type", "timestamp", F.col("r2").alias("drift_score"))
on("recent_alerts", history, lambda d: monitoring.recent_alerts(ALERTS(d)), "history",
   "SELECT country, model_type, epoch_us(timestamp) AS timestamp, r2 AS drift_score, timestamp > (SELECT max(timestamp) FROM history WHERE r2 < 0.8) - INTERVAL 1 DAY AS last_day FROM history WHERE r2 < 0.8 ORDER BY history.timestamp DESC, country, model_type LIMIT 10",
   H + " timestamp last_day", "drift_score")
METRICS = lambda d: monitoring.latest_performance(d).withColumn("mae", F.col("mae") * 10).withColumn("r2", F.col("r2") - 0.1)


def advice(d):
    metrics = METRICS(d)
    ranked = metrics.withColumn("rank", F.lit(1))
    weak = metrics.select("country", F.when(F.col("mae") > 500, "weak").otherwise("strong").alias("strength"))
    alerts = monitoring.drift_alerts(monitoring.performance_drift_test(d))
    return monitoring.recommendations(metrics, alerts, ranked, weak)


on("recommendations", SHIFTED, advice, "history",
   """SELECT country, 'model_performance' AS type, 'high' AS priority, model_type AS model, 'High prediction error' AS issue, printf('MAE: %.2f, RMSE: %.2f', mae, rmse) AS details,
     'Consider retraining ' || model_type || ' model for ' || country || ' or adjusting hyperparameters' AS recommendation FROM m WHERE mae > 500
   UNION ALL SELECT country, 'model_performance', 'medium', model_type, 'Low model fit', printf('R2: %.3f', r2), 'Consider adding more features or using a different model architecture for ' || country FROM m WHERE r2 < 0.7
   UNION ALL SELECT country, 'model_drift', 'medium', model_type, 'Performance drift detected', printf('score: %.3f', drift_score), 'Retrain ' || model_type || ' model for ' || country || ' with recent data' FROM tt WHERE has_drift
   UNION ALL SELECT country, 'model_selection', 'low', 'all', 'Model selection optimization', printf('%s: %.3f', model_type, mae), 'Consider using ' || model_type || ' as primary model for ' || country FROM m
   UNION ALL SELECT country, 'business_impact', 'medium', 'all', 'Weak correlation with business metrics', 'weak', 'Investigate model features and business KPI alignment for ' || country FROM m WHERE mae > 500""",
   "country type priority model issue details recommendation", shifted=SHIFT, tt=shifted(TESTS),
   m="SELECT country, model_type, mae * 10 AS mae, rmse, r2 - 0.1::DOUBLE AS r2 FROM shifted QUALIFY row_number() OVER (PARTITION BY country, model_type ORDER BY timestamp DESC) = 1")
on("sort_by_priority", invoices, lambda d: monitoring.sort_by_priority(
    d.groupBy("country").agg(F.count(F.lit(1)).alias("n")).select("country", F.when(F.col("n") % 3 == 0, "high").when(F.col("n") % 3 == 1, "medium").otherwise("low").alias("priority"), F.lit("m").alias("model"), F.lit("i").alias("issue"))), "inv",
   "SELECT country, CASE count(*) % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS priority, 'm' AS model, 'i' AS issue FROM inv GROUP BY country", "country priority model issue")


def halves(d):
    return d.where("date < '1998-01-01'"), d.where("date >= '1998-01-01'")


def psi_sql(c):
    bins = " + ".join(f"({c} > cut[{i}])::INTEGER" for i in range(1, 10))
    share = f"(SELECT bin, count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM (SELECT {bins} AS bin FROM inv, cuts_{c} WHERE date {{op}} '1998-01-01') GROUP BY bin)"
    return f"""SELECT '{c}' AS feature, sum((q - p) * ln(q / p)) AS psi, sum((q - p) * ln(q / p)) > 0.2 AS has_drift FROM
        (SELECT greatest(coalesce(x.p, 0), 1e-4) AS p, greatest(coalesce(z.p, 0), 1e-4) AS q FROM {share.format(op='<')} x FULL JOIN {share.format(op='>=')} z ON x.bin = z.bin)"""


CUTS = {f"cuts_{c}": f"SELECT quantile_cont({c}::DOUBLE, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cut FROM inv WHERE date < '1998-01-01'" for c in ("price", "times_viewed")}
PSI = psi_sql("price") + " UNION ALL " + psi_sql("times_viewed")
DRIFT = lambda d: monitoring.data_drift(*halves(d), ["price", "times_viewed"])
on("data_drift", invoices, DRIFT, "inv", PSI, "feature has_drift", "psi", **CUTS)
on("data_drift_score", invoices, lambda d: monitoring.data_drift_score(DRIFT(d)), "inv", f"SELECT least(1.0::DOUBLE, avg(psi)) AS overall_score FROM ({PSI})", "", "overall_score", **CUTS)


def concept(d):
    return monitoring.concept_drift(d.where("ds < '1998-01-01'"), d.where("ds >= '1998-01-01'"))


CONCEPT = {
    **{f"l{t}": f"SELECT series, regr_slope(y, ds - DATE '1970-01-01') / avg(y) AS g FROM series WHERE ds {op} '1998-01-01' GROUP BY series" for t, op in (("a", "<"), ("b", ">="))},
    **{f"d{t}": f"SELECT series, dow, m / sum(m) OVER (PARTITION BY series) AS s FROM (SELECT series, isodow(ds) AS dow, avg(y) AS m FROM series WHERE ds {op} '1998-01-01' GROUP BY ALL)" for t, op in (("a", "<"), ("b", ">="))},
    "pat": "SELECT coalesce(da.series, db.series) AS series, avg(abs(coalesce(da.s, 0) - coalesce(db.s, 0))) AS p FROM da FULL JOIN db ON da.series = db.series AND da.dow = db.dow GROUP BY 1",
    "con": "SELECT la.series, la.g AS growth_baseline, lb.g AS growth_recent, p AS pattern_change, lb.g - la.g AS growth_change FROM la JOIN lb ON la.series = lb.series JOIN pat ON la.series = pat.series",
}
on("concept_drift", series, concept, "series", "SELECT * FROM con", "series", "growth_baseline growth_recent pattern_change growth_change", "", 6, **CONCEPT)
on("concept_drift_score", series, lambda d: monitoring.concept_drift_score(concept(d)), "series", "SELECT least(1.0::DOUBLE, avg(pattern_change) * 7) AS overall_score FROM con", "", "overall_score", **CONCEPT)


def overall(s, sf):
    return monitoring.drift_recommendations(monitoring.overall_drift(
        monitoring.data_drift_score(DRIFT(invoices(s, sf))), monitoring.concept_drift_score(concept(series(s, sf))), monitoring.performance_drift_score(SHIFTED(s, sf))))


OVERALL = {**CUTS, **CONCEPT, "shifted": SHIFT,
    "sc": f"""SELECT (SELECT least(1.0::DOUBLE, avg(psi)) FROM ({PSI})) AS data, (SELECT least(1.0::DOUBLE, avg(pattern_change) * 7) FROM con) AS concept, (SELECT avg(drift_score) FROM ({shifted(SCORES)})) AS performance""",
    "ov": "SELECT *, 0.3::DOUBLE * data + 0.3::DOUBLE * concept + 0.4::DOUBLE * performance AS overall_score FROM sc"}
QUERIES["overall_drift"] = lambda s, sf: tidy(overall(s, sf).drop("recommendations"))
ORACLES["overall_drift"] = final(cte("series history", "SELECT *, CASE WHEN overall_score > 0.7 THEN 'high' WHEN overall_score > 0.3 THEN 'medium' ELSE 'low' END AS drift_status FROM ov", **OVERALL),
    "drift_status", "data concept performance overall_score")
QUERIES["drift_recommendations"] = lambda s, sf: overall(s, sf).select(F.explode("recommendations").alias("recommendation"))
ORACLES["drift_recommendations"] = cte("series history", " UNION ALL ".join(f"SELECT '{text}' AS recommendation FROM sc WHERE {name} > {limit}" for name, (limit, text) in monitoring.ADVICE.items())
    + f" UNION ALL SELECT '{monitoring.STABLE}' FROM sc WHERE performance <= 0.3 AND data <= 0.5 AND concept <= 0.4", **OVERALL)

# Clusters have no SQL twin; what must hold of them has.
on("customer_features", invoices, clustering.customer_features, "custs",
   """SELECT customer_id, round_even(round(total_spent, 6) * 100, 0) / 100 AS total_revenue, round_even(round(avg_price, 6) * 100, 0) / 100 AS avg_order_value, transactions::DOUBLE AS frequency, total_views::DOUBLE AS total_views FROM custs""",
   "customer_id", "total_revenue avg_order_value frequency total_views")
on("kmeans_customers", invoices, lambda d: clustering.kmeans_customers(clustering.customer_features(d)).select("customer_id", "cluster"), "", None)
on("cluster_profile", invoices, lambda d: clustering.cluster_profile(clustering.kmeans_customers(clustering.customer_features(d))), "", None)
on("kmeans_elbow", invoices, lambda d: clustering.elbow(clustering.customer_features(d), clustering.CUSTOMER_FEATURES), "", None)
on("kmeans_products", invoices, lambda d: clustering.product_cluster_profile(clustering.kmeans_products(clustering.product_features(d))), "", None)



def cluster_facts(features, names, fit):
    """Members, clusters, sums, and rows that lie nearer to the mean of another cluster than to that of their own."""
    def facts(s, sf):
        out = fit(features(invoices(s, sf))).withColumn("_key", F.monotonically_increasing_id())
        spread = out.agg(*[F.stddev_samp(c).alias(f"_s_{c}") for c in names])
        means = out.groupBy(F.col("cluster").alias("_c")).agg(*[F.avg(c).alias(f"_m_{c}") for c in names])
        far = sum(((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")) ** 2 for c in names)
        # At most five means.
        near = out.crossJoin(F.broadcast(spread)).crossJoin(F.broadcast(means)).groupBy("_key", "cluster", *names).agg(
            F.min(far).alias("least"), F.max(F.when(F.col("cluster") == F.col("_c"), far)).alias("own"))
        return near.agg(
            F.count(F.lit(1)).alias("members"), F.count_distinct("cluster").alias("clusters"),
            F.count_if(F.col("own") > F.col("least") + 1e-9).alias("misplaced"), grid(F.sum(names[0]), 2).alias("revenue"))
    return facts


QUERIES["kmeans_customers_facts"] = cluster_facts(clustering.customer_features, clustering.CUSTOMER_FEATURES, clustering.kmeans_customers)
ORACLES["kmeans_customers_facts"] = cte("custs", f"""SELECT count(*) AS members, 4 AS clusters, 0 AS misplaced,
   floor(sum(round_even(round(total_spent, 6) * 100, 0) / 100) * 100 + {EDGE}) / 100 AS revenue FROM custs""")
QUERIES["kmeans_products_facts"] = cluster_facts(clustering.product_features, clustering.PRODUCT_FEATURES, clustering.kmeans_products)
ORACLES["kmeans_products_facts"] = cte("inv", f"""SELECT count(*) AS members, 5 AS clusters, 0 AS misplaced,
   floor(sum(round_even(round(r, 6) * 100, 0) / 100) * 100 + {EDGE}) / 100 AS revenue FROM (SELECT sum(price) AS r FROM inv WHERE stream_id IS NOT NULL GROUP BY stream_id)""")


def profile_facts(s, sf):
    """Sums over the cluster profile: every customer and all revenue once, shares of a hundred."""
    profile = clustering.cluster_profile(clustering.kmeans_customers(clustering.customer_features(invoices(s, sf))))
    return profile.agg(
        F.sum("members").alias("members"), grid(F.sum("total_revenue"), 2).alias("revenue"),
        grid(F.sum("member_share"), 2).alias("member_share"), grid(F.sum("revenue_share"), 2).alias("revenue_share"))


QUERIES["cluster_profile_facts"] = profile_facts
ORACLES["cluster_profile_facts"] = cte("custs", f"""SELECT count(*) AS members, floor(sum(round_even(round(total_spent, 6) * 100, 0) / 100) * 100 + {EDGE}) / 100 AS revenue,
   100.0::DOUBLE AS member_share, 100.0::DOUBLE AS revenue_share FROM custs""")


def event_stream(s, sf):
    """The events file as a stream."""
    schema = table(s, sf, "events").schema
    rows = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    kind = F.col("event_type")
    return rows.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(kind == "error", "ERROR").otherwise("INFO").alias("level"),
        F.when(kind == "error", 500).when(kind == "signup", 404).otherwise(200).alias("status_code"),
        F.col("value").alias("response_time_ms"),
    )


def streamed(s, stream):
    base = fresh_path(s, "stream")
    return activity.finished(s, stream, f"{base}/out", f"{base}/state")


QUERIES["log_activity_stream"] = lambda s, sf: tidy(streamed(s, activity.log_activity_stream(event_stream(s, sf))))
ORACLES["log_activity_stream"] = """SELECT CAST(ts::DATE AS VARCHAR) AS date, count(*) AS total_logs, count(*) FILTER (event_type = 'error') AS error_logs FROM events GROUP BY 1"""
QUERIES["request_rate_alerts"] = lambda s, sf: tidy(activity.rate_alerts(streamed(s, activity.request_rates(event_stream(s, sf), "1 hour"))))
ORACLES["request_rate_alerts"] = final("""SELECT epoch_us(w) AS window_start, requests, error_rate, avg_response_ms, error_rate > 5 AS error_alert, avg_response_ms > 5000 AS response_alert FROM
    (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, count(*) AS requests, avg(CASE WHEN event_type IN ('error', 'signup') THEN 100.0::DOUBLE ELSE 0 END) AS error_rate, avg(value) AS avg_response_ms FROM events GROUP BY 1)
    WHERE error_rate > 5 OR avg_response_ms > 5000""",
    "window_start requests error_alert response_alert", "error_rate avg_response_ms")
