import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from revlake.operators import logs, monitoring
from revlake.streaming import activity

NOW = dt.datetime(2024, 1, 10, 12)


def log_frame(spark):
    rows = [(NOW - dt.timedelta(hours=h), lvl, c, f"m{h}") for h, lvl, c in ((0, "INFO", "France"), (1, "ERROR", "Spain"), (30, "INFO", "Italy"))]
    return spark.createDataFrame(rows, "timestamp timestamp, level string, country string, message string").withColumn("category", F.lit("x")).withColumn("model_type", F.lit("arima"))


def nested(depth, inner):
    return nested(depth - 1, {"n" + str(depth): inner}) if depth else inner


def test_redaction_at_any_depth(spark):
    out = json.loads(redacted(spark, json.dumps(nested(7, {"k": 1, "my_token": "hidden", "more": {"password": 5, "x": [1, "a"]}}))))
    for k in range(1, 8):
        out = out[f"n{k}"]
    assert out == {"k": 1, "my_token": logs.REDACTED, "more": {"password": logs.REDACTED, "x": [1, "a"]}}
    assert "hidden" not in redacted(spark, json.dumps(nested(7, {"auth": {"a": "hidden"}, "b": 1})))


def redacted(spark, value):
    df = spark.createDataFrame([(json.dumps(value) if not isinstance(value, str) else value,)], "c string")
    return df.select(logs.redact_json("c")).first()[0]


def test_redaction(spark):
    value = {"user": "u\"1", "Password": "p", "n": 1.5, "flag": True, "none": None, "short": [1, 2], "long": list(range(101)), "in": {"authKey": "x", "deep": {"token": "y", "k": "v"}}, "text": "12"}
    out = json.loads(redacted(spark, value))
    assert out["Password"] == "***REDACTED***" and out["in"]["authKey"] == "***REDACTED***" and out["in"]["deep"]["token"] == "***REDACTED***"
    assert out["long"] == "[101 items]" and out["short"] == [1, 2] and out["user"] == 'u"1' and out["in"]["deep"]["k"] == "v"
    assert out["flag"] is True and out["none"] is None and out["n"] == 1.5
    assert redacted(spark, "not json") == "not json"


def plain_redaction(data):
    """The rule on Python objects."""
    out = {}
    for key, value in data.items():
        if any(w in key.lower() for w in logs.SECRET_WORDS):
            out[key] = logs.REDACTED
        elif isinstance(value, dict):
            out[key] = plain_redaction(value)
        else:
            out[key] = f"[{len(value)} items]" if isinstance(value, list) and len(value) > 100 else value
    return out


def test_one_rule_at_every_level(spark):
    inner = {"keep": 1, "e": {"tokens": [1], "k": 2}, "authors": {"a": {"b": 1}}, "list": list(range(101)), "short": [{"token": "stays"}], "none": None, "é\"": "\u00e9\"", "empty": {}}
    for depth in range(8):
        value = nested(depth, inner)
        assert json.loads(redacted(spark, value)) == plain_redaction(value)


def test_texts_without_an_object(spark):
    deep = nested(logs.DEPTH + 3, {"password": "hidden", "k": 1})
    assert "hidden" not in redacted(spark, deep) and "n5" in redacted(spark, deep)
    for text in ("[1, 2]", '"x"', "null", "", "{bad"):
        assert redacted(spark, text) == text
    assert redacted(spark, '{"password": "hidden"') == logs.REDACTED
    assert spark.createDataFrame([(None,)], "c string").select(logs.redact_json("c")).first()[0] is None


def test_old_logs_are_deleted_on_disk(spark, tmp_path):
    path = str(tmp_path / "logs")
    rows = [(NOW - dt.timedelta(hours=6 * k), f"m{k}") for k in range(40)]
    frame = spark.createDataFrame(rows, "timestamp timestamp, message string")
    wide = frame.select("timestamp", *[(F.col("message") if f.name == "message" else F.lit(None).cast(f.dataType)).alias(f.name) for f in logs.API_LOGS.fields if f.name != "timestamp"])
    logs.append_log(wide, path)
    kept, deleted = logs.retention_delete(wide, NOW, 5)
    expected = sorted(r["message"] for r in kept.collect())
    assert logs.delete_old_logs(spark, path, NOW, 5).collect() == deleted.collect()
    assert sorted(r["message"] for r in spark.read.parquet(path).collect()) == expected
    folders = sorted(p.name for p in (tmp_path / "logs").iterdir() if p.is_dir())
    assert folders == [f"day=2024-01-{d:02}" for d in range(5, 11)]
    assert logs.delete_old_logs(spark, path, NOW, 5).first()["deleted"] == 0
    # A limit at midnight leaves no part of a day.
    assert logs.delete_old_logs(spark, path, dt.datetime(2024, 1, 10), 2).first()["deleted"] == len([1 for t, _ in rows if dt.datetime(2024, 1, 5, 12) <= t < dt.datetime(2024, 1, 8)])
    assert sorted(p.name for p in (tmp_path / "logs").iterdir() if p.is_dir()) == [f"day=2024-01-{d:02}" for d in (8, 9, 10)]


def test_recent_days_prune_stored_logs(spark, tmp_path):
    path = str(tmp_path / "logs")
    frame = spark.range(40).select(F.timestamp_seconds(F.col("id") * 86_400 + 1_700_000_000).alias("timestamp"), F.lit("ERROR").alias("level"), F.lit("m").alias("message"))
    frame.withColumn("day", F.to_date("timestamp")).write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    for query in (logs.daily_activity, logs.top_errors):
        wanted, found = query(frame).collect(), query(stored)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "day" in plan[plan.index("PartitionFilters: [") :].split("\n")[0] and "ubquery" in plan[plan.index("PartitionFilters: [") :].split("\n")[0]


def test_filters_and_pages(spark):
    df = log_frame(spark)
    assert logs.filter_logs(df, country="Spain").count() == 1
    assert logs.filter_logs(df, start="2024-01-10", end="2024-01-10").count() == 2
    page = logs.paginate_logs(df, limit=2).collect()
    assert [r["message"] for r in page] == ["m0", "m1"] and page[0]["total_count"] == 3 and page[0]["has_more"]
    assert not logs.paginate_logs(df, limit=2, offset=2).first()["has_more"]
    kept, deleted = logs.retention_delete(df, NOW, 1)
    assert kept.count() == 2 and deleted.first()["deleted"] == 1


def test_mean_response_time(spark):
    rows = [(NOW, "e", s, 200) for s in (0.1, 0.2, 0.5, 1.0, 0.3)]
    df = spark.createDataFrame(rows, "timestamp timestamp, endpoint string, response_time_ms double, status_code int")
    r = logs.endpoint_metrics(df).first()
    assert r["requests"] == 5 and r["avg_response_ms"] == pytest.approx(0.42) and r["p50_response_ms"] == 0.3
    assert r["p95_response_ms"] == pytest.approx(0.9)


def test_append_log(spark, tmp_path):
    req = spark.createDataFrame([(NOW, "/predict", "POST", 503, 250.0, '{"country": "France", "token": "t"}')], "timestamp timestamp, endpoint string, method string, status_code int, response_time_ms double, request_data string")
    rows = logs.request_logs(req)
    logs.append_log(rows, str(tmp_path / "logs"))
    logs.append_log(logs.error_logs(rows.select("timestamp", "message", "details")), str(tmp_path / "logs"))
    back = spark.read.parquet(str(tmp_path / "logs"))
    assert back.count() == 2 and back.where("level = 'ERROR'").count() == 2
    first = back.where("category = 'api_request'").first()
    assert (first["message"], first["country"], first["duration_seconds"]) == ("POST /predict -> 503", "France", 0.25)
    assert '"t"' not in first["details"]


def test_t_critical_known_values():
    for df, value in ((1, 12.7062), (4, 2.7764), (10, 2.2281), (98, 1.9845)):
        assert monitoring.t_critical(df) == pytest.approx(value, abs=2e-4)


def history(spark, values, country="France"):
    rows = [(country, "arima", NOW + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "country string, model_type string, timestamp timestamp, r2 double")


def test_drift_test_fires_on_a_drop_only(spark):
    good = [0.9, 0.91, 0.89, 0.92, 0.9, 0.9, 0.91]
    df = history(spark, good + [0.5, 0.52, 0.5, 0.49, 0.51]).unionByName(history(spark, good + [0.9, 0.91, 0.9, 0.92, 0.9], "Spain"))
    out = {r["country"]: r for r in monitoring.performance_drift_test(df).collect()}
    assert out["France"]["has_drift"] and not out["Spain"]["has_drift"]
    assert out["France"]["drift_score"] == pytest.approx(abs(out["France"]["t_statistic"]) / 10)
    alert = monitoring.drift_alerts(monitoring.performance_drift_test(df)).first()
    assert alert["affected_features"] == ["arima"]
    assert monitoring.performance_drift_test(history(spark, [0.9] * 5)).count() == 0
    # A single earlier record counts with variance 0.
    assert monitoring.performance_drift_test(history(spark, [0.9, 0.1, 0.11, 0.1, 0.09, 0.1])).first()["has_drift"]


def test_scores_and_summary(spark):
    df = history(spark, [0.8] * 6 + [0.4] * 5)
    assert monitoring.performance_drift_scores(df).first()["drift_score"] == pytest.approx(0.5)
    assert monitoring.performance_drift_score(history(spark, [0.8] * 3)).first()["overall_score"] == 0.0
    both = df.unionByName(history(spark, [0.9] * 6, "Spain"))
    s = monitoring.performance_summary(both).first()
    assert (s["best_model"], s["worst_model"]) == ("Spain_arima", "France_arima")
    assert monitoring.performance_summary(df.where("false")).first()["best_model"] == "none"
    assert monitoring.performance_stability(df.where("false")).first()["level"] == "unknown"
    # Records beyond those kept of a key do not count.
    long = history(spark, [0.1] * 40 + [0.9] * monitoring.HISTORY)
    assert monitoring.performance_summary(long).first()["average_accuracy"] == pytest.approx(0.9)
    assert monitoring.performance_stability(long).first()["stability"] == pytest.approx(1.0)


def test_prediction_records(spark):
    df = spark.createDataFrame([("France", "arima", 1.5, None)], "country string, model_type string, prediction_time double, confidence double")
    row = monitoring.append_prediction_records(df, NOW).first()
    assert (row["prediction_time"], row["confidence_score"], row["timestamp"]) == (1.5, 0.0, NOW)
    assert monitoring.capped_history(history(spark, [0.5] * 120)).count() == 100


def test_recommendation_rules_and_order(spark):
    metrics = spark.createDataFrame([("France", "arima", 600.0, 700.0, 0.5), ("Spain", "arima", 1.0, 2.0, 0.9)], "country string, model_type string, mae double, rmse double, r2 double")
    correlation = spark.createDataFrame([("Spain", "weak"), ("France", "strong")], "country string, strength string")
    out = monitoring.recommendations(metrics, ranked=metrics.withColumn("rank", F.lit(1)), correlation=correlation).collect()
    assert [r["priority"] for r in out] == ["high", "medium", "medium", "low", "low"]
    assert out[0]["details"] == "MAE: 600.00, RMSE: 700.00"


def test_data_drift_sees_a_shift(spark):
    base = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    same = monitoring.data_drift(base, base, ["v"]).first()
    moved = monitoring.data_drift(base, base.select((F.col("v") + 500).alias("v")), ["v"]).first()
    assert same["psi"] == pytest.approx(0.0) and not same["has_drift"] and moved["has_drift"]


def test_alert_stream(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=20 * i), 500 if i < 10 else 200, 10.0 if i < 30 else 9000.0) for i in range(60)]
    schema = "timestamp timestamp, status_code int, response_time_ms double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = activity.request_rates(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), delay="1 second")
    rates = activity.finished(spark, stream, str(tmp_path / "out"), str(tmp_path / "state"))
    out = activity.rate_alerts(rates).orderBy("window_start").collect()
    assert [(r["window_start"].minute, r["error_alert"], r["response_alert"]) for r in out] == [(0, True, False), (10, False, True), (15, False, True)]


def test_activity_stream_equals_batch(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, d, h), "ERROR" if h == 3 else "INFO") for d in range(1, 6) for h in range(0, 24, 3)]
    schema = "timestamp timestamp, level string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = activity.log_activity_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    args = (str(tmp_path / "out"), str(tmp_path / "state"))
    found = sorted(map(tuple, activity.finished(spark, stream, *args).collect()))
    batch = sorted(map(tuple, logs.daily_activity(spark.read.parquet(str(tmp_path / "in")), None).collect()))
    assert found == batch
    # More rows of the open last day replace what was written of it; a finished day stays.
    spark.createDataFrame([(dt.datetime(2024, 1, 5, 22), "ERROR"), (dt.datetime(2024, 1, 6, 1), "INFO")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    again = activity.finished(spark, activity.log_activity_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))), *args)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, logs.daily_activity(spark.read.parquet(str(tmp_path / "in")), None).collect()))
