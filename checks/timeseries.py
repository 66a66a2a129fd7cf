"""Daily series, features, forecasts and their evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.inputs import cte, final, invoices, series, sparse_series, tidy
from revlake.operators import autoregressive, evaluation, forecasting, monitoring, registry, supervised
from revlake.operators import series as ts
from revlake.session import pinned

QUERIES, ORACLES = {}, {}


def on(name, source, query, needs, body, plain="", dbl="", date="", digits=2, **extra):
    QUERIES[name] = lambda s, sf: tidy(query(source(s, sf)), digits)
    if body:
        ORACLES[name] = final(cte(needs, body, **extra), plain, dbl, date, digits)


on("country_totals", invoices, ts.country_totals, "inv", "SELECT country, sum(price) AS total_revenue FROM inv GROUP BY country", "country", "total_revenue")
on("complete_calendar", sparse_series, ts.complete_calendar, "series", "SELECT * FROM series", "series", "y", "ds")
on("month_spine", sparse_series, lambda d: ts.month_spine(d, column="ds"), "sparse",
   """SELECT series, CAST(unnest(generate_series(date_trunc('month', min(ds)), date_trunc('month', max(ds)) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS ds
   FROM sparse GROUP BY series""", "series", "", "ds")
on("daily_ts", invoices, ts.daily_ts, "inv",
   """SELECT p.series, p.date, coalesce(purchases, 0) AS purchases, coalesce(unique_invoices, 0) AS unique_invoices, coalesce(unique_streams, 0) AS unique_streams,
   coalesce(total_views, 0) AS total_views, strftime(p.date, '%Y-%m') AS year_month, coalesce(revenue, 0) AS revenue FROM
   (SELECT series, CAST(unnest(generate_series(date_trunc('month', min(date)), date_trunc('month', max(date)) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM dd GROUP BY series) p
   LEFT JOIN dd ON p.series = dd.series AND p.date = dd.date""",
   "series purchases unique_invoices unique_streams total_views year_month", "revenue", "date",
   top="SELECT country FROM inv GROUP BY country ORDER BY sum(price) DESC, country LIMIT 10",
   tagged="SELECT 'all' AS series, * FROM inv UNION ALL SELECT lower(country), * FROM inv WHERE country IN (SELECT country FROM top)",
   dd="""SELECT series, date, count(*) AS purchases, count(DISTINCT invoice) AS unique_invoices, count(DISTINCT stream_id) AS unique_streams,
   CAST(sum(times_viewed) AS BIGINT) AS total_views, sum(price) AS revenue FROM tagged GROUP BY series, date""")
on("resample_month", series, ts.resample, "series", "SELECT series, last_day(ds) AS period, sum(y) AS y FROM series GROUP BY 1, 2", "series", "y", "period")
on("resample_week", series, lambda d: ts.resample(d, "week"), "series", "SELECT series, date_trunc('week', ds)::DATE + 6 AS period, sum(y) AS y FROM series GROUP BY 1, 2", "series", "y", "period")
on("series_stats", series, ts.series_stats, "series", """SELECT series, count(*) AS days, avg(y) AS mean, quantile_cont(y, 0.5) AS median, max(y) AS "max", stddev_samp(y) AS std FROM series GROUP BY series""",
   "series days", 'mean median "max" std')
on("filter_training_series", sparse_series, lambda d: ts.filter_training_series(d.withColumn("y", F.when(F.dayofmonth("ds") == 5, None).otherwise(F.col("y") - 50))), "sparse",
   """SELECT series, ds, y FROM (SELECT *, count(*) OVER (PARTITION BY series) AS c2 FROM b WHERE n <= 10 OR y <= lim) WHERE c2 >= 30""", "series", "y", "ds",
   a="SELECT series, ds, y - 50 AS y FROM sparse WHERE day(ds) <> 5 AND y - 50 >= 0",
   b="SELECT *, count(*) OVER (PARTITION BY series) AS n, avg(y) OVER (PARTITION BY series) + 5 * stddev_samp(y) OVER (PARTITION BY series) AS lim FROM a")
GAPPED = lambda d: d.withColumn("y", F.when(F.dayofmonth("ds").isin(3, 4, 5), None).otherwise(F.col("y")))
GAPS = "SELECT series, ds, CASE WHEN day(ds) IN (3, 4, 5) THEN NULL ELSE y END AS y, row_number() OVER (PARTITION BY series ORDER BY ds) AS i FROM sparse"
on("backfill", sparse_series, lambda d: ts.backfill(GAPPED(d), ["y"]), "sparse",
   """SELECT series, ds, coalesce(first_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS y FROM g""", "series", "y", "ds", g=GAPS)
on("interpolate_linear", sparse_series, lambda d: ts.interpolate_linear(GAPPED(d)).na.fill({"y": -1.0}), "sparse",
   "SELECT series, ds, coalesce(y, py + coalesce((qy - py) / nullif(qi - pi, 0), 0) * (i - pi), -1) AS y FROM h", "series", "y", "ds", g=GAPS,
   h="""SELECT *, last_value(y IGNORE NULLS) OVER p AS py, last_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER p AS pi,
   first_value(y IGNORE NULLS) OVER n AS qy, first_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER n AS qi FROM g
   WINDOW p AS (PARTITION BY series ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY series ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")
on("prepare_series", invoices, lambda d: ts.prepare_series(
    d.select(F.col("country").alias("series"), F.col("date").alias("ds"), F.when(F.col("times_viewed") % 5 != 0, F.col("times_viewed")).cast("double").alias("y"),
             F.struct("invoice", "stream_id", "times_viewed", "price").alias("seq")), "seq"), "inv",
   """SELECT country AS series, date AS ds, times_viewed::DOUBLE AS y FROM (SELECT *, row_number() OVER (PARTITION BY country, date ORDER BY invoice DESC, stream_id DESC, times_viewed DESC, price DESC) AS n FROM inv)
   WHERE n = 1 AND times_viewed % 5 <> 0""", "series", "y", "ds")
W = "OVER (PARTITION BY series ORDER BY ds"
LAGS = ", ".join(f"coalesce(lag(y, {k}) {W}), -1) AS y_lag_{k}" for k in ts.LAGS)
on("lag_features", series, lambda d: ts.lag_features(d).na.fill(-1.0), "series", f"SELECT series, ds, y, {LAGS} FROM series", "series", "y " + " ".join(f"y_lag_{k}" for k in ts.LAGS), "ds")
ROLL = ", ".join(f"avg(y) {W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS y_rolling_mean_{n}, coalesce(stddev_samp(y) {W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), -1) AS y_rolling_std_{n}" for n in ts.WIDTHS)
ROLLED = " ".join(f"y_rolling_mean_{n} y_rolling_std_{n}" for n in ts.WIDTHS)
on("rolling_features", series, lambda d: ts.rolling_features(d).na.fill(-1.0), "series", f"SELECT series, ds, y, {ROLL} FROM series", "series", "y " + ROLLED, "ds")
GROW = ", ".join(f"coalesce(y / nullif(lag(y, {k}) {W}), 0) - 1, -9) AS y_growth_{k}d" for k in (1, 7))
on("growth_rates", sparse_series, lambda d: ts.growth_rates(d).na.fill(-9.0), "sparse", f"SELECT series, ds, {GROW} FROM sparse", "series", "y_growth_1d y_growth_7d", "ds", 4)
QUERIES["growth_rates"] = lambda s, sf: tidy(ts.growth_rates(sparse_series(s, sf)).na.fill(-9.0).drop("y"), 4)
FILLED = [*[f"y_lag_{k}" for k in ts.LAGS], *ROLLED.split(), "y_growth_1d", "y_growth_7d"]
AHEAD = "OVER (PARTITION BY series ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
RAW_FEATURES = (", ".join(f"lag(y, {k}) {W}) AS y_lag_{k}" for k in ts.LAGS) + ", " + ROLL.replace("coalesce(", "").replace("), -1)", ")") + ", "
    + ", ".join(f"y / nullif(lag(y, {k}) {W}), 0) - 1 AS y_growth_{k}d" for k in (1, 7)))
on("engineer_features", series, ts.engineer_features, "series",
   "SELECT series, ds, y, (isodow(ds) >= 6)::INTEGER AS is_weekend, (day(ds) <= 3)::INTEGER AS is_month_start, (day(ds) >= 28)::INTEGER AS is_month_end, "
   + ", ".join(f"coalesce(first_value({c} IGNORE NULLS) {AHEAD}, 0) AS {c}" for c in FILLED) + " FROM g",
   "series is_weekend is_month_start is_month_end", "y " + " ".join(FILLED), "ds", g=f"SELECT *, {RAW_FEATURES} FROM series")
DTS = """SELECT series, ds AS date, y AS revenue, 1.0::DOUBLE * day(ds) AS unique_invoices, 2.0::DOUBLE * day(ds) AS total_views FROM sparse"""
RW = "OVER (PARTITION BY series ORDER BY date RANGE BETWEEN"
RANGES = (", ".join(f"coalesce(sum(revenue) {RW} INTERVAL {k} DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) AS previous_{k}" for k in ts.LOOKBACKS)
    + f", coalesce(sum(revenue) {RW} INTERVAL 365 DAY PRECEDING AND INTERVAL 336 DAY PRECEDING), 0) AS previous_year"
    + f", coalesce(avg(unique_invoices) {RW} INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) AS recent_invoices"
    + f", coalesce(avg(total_views) {RW} INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) AS recent_views"
    + f", coalesce(sum(revenue) {RW} CURRENT ROW AND INTERVAL 29 DAY FOLLOWING), 0) AS target")
SHAPED = lambda d: d.select("series", F.col("ds").alias("date"), F.col("y").alias("revenue"), F.dayofmonth("ds").cast("double").alias("unique_invoices"),
                            (F.dayofmonth("ds") * 2.0).alias("total_views"))
RANGED = " ".join([*ts.FEATURES, "target"])
on("range_features", sparse_series, lambda d: ts.range_features(SHAPED(d)), "sparse", f"SELECT *, {RANGES} FROM d", "series", "revenue unique_invoices total_views " + RANGED, "date", d=DTS)
on("trim_training", sparse_series, lambda d: ts.trim_training(ts.range_features(SHAPED(d))).select("series", "date", "target"), "sparse",
   f"SELECT series, date, target FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS n FROM r WHERE {' + '.join(ts.FEATURES)} > 0) WHERE n > 30",
   "series", "target", "date", d=DTS, r=f"SELECT *, {RANGES} FROM d")
on("difference", series, lambda d: ts.difference(d, 2), "series",
   f"SELECT series, ds, y FROM (SELECT series, ds, y - 2 * lag(y) {W}) + lag(y, 2) {W}) AS y FROM series) WHERE y IS NOT NULL", "series", "y", "ds")
on("log_transform", sparse_series, lambda d: ts.log_transform(d), "sparse",
   "SELECT series, ds, min(y) OVER (PARTITION BY series) > 0 AS logged, CASE WHEN min(y) OVER (PARTITION BY series) > 0 THEN ln(1 + y) ELSE y END AS y FROM sparse", "series logged", "y", "ds", 4)
on("inverse_log_transform", sparse_series, lambda d: ts.inverse_log_transform(ts.log_transform(d)), "sparse", "SELECT * FROM sparse", "series", "y", "ds")
on("split_last_share", sparse_series, lambda d: ts.split_last_share(d).drop("y"), "sparse",
   "SELECT series, ds, row_number() OVER (PARTITION BY series ORDER BY ds DESC) <= floor(count(*) OVER (PARTITION BY series) * 0.2::DOUBLE) AS is_test FROM sparse", "series is_test", "", "ds")
on("split_last_days", sparse_series, lambda d: ts.split_last_days(d).drop("y"), "sparse", "SELECT series, ds, ds > max(ds) OVER (PARTITION BY series) - 30 AS is_test FROM sparse", "series is_test", "", "ds")
on("future_dates", sparse_series, lambda d: ts.future_dates(d, 30), "sparse",
   "SELECT series, CAST(unnest(generate_series(max(ds) + INTERVAL 1 DAY, max(ds) + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS ds FROM sparse GROUP BY series", "series", "", "ds")

# Trend and seasonality: the model as SQL, for series keyed by any list of columns.
Z95 = forecasting.z_value(0.95)


def fitted_sql(source: str, keys: str, multiplicative: bool = False) -> str:
    off, rest, fit = ("y / nullif(trend, 0)", "dev / nullif(weekly, 0)", "trend * weekly * yearly") if multiplicative else ("y - trend", "dev - weekly", "trend + weekly + yearly")
    return f"""(SELECT *, {fit} AS fitted, y - ({fit}) AS residual FROM (SELECT *, avg({rest}) OVER (PARTITION BY {keys}, month(ds)) AS yearly FROM
        (SELECT *, avg(dev) OVER (PARTITION BY {keys}, isodow(ds)) AS weekly FROM (SELECT *, {off} AS dev FROM (SELECT *, intercept + slope * x AS trend FROM
        (SELECT *, coalesce(regr_slope(y, x) OVER (PARTITION BY {keys}), 0) AS slope, coalesce(regr_intercept(y, x) OVER (PARTITION BY {keys}), avg(y) OVER (PARTITION BY {keys})) AS intercept
        FROM (SELECT *, (ds - min(ds) OVER (PARTITION BY {keys}))::DOUBLE AS x FROM {source}))))))) """


def forecast_sql(fit: str, keys: str, horizon: int, multiplicative: bool = False) -> str:
    neutral = 1 if multiplicative else 0
    combine = "trend * weekly * yearly" if multiplicative else "trend + weekly + yearly"
    seasonal = "weekly * yearly" if multiplicative else "weekly + yearly"
    on_keys = " AND ".join(f"f.{k} = w.{k}" for k in keys.split(", "))
    on_months = " AND ".join(f"f.{k} = m.{k}" for k in keys.split(", "))
    f_keys = ", ".join(f"f.{k}" for k in keys.split(", "))
    return f"""SELECT {keys}, ds, {combine} AS yhat, {combine} - {Z95!r} * sigma AS lower, {combine} + {Z95!r} * sigma AS upper, trend, {seasonal} AS seasonal FROM
        (SELECT {f_keys}, f.ds, sigma, intercept + slope * (f.ds - first_ds) AS trend, coalesce(w.weekly, {neutral}) AS weekly, coalesce(m.yearly, {neutral}) AS yearly
        FROM (SELECT {keys}, min(ds) AS first_ds, any_value(slope) AS slope, any_value(intercept) AS intercept, coalesce(stddev_samp(residual), 0) AS sigma,
              CAST(unnest(generate_series(max(ds) + INTERVAL 1 DAY, max(ds) + INTERVAL {horizon} DAY, INTERVAL 1 DAY)) AS DATE) AS ds FROM {fit} GROUP BY {keys}) f
        LEFT JOIN (SELECT {keys}, isodow(ds) AS d, any_value(weekly) AS weekly FROM {fit} GROUP BY ALL) w ON {on_keys} AND isodow(f.ds) = d
        LEFT JOIN (SELECT {keys}, month(ds) AS mo, any_value(yearly) AS yearly FROM {fit} GROUP BY ALL) m ON {on_months} AND month(f.ds) = mo)"""


on("decompose_components", series, lambda d: forecasting.decompose_components(d).select("series", "ds", "y", "trend", "weekly", "yearly", "fitted", "residual"), "series",
   f"SELECT * FROM {fitted_sql('series', 'series')}", "series", "y trend weekly yearly fitted residual", "ds")
FORECAST = "yhat lower upper trend seasonal"
ADD = forecast_sql("fit", "series", 30)
on("forecast_seasonal_trend", series, forecasting.forecast_seasonal_trend, "series", ADD, "series", FORECAST, "ds", fit=f"SELECT * FROM {fitted_sql('series', 'series')}")
on("forecast_multiplicative", series, lambda d: forecasting.forecast_seasonal_trend(d, multiplicative=True), "series", forecast_sql("fit", "series", 30, True), "series", FORECAST, "ds",
   fit=f"SELECT * FROM {fitted_sql('series', 'series', True)}")
on("fit_seasonal_trend", series, lambda d: forecasting.fit_seasonal_trend(d).select("series", "first_ds", "last_ds", "slope", "intercept", "sigma", F.size("weekday_effect").alias("weekdays"), F.size("month_effect").alias("months")), "series",
   "SELECT series, min(ds) AS first_ds, max(ds) AS last_ds, any_value(slope) AS slope, any_value(intercept) AS intercept, coalesce(stddev_samp(residual), 0) AS sigma, count(DISTINCT isodow(ds)) AS weekdays, count(DISTINCT month(ds)) AS months FROM fit GROUP BY series",
   "series weekdays months", "slope intercept sigma", "first_ds last_ds", fit=f"SELECT * FROM {fitted_sql('series', 'series')}")


def both_models(d):
    return forecasting.forecast_seasonal_trend(d), forecasting.forecast_seasonal_trend(d, multiplicative=True)


TWO = {
    "fa": f"SELECT * FROM {fitted_sql('series', 'series')}", "fm": f"SELECT * FROM {fitted_sql('series', 'series', True)}",
    "a": forecast_sql("fa", "series", 30), "m": forecast_sql("fm", "series", 30, True),
}
on("forecast_ensemble", series, lambda d: forecasting.forecast_ensemble(*both_models(d)), "series",
   "SELECT a.series, a.ds, " + ", ".join(f"0.6::DOUBLE * a.{c} + 0.4::DOUBLE * m.{c} AS {c}" for c in ("yhat", "lower", "upper")) + " FROM a JOIN m ON a.series = m.series AND a.ds = m.ds",
   "series", "yhat lower upper", "ds", **TWO)
on("cutoffs", series, forecasting.cutoffs, "series",
   """SELECT series, CAST(b - 180 - CAST(90 * unnest(range(0, CAST(floor((b - 180 - a - 730) / 90) AS BIGINT) + 1)) AS INTEGER) AS DATE) AS cutoff FROM (SELECT series, min(ds) AS a, max(ds) AS b, count(*) AS n FROM series GROUP BY series)
   WHERE n >= 1095 AND b - 180 - a - 730 >= 0""", "series", "", "cutoff")
BACKTEST = {
    "cuts": "SELECT series, CAST(b - 180 - CAST(90 * unnest(range(0, CAST(floor((b - 180 - a - 730) / 90) AS BIGINT) + 1)) AS INTEGER) AS DATE) AS cutoff FROM (SELECT series, min(ds) AS a, max(ds) AS b, count(*) AS n FROM series GROUP BY series) WHERE n >= 1095 AND b - 180 - a - 730 >= 0",
    "rep": "SELECT series.series, cutoff, ds, y FROM series JOIN cuts ON series.series = cuts.series",
    "old": "SELECT * FROM rep WHERE ds <= cutoff",
    "fit": f"SELECT * FROM {fitted_sql('old', 'series, cutoff')}",
    "fc": forecast_sql("fit", "series, cutoff", 180),
    "pairs": "SELECT rep.series, rep.cutoff, rep.ds, rep.y, yhat, lower, upper FROM rep JOIN fc ON rep.series = fc.series AND rep.cutoff = fc.cutoff AND rep.ds = fc.ds",
}
ACC = """count(*) AS n, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs((y - yhat) / (y + 1e-8))) * 100 AS mape,
   1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*) + 1e-8) AS r2, avg(abs(y - yhat)) / (avg(step) + 1e-8) AS mase"""
STEP = "SELECT *, abs(y - lag(y) OVER (PARTITION BY {k} ORDER BY ds)) AS step FROM pairs"
ROLLING = lambda d: forecasting.rolling_origin_forecasts(d)
# A divisor of 1e-8 stands in for zero: such MAPE values are compared by their logarithm, and R2 and
# MASE of series without any variation only as far as they are meaningful numbers.
LIMIT = 1e6


def relative(d):
    d = d.withColumn("mape", F.log10("mape"))
    return d.withColumns({"r2": F.greatest("r2", F.lit(-LIMIT)), "mase": F.least("mase", F.lit(LIMIT))}) if "r2" in d.columns else d


CLIPPED = "SELECT * REPLACE (log10(mape) AS mape, greatest(r2, -1e6) AS r2, least(mase, 1e6) AS mase)"
on("rolling_origin_accuracy", series, lambda d: relative(evaluation.accuracy_metrics(ROLLING(d), ["series", "cutoff"])), "series",
   f"{CLIPPED} FROM (SELECT series, cutoff, {ACC} FROM ({STEP.format(k='series, cutoff')}) GROUP BY series, cutoff)", "series n", "mae rmse mape r2 mase", "cutoff", **BACKTEST)
on("forecast_bias_coverage", series, lambda d: evaluation.forecast_bias_coverage(ROLLING(d)), "series",
   "SELECT series, avg(yhat - y) AS bias, var_pop(yhat) AS variance, avg(CASE WHEN y BETWEEN lower AND upper THEN 100.0::DOUBLE ELSE 0 END) AS coverage FROM pairs GROUP BY series", "series", "bias variance coverage", **BACKTEST)
on("accuracy_by_horizon", series, lambda d: relative(evaluation.accuracy_by_horizon(ROLLING(d))), "series",
   """SELECT series, CASE WHEN ds - cutoff <= 7 THEN 7 WHEN ds - cutoff <= 14 THEN 14 WHEN ds - cutoff <= 30 THEN 30 ELSE 60 END AS horizon, count(*) AS n, avg(abs(y - yhat)) AS mae,
   sqrt(avg((y - yhat) * (y - yhat))) AS rmse, log10(avg(abs((y - yhat) / (y + 1e-8))) * 100) AS mape FROM pairs WHERE ds - cutoff <= 60 GROUP BY 1, 2""", "series horizon n", "mae rmse mape", **BACKTEST)
on("business_correlation", series, lambda d: monitoring.business_correlation(ROLLING(d)), "series",
   "SELECT series, r AS correlation, CASE WHEN abs(r) < 0.3 THEN 'weak' WHEN abs(r) < 0.7 THEN 'moderate' ELSE 'strong' END AS strength FROM (SELECT series, corr(yhat, y) AS r FROM pairs GROUP BY series)",
   "series strength", "correlation", "", 4, **BACKTEST)


def held_out(d):
    """Fit before the last 30 days, forecast them with both models, next to what happened."""
    split = ts.split_last_days(d)
    a, m = both_models(split.where("not is_test").select("series", "ds", "y"))
    actual = split.where("is_test")
    rows = a.withColumn("model", F.lit("additive")).unionByName(m.withColumn("model", F.lit("multiplicative")))
    return forecasting.join_forecast_actual(rows, actual)


HELD = {
    "sp": "SELECT *, ds > max(ds) OVER (PARTITION BY series) - 30 AS is_test FROM series", "tr": "SELECT series, ds, y FROM sp WHERE NOT is_test",
    "fa": f"SELECT * FROM {fitted_sql('tr', 'series')}", "fm": f"SELECT * FROM {fitted_sql('tr', 'series', True)}",
    "a": forecast_sql("fa", "series", 30), "m": forecast_sql("fm", "series", 30, True),
    "pairs": """SELECT f.*, sp.y FROM (SELECT 'additive' AS model, * FROM a UNION ALL SELECT 'multiplicative', * FROM m) f JOIN sp ON f.series = sp.series AND f.ds = sp.ds AND is_test""",
    "acc": f"SELECT series, model, {ACC} FROM ({STEP.format(k='series, model')}) GROUP BY series, model",
}
KEYS = ["series", "model"]
on("join_forecast_actual", series, held_out, "series", "SELECT * FROM pairs", "series model", "y yhat lower upper trend seasonal", "ds", **HELD)
on("accuracy_metrics", series, lambda d: relative(evaluation.accuracy_metrics(held_out(d), KEYS)), "series", CLIPPED + " FROM acc", "series model n", "mae rmse mape r2 mase", **HELD)
on("model_comparison", series, lambda d: evaluation.model_comparison(evaluation.accuracy_metrics(held_out(d), KEYS)).drop("best_value"), "series",
   " UNION ALL ".join(f"SELECT series, '{c}' AS metric, arg_min(model, {'-' if c == 'r2' else ''}{c}) AS best_model FROM acc GROUP BY series" for c in ("mae", "rmse", "mape", "r2")), "series metric best_model", **HELD)
on("tuning_improvement", series, lambda d: evaluation.tuning_improvement(evaluation.accuracy_metrics(held_out(d), KEYS), "additive", "multiplicative").select("series", "mae_improvement", "rmse_improvement"), "series",
   "SELECT x.series, " + ", ".join(f"(x.{c} - z.{c}) / x.{c} * 100 AS {c}_improvement" for c in ("mae", "rmse")) + " FROM acc x JOIN acc z ON x.series = z.series AND x.model = 'additive' AND z.model = 'multiplicative'",
   "series", "mae_improvement rmse_improvement", **HELD)
on("rank_models", series, lambda d: evaluation.rank_models(evaluation.accuracy_metrics(held_out(d), KEYS)).select("series", "model", "rank"), "series",
   "SELECT series, model, rank() OVER (PARTITION BY series ORDER BY mae) AS rank FROM acc", "series model rank", **HELD)
STATS = """avg(yhat) AS mean_forecast, quantile_cont(yhat, 0.5) AS median_forecast, min(yhat) AS min_forecast, max(yhat) AS max_forecast, stddev_pop(yhat) AS std_forecast, sum(yhat) AS total_forecast"""
STAT_COLUMNS = "mean_forecast median_forecast min_forecast max_forecast std_forecast total_forecast"
on("forecast_statistics", series, lambda d: evaluation.forecast_statistics(forecasting.forecast_seasonal_trend(d)), "series", f"SELECT series, {STATS} FROM a GROUP BY series", "series", STAT_COLUMNS, **TWO)


def agreement(d):
    a, m = both_models(d)
    rows = a.withColumn("model", F.lit("a")).unionByName(m.withColumn("model", F.lit("m")))
    return evaluation.forecast_agreement(evaluation.forecast_statistics(rows, KEYS))


on("forecast_agreement", series, agreement, "series",
   """SELECT *, CASE WHEN std_mean / avg_mean < 0.1 THEN 'high' WHEN std_mean / avg_mean < 0.3 THEN 'moderate' ELSE 'disagreement' END AS agreement FROM
   (SELECT series, min(u) AS min_mean, max(u) AS max_mean, avg(u) AS avg_mean, stddev_pop(u) AS std_mean, min(v) AS min_total, max(v) AS max_total, stddev_pop(v) AS std_total FROM
   (SELECT series, avg(yhat) AS u, sum(yhat) AS v FROM a GROUP BY series UNION ALL SELECT series, avg(yhat), sum(yhat) FROM m GROUP BY series) GROUP BY series)""",
   "series agreement", "min_mean max_mean avg_mean std_mean min_total max_total std_total", **TWO)
on("forecast_vs_recent", series, lambda d: evaluation.forecast_vs_recent(evaluation.forecast_statistics(forecasting.forecast_seasonal_trend(d)), d), "series",
   """SELECT t.series, t.total_forecast, coalesce(r, 0) AS recent_revenue, CASE WHEN r > 0 THEN (t.total_forecast - r) / r * 100 ELSE 0 END AS growth_percent FROM
   (SELECT series, sum(yhat) AS total_forecast FROM a GROUP BY series) t LEFT JOIN (SELECT series, sum(y) AS r FROM (SELECT *, max(ds) OVER (PARTITION BY series) AS l FROM series) WHERE ds >= l - 90 GROUP BY series) q ON t.series = q.series""",
   "series", "total_forecast recent_revenue growth_percent", **TWO)
TREND = """SELECT *, CASE WHEN slope > 0.01 THEN 'increasing' WHEN slope < -0.01 THEN 'decreasing' ELSE 'stable' END AS direction, CASE WHEN abs(slope) > 1 THEN 'high' WHEN abs(slope) > 0.1 THEN 'medium' ELSE 'low' END AS strength FROM
   (SELECT series, coalesce(regr_slope(v, i), 0) AS slope, stddev_pop(v) / (avg(v) + 1e-8) AS volatility FROM (SELECT series, {c} AS v, row_number() OVER (PARTITION BY series ORDER BY ds)::DOUBLE AS i FROM {t}) GROUP BY series)"""
on("trend_analysis", series, lambda d: evaluation.trend_analysis(forecasting.forecast_seasonal_trend(d), "trend"), "series", TREND.format(c="trend", t="a"), "series direction strength", "slope volatility", **TWO)
on("forecast_trend", series, lambda d: evaluation.trend_analysis(forecasting.forecast_seasonal_trend(d)), "series", TREND.format(c="yhat", t="a"), "series direction strength", "slope volatility", **TWO)


def df_sql(source):
    return f"""SELECT series, t AS statistic, coalesce(t < -2.86, false) AS stationary FROM (SELECT series, b / sqrt((syy - b * sxy) / (n - 2) / sxx) AS t FROM
        (SELECT series, regr_count(dy, p)::DOUBLE AS n, regr_sxx(dy, p) AS sxx, regr_sxy(dy, p) AS sxy, regr_syy(dy, p) AS syy, regr_sxy(dy, p) / regr_sxx(dy, p) AS b FROM
        (SELECT series, y - lag(y) {W}) AS dy, lag(y) {W}) AS p FROM {source}) WHERE p IS NOT NULL GROUP BY series))"""


on("dickey_fuller_stat", sparse_series, evaluation.dickey_fuller_stat, "sparse", df_sql("sparse"), "series stationary", "statistic", "", 4)
CUMULATIVE = lambda d: d.withColumn("y", F.sum("y").over(Window.partitionBy("series").orderBy("ds")))
on("stationary_order", sparse_series, lambda d: evaluation.stationary_order(CUMULATIVE(d)), "sparse",
   "SELECT z.series, CASE WHEN z.stationary THEN 0 WHEN o.stationary THEN 1 ELSE 2 END AS d FROM z JOIN o ON z.series = o.series", "series d",
   c0=f"SELECT series, ds, sum(y) {W}) AS y FROM sparse", c1=f"SELECT * FROM (SELECT series, ds, y - lag(y) {W}) AS y FROM c0) WHERE y IS NOT NULL", z=df_sql("c0"), o=df_sql("c1"))
RESIDUALS = lambda d: forecasting.decompose_components(d).select("series", "ds", "residual")
FIT = {"fit": f"SELECT * FROM {fitted_sql('series', 'series')}"}
LJUNG = {
    **FIT, "ce": "SELECT series, ds, residual - avg(residual) OVER (PARTITION BY series) AS c FROM fit",
    "lb": "SELECT series, lag, n * (n + 2) * sum((pk / ss) * (pk / ss) / (n - lag)) OVER (PARTITION BY series ORDER BY lag) AS q FROM ("
    + " UNION ALL ".join(f"SELECT series, {k} AS lag, count(*)::DOUBLE AS n, sum(c * c) AS ss, sum(c * lk) AS pk FROM (SELECT *, lag(c, {k}) {W}) AS lk FROM ce) GROUP BY series" for k in range(1, 11)) + ")",
    # The lower incomplete gamma function as a series of positive terms.
    "lbp": """SELECT series, lag, q, greatest(0, 1 - list_sum(list_transform(range(0, CAST(3 * h + 200 AS BIGINT)), lambda i: exp((lag / 2.0::DOUBLE + i) * ln(h) - h - lgamma(lag / 2.0::DOUBLE + i + 1))))) AS p
              FROM (SELECT *, q / 2 AS h FROM lb)""",
}
SHAPE_SQL = """SELECT series, avg(residual) AS mean, stddev_pop(residual) AS std, skewness(residual) * (count(*) - 2) / sqrt(count(*)::DOUBLE * (count(*) - 1)) AS skewness,
   (kurtosis(residual) * (count(*) - 2) * (count(*) - 3) / (count(*) - 1) - 6) / (count(*) + 1) AS kurtosis FROM fit GROUP BY series"""
on("ljung_box", series, lambda d: evaluation.ljung_box(RESIDUALS(d)), "series", "SELECT * FROM lbp", "series lag", "q p", "", 4, **LJUNG)
on("residual_diagnostics", series, lambda d: evaluation.residual_diagnostics(RESIDUALS(d)), "series",
   f"SELECT s.*, min_p, min_p < 0.05 AS autocorrelated FROM ({SHAPE_SQL}) s JOIN (SELECT series, min(p) AS min_p FROM lbp GROUP BY series) p ON s.series = p.series",
   "series autocorrelated", "mean std skewness kurtosis min_p", "", 4, **LJUNG)
on("residual_shape", series, lambda d: evaluation.residual_diagnostics(RESIDUALS(d)).drop("min_p", "autocorrelated"), "series", SHAPE_SQL,
   "series", "mean std skewness kurtosis", **FIT)

# Orders small enough for closed forms: a random walk with drift and a first-order autoregression.
SCALED = {
    "z": f"""SELECT series, ds, CASE WHEN logged THEN ln(1 + y) ELSE y END AS z, logged, row_number() {W}) AS i FROM
    (SELECT *, min(y) OVER (PARTITION BY series) > 0 AS logged FROM series)""",
    "zl": f"SELECT *, lag(z) {W}) AS lz FROM z",
    "ends": "SELECT series, max(ds) AS last_ds, arg_max(z, ds) AS last_z, any_value(logged) AS logged FROM z GROUP BY series",
}
UNSCALED = "SELECT series, ds, " + ", ".join(f"CASE WHEN logged THEN exp({c}) - 1 ELSE {c} END AS {c}" for c in ("yhat", "lower", "upper")) + """ FROM
   (SELECT series, logged, last_ds + CAST(h AS INTEGER) AS ds, m AS yhat, m - spread AS lower, m + spread AS upper FROM steps)"""
on("forecast_random_walk", series, lambda d: autoregressive.forecast_ar(d, order=(0, 1, False)), "series", UNSCALED, "series", "yhat lower upper", "ds", **SCALED,
   steps=f"""SELECT ends.*, h, last_z + h * drift AS m, {Z95!r} * sigma * sqrt(h) AS spread FROM ends JOIN
   (SELECT series, avg(z - lz) AS drift, stddev_samp(z - lz) AS sigma FROM zl WHERE lz IS NOT NULL GROUP BY series) q ON ends.series = q.series, (SELECT unnest(range(1, 31)) AS h)""")
on("forecast_ar1", series, lambda d: autoregressive.forecast_ar(d, order=(1, 0, False)), "series", UNSCALED, "series", "yhat lower upper", "ds", **SCALED,
   steps=f"""SELECT ends.*, h, c * (1 - b ** h) / (1 - b) + b ** h * last_z AS m, {Z95!r} * sigma * sqrt((1 - b ** (2 * h)) / (1 - b ** 2)) AS spread FROM ends JOIN
   (SELECT series, regr_slope(z, lz) AS b, regr_intercept(z, lz) AS c, sqrt((regr_syy(z, lz) - regr_slope(z, lz) * regr_sxy(z, lz)) / (regr_count(z, lz) - 2)) AS sigma FROM zl WHERE lz IS NOT NULL GROUP BY series) q
   ON ends.series = q.series, (SELECT unnest(range(1, 31)) AS h)""")
SIMPLE = [(0, 0, False), (0, 1, False), (1, 0, False)]
SIMPLE_SQL = {
    **SCALED,
    "sse": """SELECT series, count(*)::DOUBLE AS n, var_pop(z) AS e00, var_pop(z - lz) AS e01, (regr_syy(z, lz) - regr_sxy(z, lz) ** 2 / regr_sxx(z, lz)) / count(*) AS e10 FROM zl WHERE i >= 10 GROUP BY series""",
    "scores": " UNION ALL ".join(f"SELECT series, {p} AS p, {d} AS d, false AS seasonal, n * ln(e{p}{d}) + 2 * {p + 2} AS aic, n * ln(e{p}{d}) + {p + 2} * ln(n) AS bic, n * ln(e{p}{d}) + 2 * {p + 2} * ln(ln(n)) AS hqic FROM sse" for p, d, _ in SIMPLE),
}
on("score_simple_orders", series, lambda d: autoregressive.score_orders(d, SIMPLE), "series", "SELECT * FROM scores", "series p d seasonal", "aic bic hqic", **SIMPLE_SQL)
on("search_simple_orders", series, lambda d: autoregressive.grid_search_order(d, SIMPLE, "bic"), "series",
   "SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY series ORDER BY bic) = 1", "series p d seasonal", "bic", **SIMPLE_SQL)

# Iterative fits have no SQL twin.
on("forecast_ar", series, lambda d: autoregressive.forecast_ar(d, reasons=True), "", None)
on("score_orders", series, lambda d: autoregressive.score_orders(d, reasons=True), "", None)
on("grid_search_order", series, lambda d: autoregressive.grid_search_order(d, reasons=True), "", None)
on("forecast_searched", series, lambda d: autoregressive.forecast_ar(d, orders=autoregressive.grid_search_order(d)), "", None)
on("run_models", series, lambda d: registry.run_models(d, ["seasonal_trend", "autoregressive", "ensemble"]), "", None)


def features(s, sf):
    return ts.range_features(ts.daily_ts(invoices(s, sf)))


def supervised_forecast(s, sf):
    table = pinned(features(s, sf), "features")
    models = supervised.train_each(ts.trim_training(table))
    return tidy(supervised.forecast_each(models, table), 2)


def dated_prediction(s, sf):
    table = pinned(features(s, sf), "features")
    models = supervised.train_each(ts.trim_training(table))
    wanted = table.select("series", F.date_add("date", 1).alias("date"))
    found, missing = supervised.predict_each_on_date(models, table, wanted)
    return tidy(found.unionByName(missing.withColumn("prediction", F.lit(None).cast("double"))), 2)


QUERIES["forecast_supervised"] = supervised_forecast
QUERIES["predict_on_date"] = dated_prediction
