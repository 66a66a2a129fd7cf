"""Trend and seasonality forecasts in plain column expressions, ensembles, backtests.

Everything hangs on one shuffle by the series key: windows by (series), (series, weekday) and
(series, month) and the final grouping all reuse it. Rows per series are bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY = ("series",)
# Backtest settings in days, ensemble weights.
CV_INITIAL, CV_PERIOD, CV_HORIZON, CV_MIN_POINTS = 730, 90, 180, 1095
WEIGHTS = (0.6, 0.4)


def z_value(interval: float) -> float:
    return NormalDist().inv_cdf(0.5 + interval / 2)


def _combine(trend, weekly, yearly, multiplicative: bool):
    return trend * weekly * yearly if multiplicative else trend + weekly + yearly


def decompose_components(df: DataFrame, keys: Sequence[str] = KEY, multiplicative: bool = False) -> DataFrame:
    """Trend, weekly and yearly part, fitted value and residual for every row of every series.

    The trend is a straight line on the day number; the weekly part is the mean deviation per
    weekday; the yearly part is the mean of what then remains per month. Multiplicative series use
    ratios in place of differences.
    """
    whole = W.partitionBy(*keys)
    weekday = W.partitionBy(*keys, F.weekday("ds"))
    month = W.partitionBy(*keys, F.month("ds"))
    dated = df.withColumn("_x", F.datediff("ds", F.min("ds").over(whole)).cast("double"))
    # A one-day series has no slope; its level is its mean.
    lined = dated.withColumns(
        {
            "slope": F.coalesce(F.regr_slope("y", "_x").over(whole), F.lit(0.0)),
            "intercept": F.coalesce(F.regr_intercept("y", "_x").over(whole), F.avg("y").over(whole)),
        }
    ).withColumn("trend", F.col("intercept") + F.col("slope") * F.col("_x"))
    y, trend = F.col("y"), F.col("trend")
    off = F.try_divide(y, trend) if multiplicative else y - trend
    neutral = F.lit(1.0 if multiplicative else 0.0)
    weekly = F.coalesce(F.avg(off).over(weekday), neutral)
    weeked = lined.withColumn("weekly", weekly)
    rest = F.try_divide(off, F.col("weekly")) if multiplicative else off - F.col("weekly")
    yeared = weeked.withColumn("yearly", F.coalesce(F.avg(rest).over(month), neutral))
    fitted = _combine(F.col("trend"), F.col("weekly"), F.col("yearly"), multiplicative)
    return yeared.withColumn("fitted", fitted).withColumn("residual", F.col("y") - F.col("fitted"))


def fit_seasonal_trend(df: DataFrame, keys: Sequence[str] = KEY, multiplicative: bool = False) -> DataFrame:
    """One row per series: line, weekday and month effects as maps, residual deviation, last date."""

    def effects(number, name):
        # At most 7 or 12 entries.
        return F.map_from_entries(F.collect_set(F.struct(number, F.col(name))))

    return (
        decompose_components(df, keys, multiplicative)
        .groupBy(*keys)
        .agg(
            F.min("ds").alias("first_ds"),
            F.max("ds").alias("last_ds"),
            F.max("slope").alias("slope"),
            F.max("intercept").alias("intercept"),
            effects(F.weekday("ds"), "weekly").alias("weekday_effect"),
            effects(F.month("ds"), "yearly").alias("month_effect"),
            F.coalesce(F.stddev_samp("residual"), F.lit(0.0)).alias("sigma"),
        )
        .withColumn("multiplicative", F.lit(multiplicative))
    )


def predict_seasonal_trend(
    model: DataFrame, horizon: int, interval: float = 0.95, keys: Sequence[str] = KEY, multiplicative: bool = False
) -> DataFrame:
    """Forecast rows of the ``horizon`` days after each series' last date; no join needed."""
    neutral = F.lit(1.0 if multiplicative else 0.0)
    days = model.select("*", F.explode(F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", horizon))).alias("ds"))
    trend = F.col("intercept") + F.col("slope") * F.datediff("ds", "first_ds")
    weekly = F.coalesce(F.try_element_at("weekday_effect", F.weekday("ds")), neutral)
    yearly = F.coalesce(F.try_element_at("month_effect", F.month("ds")), neutral)
    yhat = _combine(trend, weekly, yearly, multiplicative)
    margin = F.lit(z_value(interval)) * F.col("sigma")
    return days.select(
        *keys,
        "ds",
        yhat.alias("yhat"),
        (yhat - margin).alias("lower"),
        (yhat + margin).alias("upper"),
        trend.alias("trend"),
        (weekly * yearly if multiplicative else weekly + yearly).alias("seasonal"),
    )


def forecast_seasonal_trend(
    df: DataFrame, horizon: int = 30, interval: float = 0.95, keys: Sequence[str] = KEY, multiplicative: bool = False
) -> DataFrame:
    model = fit_seasonal_trend(df, keys, multiplicative)
    return predict_seasonal_trend(model, horizon, interval, keys, multiplicative)


def forecast_ensemble(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEY, weights=WEIGHTS) -> DataFrame:
    """Weighted sum of two forecasts and of their bounds."""
    values = ["yhat", "lower", "upper"]
    left = a.select(*keys, "ds", *[F.col(c).alias(f"_a_{c}") for c in values])
    right = b.select(*keys, "ds", *[F.col(c).alias(f"_b_{c}") for c in values])
    return left.join(right, [*keys, "ds"]).select(
        *keys, "ds", *[(weights[0] * F.col(f"_a_{c}") + weights[1] * F.col(f"_b_{c}")).alias(c) for c in values]
    )


def cutoffs(
    df: DataFrame,
    keys: Sequence[str] = KEY,
    initial: int = CV_INITIAL,
    period: int = CV_PERIOD,
    horizon: int = CV_HORIZON,
    min_points: int = CV_MIN_POINTS,
) -> DataFrame:
    """Backtest dates: from ``horizon`` before the end, ``period`` apart, with enough history before."""
    spans = df.groupBy(*keys).agg(F.min("ds").alias("_a"), F.max("ds").alias("_b"), F.count(F.lit(1)).alias("_n"))
    room = F.datediff(F.date_sub("_b", horizon), "_a") - initial
    return (
        spans.where((F.col("_n") >= min_points) & (room >= 0))
        .select(*keys, "_b", F.explode(F.sequence(F.lit(0), F.floor(room / period).cast("int"))).alias("_i"))
        .select(*keys, F.date_sub(F.date_sub("_b", horizon), F.col("_i") * period).alias("cutoff"))
    )


def rolling_origin_forecasts(
    df: DataFrame, keys: Sequence[str] = KEY, interval: float = 0.95, horizon: int = CV_HORIZON, **settings
) -> DataFrame:
    """Forecasts of every backtest date against the values that followed.

    A series' days repeat once per cutoff, a few dozen at most, and then travel as separate series.
    """
    keyed = [*keys, "cutoff"]
    origins = cutoffs(df, keys, horizon=horizon, **settings)
    repeated = df.join(origins, list(keys))
    history = repeated.where("ds <= cutoff")
    actual = repeated.where((F.col("ds") > F.col("cutoff")) & (F.col("ds") <= F.date_add("cutoff", horizon)))
    forecast = forecast_seasonal_trend(history, horizon, interval, keyed)
    return actual.select(*keyed, "ds", "y").join(forecast, [*keyed, "ds"])


def join_forecast_actual(forecast: DataFrame, actual: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Forecast rows with the value observed on their date."""
    return forecast.join(actual.select(*keys, "ds", "y"), [*keys, "ds"])
