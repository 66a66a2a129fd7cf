"""Forecast accuracy, bias, coverage, trend, stationarity, diagnostics and model comparison."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.functions.columns import finite
from revlake.operators.series import difference

KEY = ("series",)
TINY = 1e-8
# Fixed value: 5 % critical value of the unit-root test with a constant.
DF_CRITICAL = -2.86


def accuracy_metrics(pairs: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """MAE, RMSE, MAPE, R2 and MASE per key over rows where both values are known."""
    clean = pairs.withColumns({"y": finite("y"), "yhat": finite("yhat")}).where("y is not null and yhat is not null")
    step = F.abs(F.col("y") - F.lag("y").over(W.partitionBy(*keys).orderBy("ds")))
    e = F.col("y") - F.col("yhat")
    n = F.count(F.lit(1))
    ss_tot = F.var_pop("y") * n
    return (
        clean.withColumn("_step", step)
        .groupBy(*keys)
        .agg(
            n.alias("n"),
            F.avg(F.abs(e)).alias("mae"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            (F.avg(F.abs(F.try_divide(e, F.col("y") + TINY))) * 100).alias("mape"),
            (1 - F.sum(e * e) / (ss_tot + TINY)).alias("r2"),
            F.coalesce(F.avg(F.abs(e)) / (F.avg("_step") + TINY), F.lit(float("inf"))).alias("mase"),
        )
    )


def forecast_bias_coverage(pairs: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Mean error (forecast minus actual), variance of the forecast, share of values inside the bounds."""
    inside = F.col("y").between(F.col("lower"), F.col("upper"))
    return pairs.where("y is not null and yhat is not null").groupBy(*keys).agg(
        F.avg(F.col("yhat") - F.col("y")).alias("bias"),
        F.var_pop("yhat").alias("variance"),
        (F.avg(inside.cast("double")) * 100).alias("coverage"),
    )


def forecast_statistics(forecast: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    return forecast.groupBy(*keys).agg(
        F.avg("yhat").alias("mean_forecast"),
        F.median("yhat").alias("median_forecast"),  # one value per forecast day
        F.min("yhat").alias("min_forecast"),
        F.max("yhat").alias("max_forecast"),
        F.stddev_pop("yhat").alias("std_forecast"),
        F.sum("yhat").alias("total_forecast"),
    )


def trend_analysis(df: DataFrame, value: str = "yhat", keys: Sequence[str] = KEY) -> DataFrame:
    """Slope per step, its direction, relative volatility and strength."""
    at = F.row_number().over(W.partitionBy(*keys).orderBy("ds"))
    slope = F.col("slope")
    return (
        df.withColumn("_i", at)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.regr_slope(value, "_i"), F.lit(0.0)).alias("slope"),
            (F.stddev_pop(value) / (F.avg(value) + TINY)).alias("volatility"),
        )
        .withColumns(
            {
                "direction": F.when(slope > 0.01, "increasing").when(slope < -0.01, "decreasing").otherwise("stable"),
                "strength": F.when(F.abs(slope) > 1, "high").when(F.abs(slope) > 0.1, "medium").otherwise("low"),
            }
        )
    )


def dickey_fuller_stat(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """t statistic of the lag coefficient in the regression of the change on the level before."""
    before = F.lag("y").over(W.partitionBy(*keys).orderBy("ds"))
    rows = df.withColumn("_before", before).where("_before is not null").withColumn("_change", F.col("y") - F.col("_before"))
    sums = rows.groupBy(*keys).agg(
        F.regr_count("_change", "_before").cast("double").alias("n"),
        F.regr_sxx("_change", "_before").alias("sxx"),
        F.regr_sxy("_change", "_before").alias("sxy"),
        F.regr_syy("_change", "_before").alias("syy"),
    )
    slope = F.try_divide("sxy", "sxx")
    error = F.try_divide(F.col("syy") - slope * F.col("sxy"), F.col("n") - 2)
    t = F.try_divide(slope, F.sqrt(F.try_divide(error, "sxx")))
    return sums.select(*keys, t.alias("statistic"), F.coalesce(t < DF_CRITICAL, F.lit(False)).alias("stationary"))


def stationary_order(df: DataFrame, keys: Sequence[str] = KEY, most: int = 2) -> DataFrame:
    """Smallest number of differences that makes each series stationary; ``most`` if none does."""
    tests = None
    for d in range(most + 1):
        one = dickey_fuller_stat(difference(df, d, keys), keys).withColumn("d", F.lit(d))
        tests = one if tests is None else tests.unionByName(one)
    first = F.min(F.when(F.col("stationary"), F.col("d")))
    return tests.groupBy(*keys).agg(F.coalesce(first, F.lit(most)).alias("d"))


def erfc(z: Column) -> Column:
    """Complementary error function of ``z`` >= 0: a series of positive terms below 3, a continued fraction above."""
    square = z * z
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda a, n: F.struct(
            (a["term"] * 2 * square / (2 * n + 1)).alias("term"), (a["sum"] + a["term"] * 2 * square / (2 * n + 1)).alias("sum")
        ),
        lambda a: a["sum"],
    )
    near = 1 - 2 / math.sqrt(math.pi) * z * F.exp(-square) * grown
    below = F.aggregate(F.sequence(F.lit(60), F.lit(1)), z, lambda f, m: z + m / 2 / f)
    return F.when(z < 3, near).otherwise(F.exp(-square) / math.sqrt(math.pi) / below)


def chi_square_tail(q: Column, k: int) -> Column:
    """P(X > q) for ``k`` degrees of freedom, from the recurrence of the incomplete gamma function."""
    half = F.greatest(q, F.lit(0.0)) / 2
    if k % 2 == 0:
        tail, power, n = F.exp(-half), F.lit(1.0), 1.0
        for i in range(1, k // 2):
            power, n = power * half, n * i
            tail = tail + F.exp(-half) * power / n
    else:
        tail, power = erfc(F.sqrt(half)), F.sqrt(half)
        for i in range(1, (k + 1) // 2):
            tail = tail + F.exp(-half) * power / math.gamma(i + 0.5)
            power = power * half
    # Far out the powers pass every number, and the tail is nothing.
    return F.when(q.isNotNull(), F.when(half > 700, 0.0).otherwise(F.least(tail, F.lit(1.0))))


def ljung_box(residuals: DataFrame, lags: int = 10, keys: Sequence[str] = KEY) -> DataFrame:
    """Autocorrelation statistic Q for 1 to ``lags`` lags and its p-value, in long form."""
    order, whole = W.partitionBy(*keys).orderBy("ds"), W.partitionBy(*keys)
    centred = residuals.withColumn("_c", F.col("residual") - F.avg("residual").over(whole))
    products = centred.withColumns({f"_p{k}": F.col("_c") * F.lag("_c", k).over(order) for k in range(1, lags + 1)})
    sums = products.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum(F.col("_c") * F.col("_c")).alias("_ss"),
        *[F.sum(f"_p{k}").alias(f"_p{k}") for k in range(1, lags + 1)],
    )
    n = F.col("n")
    q, rows = F.lit(0.0), []
    for k in range(1, lags + 1):
        r = F.try_divide(f"_p{k}", "_ss")
        q = q + F.try_divide(r * r, n - k)
        statistic = n * (n + 2) * q
        rows.append(F.struct(F.lit(k).alias("lag"), statistic.alias("q"), chi_square_tail(statistic, k).alias("p")))
    return sums.select(*keys, F.explode(F.array(*rows)).alias("r")).select(*keys, "r.*")


def residual_diagnostics(residuals: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Shape of the residuals and whether they are autocorrelated (smallest p over 10 lags < 0.05)."""
    shape = residuals.groupBy(*keys).agg(
        F.avg("residual").alias("mean"),
        F.stddev_pop("residual").alias("std"),
        F.skewness("residual").alias("skewness"),
        F.kurtosis("residual").alias("kurtosis"),
    )
    p = ljung_box(residuals, 10, keys).groupBy(*keys).agg(F.min("p").alias("min_p"))
    return shape.join(p, list(keys)).withColumn("autocorrelated", F.col("min_p") < 0.05)


def model_comparison(metrics: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Best model per key and metric: highest R2, lowest everything else."""
    long = metrics.unpivot([*keys, "model"], ["mae", "rmse", "mape", "r2"], "metric", "value")
    badness = F.when(F.col("metric") == "r2", -F.col("value")).otherwise(F.col("value"))
    return long.where("value is not null").groupBy(*keys, "metric").agg(
        F.min_by("model", F.struct(badness, F.col("model"))).alias("best_model"),
        F.min_by("value", F.struct(badness, F.col("model"))).alias("best_value"),
    )


def tuning_improvement(metrics: DataFrame, base: str, tuned: str, keys: Sequence[str] = KEY) -> DataFrame:
    """Percent improvement of the tuned model over the base model per metric."""
    names = ["mae", "rmse", "mape", "r2"]
    a = metrics.where(F.col("model") == base).select(*keys, *[F.col(c).alias(f"_a_{c}") for c in names])
    b = metrics.where(F.col("model") == tuned).select(*keys, *[F.col(c).alias(f"_b_{c}") for c in names])
    gain = {
        c: F.try_divide(F.col(f"_a_{c}") - F.col(f"_b_{c}"), F.col(f"_a_{c}")) * (-100 if c == "r2" else 100) for c in names
    }
    return a.join(b, list(keys)).select(*keys, *[gain[c].alias(f"{c}_improvement") for c in names])


def forecast_agreement(statistics: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """How far the models' mean forecasts lie apart."""
    cv = F.try_divide("std_mean", "avg_mean")
    return (
        statistics.groupBy(*keys)
        .agg(
            F.min("mean_forecast").alias("min_mean"),
            F.max("mean_forecast").alias("max_mean"),
            F.avg("mean_forecast").alias("avg_mean"),
            F.stddev_pop("mean_forecast").alias("std_mean"),
            F.min("total_forecast").alias("min_total"),
            F.max("total_forecast").alias("max_total"),
            F.stddev_pop("total_forecast").alias("std_total"),
        )
        .withColumn("agreement", F.when(cv < 0.1, "high").when(cv < 0.3, "moderate").otherwise("disagreement"))
    )


def forecast_vs_recent(statistics: DataFrame, history: DataFrame, days: int = 90, keys: Sequence[str] = KEY) -> DataFrame:
    """Growth of the forecast total over the revenue of the last ``days`` days; 0 without revenue."""
    last = F.max("ds").over(W.partitionBy(*keys))
    recent = (
        history.withColumn("_last", last)
        .where(F.col("ds") >= F.date_sub("_last", days))
        .groupBy(*keys)
        .agg(F.sum("y").alias("recent_revenue"))
    )
    growth = F.try_divide(F.col("total_forecast") - F.col("recent_revenue"), F.col("recent_revenue")) * 100
    return statistics.join(recent, list(keys), "left").select(
        *keys,
        "total_forecast",
        F.coalesce("recent_revenue", F.lit(0.0)).alias("recent_revenue"),
        F.when(F.col("recent_revenue") > 0, growth).otherwise(0.0).alias("growth_percent"),
    )


def accuracy_by_horizon(pairs: DataFrame, buckets: Sequence[int] = (7, 14, 30, 60), keys: Sequence[str] = KEY) -> DataFrame:
    """Accuracy of backtest rows up to 7, 8 to 14, 15 to 30 and 31 to 60 days ahead."""
    ahead = F.datediff("ds", "cutoff")
    bucket = F.lit(None).cast("int")
    for days in sorted(buckets, reverse=True):
        bucket = F.when(ahead <= days, days).otherwise(bucket)
    e = F.col("y") - F.col("yhat")
    return (
        pairs.withColumn("horizon", bucket)
        .where("horizon is not null")
        .groupBy(*keys, "horizon")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.abs(e)).alias("mae"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            (F.avg(F.abs(F.try_divide(e, F.col("y") + TINY))) * 100).alias("mape"),
        )
    )


def rank_models(metrics: DataFrame, by: str = "mae", keys: Sequence[str] = KEY) -> DataFrame:
    """Rank of each model within its series, best first."""
    return metrics.withColumn("rank", F.rank().over(W.partitionBy(*keys).orderBy(by)))
