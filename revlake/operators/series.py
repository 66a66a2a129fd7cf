"""Daily series: calendars, features, filters and splits.

A series has one row per day, so a window over a whole series is bounded by the calendar whatever
the volume of invoices behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.functions.columns import finite, seasonal_flags, slug_country, year_month

KEY = ("series",)
# Lags, rolling widths and look-back ranges of the feature sets.
LAGS = (1, 7, 14, 30)
WIDTHS = (7, 14, 30)
LOOKBACKS = (7, 14, 28, 70)
TARGET_DAYS = 30
MIN_TRAINING_DAYS = 30


def _by(keys: Sequence[str], order: str = "ds"):
    return W.partitionBy(*keys).orderBy(order)


def revenue_series(df: DataFrame, key: str = "country") -> DataFrame:
    """Daily revenue per country as ``series, ds, y``."""
    return (
        df.where(F.col(key).isNotNull() & F.col("date").isNotNull())
        .groupBy(F.col(key).alias("series"), F.col("date").alias("ds"))
        .agg(F.sum("price").alias("y"))
    )


def complete_calendar(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """One row per day from first to last day of each series, 0 where nothing was sold."""
    spine = (
        df.groupBy(*keys)
        .agg(F.min("ds").alias("_a"), F.max("ds").alias("_b"))
        .select(*keys, F.explode(F.sequence("_a", "_b", F.expr("interval 1 day"))).alias("ds"))
    )
    return spine.join(df, [*keys, "ds"], "left").withColumn("y", F.coalesce("y", F.lit(0.0)))


def month_spine(df: DataFrame, keys: Sequence[str] = KEY, column: str = "date") -> DataFrame:
    """Days from the first of the first month to the end of the month before the last."""
    first, last = F.trunc("_a", "month"), F.date_sub(F.trunc("_b", "month"), 1)
    return (
        df.groupBy(*keys)
        .agg(F.min(column).alias("_a"), F.max(column).alias("_b"))
        # A single month leaves no day; sequence would count down.
        .where(first <= last)
        .select(*keys, F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias(column))
    )


def country_totals(df: DataFrame) -> DataFrame:
    """Revenue per country, largest first."""
    return (
        df.where("country is not null")
        .groupBy("country")
        .agg(F.sum("price").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), "country")
    )


def with_series(df: DataFrame, countries: int = 10) -> DataFrame:
    """Each row once under ``all`` and, for the largest countries, once under the country's slug."""
    largest = country_totals(df).limit(countries).select("country", slug_country("country").alias("_slug"))
    # At most ``countries`` rows are broadcast.
    return (
        df.join(F.broadcast(largest), "country", "left")
        .withColumn("series", F.explode(F.array_compact(F.array(F.lit("all"), F.col("_slug")))))
        .drop("_slug")
    )


def daily_ts(df: DataFrame, countries: int = 10) -> DataFrame:
    """Purchases, distinct invoices and products, views and revenue per series and day."""
    days = (
        with_series(df, countries)
        .groupBy("series", "date")
        .agg(
            F.count(F.lit(1)).alias("purchases"),
            F.count_distinct("invoice").alias("unique_invoices"),
            F.count_distinct("stream_id").alias("unique_streams"),
            F.sum("times_viewed").alias("total_views"),
            F.sum("price").alias("revenue"),
        )
    )
    counts = ["purchases", "unique_invoices", "unique_streams", "total_views"]
    return month_spine(days).join(days, ["series", "date"], "left").select(
        "series",
        "date",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        year_month("date").alias("year_month"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
    )


def resample(df: DataFrame, freq: str = "month", keys: Sequence[str] = KEY) -> DataFrame:
    """Sums per day, week (ending Sunday) or month, labelled with the last day of the period."""
    labels = {
        "day": F.col("ds"),
        "week": F.date_add(F.trunc("ds", "week"), 6),
        "month": F.last_day("ds"),
    }
    return df.groupBy(*keys, labels[freq].alias("period")).agg(F.sum("y").alias("y"))


def series_stats(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("y").alias("mean"),
        F.median("y").alias("median"),  # one value per day
        F.max("y").alias("max"),
        F.stddev_samp("y").alias("std"),
    )


def filter_training_series(df: DataFrame, keys: Sequence[str] = KEY, min_days: int = MIN_TRAINING_DAYS) -> DataFrame:
    """Drop missing, negative and far too large values; drop series left with too few days."""
    whole = W.partitionBy(*keys)
    usable = df.where("y is not null and not isnan(y) and y >= 0")
    limit = F.avg("y").over(whole) + 5 * F.stddev_samp("y").over(whole)
    kept = usable.withColumns({"_n": F.count(F.lit(1)).over(whole), "_limit": limit}).where(
        "_n <= 10 or y <= _limit"
    )
    return kept.withColumn("_n", F.count(F.lit(1)).over(whole)).where(F.col("_n") >= min_days).drop("_n", "_limit")


def backfill(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEY, order: str = "ds") -> DataFrame:
    """NaN and infinity to null, then the next known value in date order, then 0."""
    # Read backwards: a frame that grows from its start is one pass, one open to the end is quadratic.
    ahead = W.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns(
        {c: F.coalesce(F.last(finite(c), ignorenulls=True).over(ahead), F.lit(0.0)) for c in columns}
    )


def prepare_series(df: DataFrame, sequence: str, keys: Sequence[str] = KEY) -> DataFrame:
    """Last row per day by ``sequence``, then rows without a value dropped."""
    last = df.groupBy(*keys, "ds").agg(F.max_by("y", sequence).alias("y"))
    return last.where("y is not null and not isnan(y)")


def interpolate_linear(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Fill inner gaps by position on a straight line; trailing gaps take the last value."""
    order = _by(keys)
    at = df.withColumn("_i", F.row_number().over(order))
    known = F.when(finite("y").isNotNull(), F.struct(F.col("_i"), finite("y").alias("y")))
    before = F.last(known, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    backwards = W.partitionBy(*keys).orderBy(F.col("ds").desc()).rowsBetween(W.unboundedPreceding, 0)
    after = F.last(known, ignorenulls=True).over(backwards)
    marked = at.withColumns({"_p": before, "_q": after})
    slope = F.try_divide(F.col("_q.y") - F.col("_p.y"), F.col("_q._i") - F.col("_p._i"))
    line = F.col("_p.y") + F.coalesce(slope, F.lit(0.0)) * (F.col("_i") - F.col("_p._i"))
    return marked.withColumn("y", line).drop("_i", "_p", "_q")


def lag_features(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    return df.withColumns({f"y_lag_{k}": F.lag("y", k).over(_by(keys)) for k in LAGS})


def rolling_features(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Mean and sample deviation over the last rows, the current one included."""
    out = {}
    for n in WIDTHS:
        frame = _by(keys).rowsBetween(1 - n, 0)
        out[f"y_rolling_mean_{n}"] = F.avg("y").over(frame)
        out[f"y_rolling_std_{n}"] = F.stddev_samp("y").over(frame)
    return df.withColumns(out)


def growth_rates(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Change against 1 and 7 rows before; null where that value is 0 or absent."""
    return df.withColumns(
        {f"y_growth_{k}d": F.try_divide("y", F.lag("y", k).over(_by(keys))) - 1 for k in (1, 7)}
    )


def engineer_features(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Lags, rolling statistics, growth and calendar flags, without gaps."""
    featured = growth_rates(rolling_features(lag_features(df, keys), keys), keys).withColumns(seasonal_flags("ds"))
    made = [c for c in featured.columns if c.startswith("y_")]
    return backfill(featured, made, keys)


def range_features(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Revenue of the days before each date, same month last year, recent means, and the target."""
    day = W.partitionBy(*keys).orderBy(F.unix_date("date"))

    def total(a: int, b: int) -> Column:
        return F.coalesce(F.sum("revenue").over(day.rangeBetween(a, b)), F.lit(0.0))

    def mean(c: str) -> Column:
        return F.coalesce(F.avg(c).over(day.rangeBetween(-30, -1)), F.lit(0.0))

    return df.withColumns(
        {
            **{f"previous_{k}": total(-k, -1) for k in LOOKBACKS},
            "previous_year": total(-365, TARGET_DAYS - 366),
            "recent_invoices": mean("unique_invoices"),
            "recent_views": mean("total_views"),
            "target": total(0, TARGET_DAYS - 1),
        }
    )


FEATURES = [*[f"previous_{k}" for k in LOOKBACKS], "previous_year", "recent_invoices", "recent_views"]


def trim_training(df: DataFrame, training: bool = True, keys: Sequence[str] = KEY) -> DataFrame:
    """Drop rows whose features are all zero, and for training the last 30 rows of each series."""
    kept = df.where(sum((F.col(c) for c in FEATURES), F.lit(0.0)) > 0)
    if not training:
        return kept
    back = W.partitionBy(*keys).orderBy(F.col("date").desc())
    return kept.withColumn("_n", F.row_number().over(back)).where(F.col("_n") > TARGET_DAYS).drop("_n")


def difference(df: DataFrame, d: int = 1, keys: Sequence[str] = KEY) -> DataFrame:
    """d-th differences; the first d rows of each series go."""
    order = _by(keys)
    for _ in range(d):
        df = df.withColumn("y", F.col("y") - F.lag("y").over(order)).where("y is not null")
    return df


def log_transform(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """log(1 + y) for series whose values are all positive; ``logged`` tells which."""
    positive = F.min("y").over(W.partitionBy(*keys)) > 0
    return df.withColumn("logged", positive).withColumn("y", F.when(F.col("logged"), F.log1p("y")).otherwise(F.col("y")))


def inverse_log_transform(df: DataFrame) -> DataFrame:
    return df.withColumn("y", F.when(F.col("logged"), F.expm1("y")).otherwise(F.col("y"))).drop("logged")


def split_last_share(df: DataFrame, share: float = 0.2, keys: Sequence[str] = KEY) -> DataFrame:
    """Add ``is_test``: the last ``int(n * share)`` rows of each series."""
    back = W.partitionBy(*keys).orderBy(F.col("ds").desc())
    n = F.count(F.lit(1)).over(W.partitionBy(*keys))
    return df.withColumn("is_test", F.row_number().over(back) <= F.floor(n * F.lit(float(share))))


def split_last_days(df: DataFrame, days: int = 30, keys: Sequence[str] = KEY) -> DataFrame:
    """Add ``is_test``: dates within ``days`` of the last one."""
    last = F.max("ds").over(W.partitionBy(*keys))
    return df.withColumn("is_test", F.col("ds") > F.date_sub(last, days))


def future_dates(df: DataFrame, days: int, keys: Sequence[str] = KEY) -> DataFrame:
    """The ``days`` days after the last one of each series."""
    return (
        df.groupBy(*keys)
        .agg(F.max("ds").alias("_b"))
        .select(*keys, F.explode(F.sequence(F.date_add("_b", 1), F.date_add("_b", days))).alias("ds"))
    )
