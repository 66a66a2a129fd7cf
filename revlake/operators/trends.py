"""Revenue by day, calendar month and weekday; growth between months; best and worst periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlake.functions.columns import day_name, month_name, percent, round_total


def daily_trend(df: DataFrame) -> DataFrame:
    return (
        df.where("date is not null")
        .groupBy("date")
        .agg(
            round_total(F.sum("price")).alias("total_revenue"),
            round_total(F.avg("price")).alias("avg_price"),
            F.count("price").alias("transactions"),
            F.sum("times_viewed").alias("total_views"),
        )
    )


def daily_trend_summary(days: DataFrame) -> DataFrame:
    """Averages and peaks of the daily trend."""
    return days.agg(
        F.avg("total_revenue").alias("avg_daily_revenue"),
        F.avg("transactions").alias("avg_daily_transactions"),
        F.max("total_revenue").alias("peak_daily_revenue"),
        F.max("transactions").alias("peak_daily_transactions"),
        F.datediff(F.max("date"), F.min("date")).alias("period_days"),
    )


def _period(df: DataFrame, number, name, label: str) -> DataFrame:
    return (
        df.where("date is not null")
        .groupBy(number.alias(label), name.alias(f"{label}_name"))
        .agg(
            round_total(F.sum("price")).alias("total_revenue"),
            round_total(F.avg("price")).alias("avg_price"),
            F.count("price").alias("transactions"),
            round_total(F.avg("times_viewed")).alias("avg_views"),
        )
    )


def monthly_trend(df: DataFrame) -> DataFrame:
    """By calendar month, all years together."""
    return _period(df, F.month("date"), month_name("date"), "month")


def dow_trend(df: DataFrame) -> DataFrame:
    """By weekday, Monday is 0."""
    return _period(df, F.weekday("date"), day_name("date"), "day_of_week")


def weekend_share(df: DataFrame) -> DataFrame:
    weekend = F.sum(F.when(F.weekday("date") >= 5, F.col("price")))
    return df.agg(percent(F.coalesce(weekend, F.lit(0.0)), F.sum("price")).alias("weekend_share"))


def best_worst_period(months: DataFrame, weekdays: DataFrame) -> DataFrame:
    """Names and revenue of the best and worst month and weekday; the earlier one on ties."""

    def extremes(df: DataFrame, label: str) -> DataFrame:
        name, revenue, place = F.col(f"{label}_name"), F.col("total_revenue"), F.col(label)
        return df.agg(
            F.max_by(name, F.struct(revenue, -place)).alias("best"),
            F.max("total_revenue").alias("best_revenue"),
            F.min_by(name, F.struct(revenue, place)).alias("worst"),
            F.min("total_revenue").alias("worst_revenue"),
        ).select(F.lit(label).alias("period"), "*")

    return extremes(months, "month").unionByName(extremes(weekdays, "day_of_week"))


def month_growth(months: DataFrame) -> DataFrame:
    """Percent change from the previous calendar month; null after a month without revenue.

    Twelve rows at most, so one window over all of them.
    """
    order = W.partitionBy(F.lit(0)).orderBy("month")
    previous = F.lag("total_revenue").over(order)
    return months.select(
        "month",
        "total_revenue",
        (F.try_divide(F.col("total_revenue") - previous, F.when(previous != 0, previous)) * 100).alias("growth"),
    )


def month_over_month(months: DataFrame) -> DataFrame:
    """Mean growth, the largest change in either direction, and growth from first to last month."""
    grown = month_growth(months)
    first = F.min_by("total_revenue", "month")
    last = F.max_by("total_revenue", "month")
    return grown.agg(
        F.avg("growth").alias("avg_growth"),
        F.max_by("growth", F.when(F.col("growth").isNotNull(), F.struct(F.abs("growth"), -F.col("month")))).alias(
            "most_volatile"
        ),
        percent(last - first, first).alias("first_to_last_growth"),
    )
